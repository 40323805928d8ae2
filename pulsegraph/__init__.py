"""pulsegraph: account-activity analytics on Spark DataFrames.

Posts roll up into monthly / quarterly measures, decayed and cumulative
"heat" series and per-month leaderboards; mentions and follow lists become
directed account graphs ranked by degree, triangles, PageRank and strongly
connected components.  Every operator is a ``DataFrame -> DataFrame``
function built from Spark SQL functions, joins, windows and Structured
Streaming.
"""

from pulsegraph.session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
