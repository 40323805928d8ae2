"""Registered streaming queries.

Each deals the rows of the given table at random over at least ``BATCHES``
files, of about ``FILE_BYTES`` of it each, drains them as a stream in ``BATCHES`` micro-batches, and returns the
state after the last – which must equal the batch answer.
"""

from __future__ import annotations

from pulsegraph.plans import q_mentions, q_posts
from pulsegraph.plans.registry import REGISTRY, query
from pulsegraph.plans.sqlviews import with_views
from pulsegraph.session import scratch_path
from pulsegraph.sinks.entities import input_bytes
from pulsegraph.sources import tables as T
from pulsegraph.streaming import streams as S

BATCHES = 4
#: bytes of the table's files that one task deals into one file of the stream, however large the table is
FILE_BYTES = 32 << 20
#: so that the registered streams also compact
COMPACT_EVERY = 3


def _stream(spark, d, view):
    """``view`` (of ``sources.tables``) as a stream of ``BATCHES`` micro-batches."""
    rows = view(spark, d)
    files = max(BATCHES, len(rows.inputFiles()), -(-input_bytes(rows) // FILE_BYTES))
    path = scratch_path(spark, "stream-in")
    S.stage_files(rows, path, files)
    return S.file_stream(spark, path, rows.schema, -(-files // BATCHES))


def _dictionary(spark, d):
    """The dictionary, written once, so that no micro-batch derives it anew."""
    path, users = scratch_path(spark, "stream-users"), T.users(spark, d)
    users.write.parquet(path)
    return spark.read.schema(users.schema).parquet(path)


def _run(spark, name, stream, keys):
    """The state of a running aggregate after the last micro-batch."""
    out = scratch_path(spark, f"stream-out-{name}")
    S.run_to_end(stream, out, scratch_path(spark, f"stream-ckpt-{name}"), "update",
                 writer=S.merged_writer(out, keys, COMPACT_EVERY))
    return S.merged_snapshot(spark, out, keys)


@query("stream_mention_counts", operators=("T-1", "T-2", "T-6", "K-2", "S-7"),
       sql=REGISTRY["mention_counts"].sql)
def stream_mention_counts(spark, d):
    s = _stream(spark, d, T.posts_at)
    return _run(spark, "mention_counts", S.running_mention_counts(s, _dictionary(spark, d)), ["name"])


@query("stream_account_measures", operators=("T-3",), sql=with_views("posts") + """
SELECT account, CAST(sum(like_num) AS BIGINT) AS like_num, CAST(sum(repost_num) AS BIGINT) AS repost_num,
       CAST(sum(comment_num) AS BIGINT) AS comment_num
FROM posts GROUP BY account""")
def stream_account_measures(spark, d):
    s = _stream(spark, d, T.posts)
    return _run(spark, "account_measures", S.running_account_measures(s), ["account"])


@query("stream_account_totals", operators=("T-4", "J-4"), sql=REGISTRY["account_totals"].sql)
def stream_account_totals(spark, d):
    posts = _stream(spark, d, T.posts)
    posts_at = _stream(spark, d, T.posts_at)
    totals = S.running_account_totals(posts, posts_at, _dictionary(spark, d))
    return _run(spark, "account_totals", totals, [totals.columns[0]])


@query("stream_monthly_measures", operators=("T-5",), sql=REGISTRY["monthly_measures"].sql)
def stream_monthly_measures(spark, d):
    s = _stream(spark, d, T.posts)
    out = scratch_path(spark, "stream-out-monthly_measures")
    S.run_to_end(s, out, scratch_path(spark, "stream-ckpt-monthly_measures"), "append", S.per_batch_monthly_measures)
    return S.summed_monthly_measures(S.all_snapshots(spark, out))


assert q_mentions and q_posts  # registered before this module reads REGISTRY
