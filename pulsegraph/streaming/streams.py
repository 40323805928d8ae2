"""Structured Streaming: running per-account state over a file stream.

A file folder is the stream (``maxFilesPerTrigger`` files per micro-batch).
Running totals are plain streaming aggregates (state store, checkpointed in
the shared checkpoint folder, so a restart resumes where it stopped).

Two ways to publish them:

* numbered snapshots ``batch_id=<epoch + 1>``, overwritten, so that a replayed
  epoch is idempotent.  With ``complete`` output a batch writes every key
  (nothing ever expires: these totals have no window or watermark);
* ``merged_writer``: ``update`` output, so a batch writes only the keys that it
  changed.  The current state is a base and the changes since, named by a
  pointer that is written last; every few batches they are compacted into a new
  base, and what no kept pointer names is deleted.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegraph.operators import heat as H
from pulsegraph.operators import mentions as M


def stage_files(df: DataFrame, path: str, n_files: int) -> None:
    """Write a table as ``n_files`` parquet files of random rows, a file stream's input folder."""
    df.repartition(n_files).write.mode("overwrite").parquet(path)


def file_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    """The files of a folder, or a table that is one file (a stream takes folders,
    so that is the folder it lies in, without its other files)."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        return reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
    return reader.parquet(path)


def snapshot_writer(out_path: str, transform=None):
    """foreachBatch callback: overwrite ``<out>/batch_id=<epoch + 1>``."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        frame = transform(batch) if transform is not None else batch
        frame.write.mode("overwrite").parquet(f"{out_path}/batch_id={epoch_id + 1}")

    return write


# ---------------------------------------------------------------- incremental snapshots

POINTERS = "_pointers"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def pointers(spark: SparkSession, out_path: str) -> list[int]:
    """Numbers of the kept pointers, oldest first."""
    names = _names(spark, f"{out_path}/{POINTERS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def read_pointer(spark: SparkSession, out_path: str, number: int) -> dict:
    """``base`` (its number or null) and ``changes`` (numbers) that make up state ``number``."""
    return json.loads(spark.read.text(f"{out_path}/{POINTERS}/{number}.json").first()[0])


def write_pointer(spark: SparkSession, out_path: str, number: int, state: dict) -> None:
    """A small file under a name of its own: written aside and renamed, so it is there whole or not at all."""
    aside, fs = _fs(spark, f"{out_path}/{POINTERS}/.{number}.tmp")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(state), "utf-8"))
    out.close()
    there, _ = _fs(spark, f"{out_path}/{POINTERS}/{number}.json")
    fs.rename(aside, there)


def _merged(spark: SparkSession, out_path: str, state: dict, keys: list[str]) -> DataFrame:
    """The newest row of every key in a base and the changes after it."""
    folders = [("base", state["base"])] if state["base"] is not None else []
    folders += [("changes", n) for n in state["changes"]]
    rows = None
    for kind, n in folders:
        part = spark.read.parquet(f"{out_path}/{kind}={n}").withColumn("__n", F.lit(n))
        rows = part if rows is None else rows.unionByName(part)
    columns = [c for c in rows.columns if c != "__n"]
    newest = F.max_by(F.struct(*columns), "__n").alias("__row")
    return rows.groupBy(*[F.col(k).alias(f"__key_{k}") for k in keys]).agg(newest).select("__row.*")


def merged_snapshot(spark: SparkSession, out_path: str, keys: list[str]) -> DataFrame:
    """The state that the newest pointer names."""
    return _merged(spark, out_path, read_pointer(spark, out_path, pointers(spark, out_path)[-1]), keys)


def merged_writer(out_path: str, keys: list[str], compact_every: int = 8, keep: int = 2) -> Callable[[DataFrame, int], None]:
    """foreachBatch callback for ``update`` output: write the changed keys, then the pointer, then clean up.

    Work a batch is in proportion to its changes, but for one batch in
    ``compact_every``, which merges them into a new base.  An epoch that is
    replayed after its pointer stands is done already; one that failed before
    it overwrites its own folder.  Readers of the last ``keep`` states are safe
    from the clean-up.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark, n = batch.sparkSession, epoch_id + 1
        known = pointers(spark, out_path)
        if known and known[-1] >= n:
            return
        state = read_pointer(spark, out_path, known[-1]) if known else {"base": None, "changes": []}
        batch.write.mode("overwrite").parquet(f"{out_path}/changes={n}")
        state = {"base": state["base"], "changes": [*state["changes"], n]}
        if len(state["changes"]) >= compact_every:
            _merged(spark, out_path, state, keys).write.mode("overwrite").parquet(f"{out_path}/base={n}")
            state = {"base": n, "changes": []}
        write_pointer(spark, out_path, n, state)
        _clean(spark, out_path, keep)

    return write


def _clean(spark: SparkSession, out_path: str, keep: int) -> None:
    """Delete all but the newest ``keep`` pointers and the folders that none of those names."""
    numbers = pointers(spark, out_path)
    for n in numbers[:-keep]:
        p, fs = _fs(spark, f"{out_path}/{POINTERS}/{n}.json")
        fs.delete(p, False)
    named = set()
    for n in numbers[-keep:]:
        state = read_pointer(spark, out_path, n)
        named |= {f"base={state['base']}"} | {f"changes={c}" for c in state["changes"]}
    for name in _names(spark, out_path):
        kind, _, number = name.partition("=")
        if kind in ("base", "changes") and name not in named and int(number) <= numbers[-1]:
            p, fs = _fs(spark, f"{out_path}/{name}")
            fs.delete(p, True)


def run_to_end(
    stream: DataFrame,
    out_path: str,
    checkpoint_path: str,
    output_mode: str = "complete",
    transform=None,
    processing_time: str | None = None,
    writer: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Start the snapshot sink, or that of ``writer``.  Without ``processing_time`` the query drains
    what is available now (one micro-batch per trigger's worth of files) and
    stops; with it, it keeps running on that clock (e.g. ``'60 seconds'``)."""
    w = (
        stream.writeStream.outputMode(output_mode)
        .foreachBatch(writer or snapshot_writer(out_path, transform))
        .option("checkpointLocation", checkpoint_path)
    )
    if processing_time is None:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
    else:
        q = w.trigger(processingTime=processing_time).start()
    return q


def latest_snapshot(spark: SparkSession, out_path: str) -> DataFrame:
    """The snapshot with the highest number; the folder names tell, the others are not read."""
    root = spark._jvm.org.apache.hadoop.fs.Path(out_path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    last = max(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))
    return spark.read.parquet(f"{out_path}/batch_id={last}")


def all_snapshots(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(out_path)


# ---------------------------------------------------------------- running aggregates


def running_mention_counts(posts_at_stream: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Mentions received per known name, over everything seen so far."""
    return M.mention_counts(M.mentions_exploded(posts_at_stream), dictionary)


def running_account_measures(posts_stream: DataFrame) -> DataFrame:
    return H.account_measure_totals(posts_stream)


def running_account_totals(
    posts_stream: DataFrame, posts_at_stream: DataFrame, dictionary: DataFrame
) -> DataFrame:
    """Measures ⟗ mentions received, zero-filled: one streaming aggregate over
    the union of measure rows and mention rows (Spark rejects an outer join of
    two streaming aggregates outside append mode; union-then-aggregate is the
    same result with a single state store)."""
    known = M.mentions_known(M.mentions_exploded(posts_at_stream), dictionary)
    return M.account_totals(posts_stream, known)


def per_batch_monthly_measures(batch: DataFrame) -> DataFrame:
    """Stateless per-batch monthly sums (used inside foreachBatch)."""
    return H.monthly_measures(batch)


def summed_monthly_measures(batches: DataFrame) -> DataFrame:
    """The roll-up over all batch outputs: an account's month may be in several."""
    return batches.groupBy("account", "month").agg(*[F.sum(m).cast("bigint").alias(m) for m in H.MEASURES])
