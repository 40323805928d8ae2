"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

1. Each source's target is its weight's share of all words, capped at
   ``max_passes`` times its size; the excess is shared again by weight.  With
   sources ordered by cap / weight, the level is the largest of
   (total - caps before) / (weights from here on).
2. The mix is a row of slots of ``block`` words.  A source gets as many slots as
   hold its target, rounded to a word; the last one is partial.
3. Point i, frac((i + 1/2) * phi) of the golden ratio, is mapped through the
   cumulative slot counts to a source, and that source's next slot stands
   there, as long as it has one left.  So every stretch of the mix has the
   target proportions up to a few slots.  Any 1.9 / p points in a row hit an
   interval of length p, so twice as many points as slots give each source all.
4. A source's documents are shuffled by hash and laid end to end, pass after
   pass; the stream is cut into blocks of ``block`` words, and the source's
   k-th slot takes its k-th block.  What a document gives, and where it stands
   in the mix, is the overlap of its passes with the blocks that slots take.

A block has a fixed number of words and the slots grow with the input.  All sums
are of integers and all orders are by hash and id: reruns agree.

Running sums over a source go through buckets (a source may hold a third of
all rows).  The catalogue of sources - one
row each - is the only table that is ordered in one task.

Defined results: null or empty text has size 0 and gives nothing; null is a
source like others, ordered last; a repeated row is a document of its own, but
``mixed_documents`` gives rows of one id the same places; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegraph.llm.common import WORD, buckets_for, fresh, materialise, running_total, text_or_empty

GOLDEN = (5 ** 0.5 - 1) / 2
#: words of a slot
BLOCK = 1024
#: slots whose running sums meet in one row
CHUNK = 65_536


def source_targets(sizes: DataFrame, max_passes: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``source, source_size`` -> with ``src`` (rank by code point, null last), ``weight, target``."""
    ranked = sizes.withColumn(
        "src", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.col("src") % len(weights) + 1))
    cap = F.col("source_size") * max_passes
    by_cap = Window.orderBy(cap / F.col("weight"), "src")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
             / F.sum("weight").over(after))
    return (ranked.withColumn("__level", level)
            .withColumn("__level", F.max("__level").over(every))
            .withColumn("target", F.least(cap.cast("double"), F.col("__level") * F.col("weight")))
            .drop("__level"))


def schedule(sources: DataFrame, n_points: int, n_sources: int, block: int, step: float = GOLDEN) -> DataFrame:
    """``src, k, slot, at``: the places of each source's blocks, by the points
    they stand at, and the words of the mix before them.

    ``sources`` has ``src``, the words it gives (``limit``) and its ``slots``.
    Points meet the sources' intervals in an equi-join on a grid of cells.
    """
    cells = max(4096, n_sources)
    upto = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    cum = (sources.where("slots > 0")
           .select("src", "limit", "slots", (F.sum("slots").over(upto) / F.sum("slots").over(every)).alias("hi"),
                   F.max("src").over(every).alias("last"))
           .withColumn("hi", F.when(F.col("src") == F.col("last"), 1.0).otherwise(F.col("hi")))
           .withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("src")), F.lit(0.0))))
    grid = cum.select("src", "limit", "slots", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * cells), F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1)))).alias("cell"))
    points = (sources.sparkSession.range(n_points).withColumnRenamed("id", "slot")
              .withColumn("u", F.pmod((F.col("slot") + 0.5) * step, F.lit(1.0)))
              .withColumn("cell", F.floor(F.col("u") * cells)))
    hits = (points.join(grid, "cell").where("u >= lo and u < hi")
            .select("src", "limit", "slots", "slot", F.floor(F.col("slot") / CHUNK).alias("chunk")))
    kept = materialise(running_total(materialise(hits, "hits"), ["src"], "chunk", ["slot"], F.lit(1), "k")
                       .where("k < slots").withColumn("whole", F.lit(0)), "slots")
    words = F.least(F.lit(block), F.col("limit") - F.col("k") * block)
    return running_total(kept, ["whole"], "chunk", ["slot"], words, "at").select("src", "k", "slot", "at")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block: int = BLOCK, max_passes: int = 3, seed: int = 0, step: float = GOLDEN) -> DataFrame:
    """``doc_id, size, source, source_size, target, taken, n_slots, first_slot,
    mix_start, places``: one row per input row.

    ``n_slots`` counts the slots that hold words of the document, ``first_slot``
    is the first of them, ``mix_start`` the words of the mix before its first
    word, and ``places`` the same for each pass, in order.  Rows that give
    nothing have no slot and no place.
    """
    sized = materialise(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                    F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size")),
        "sizes")
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), max_passes)
    limit = F.least(F.round("target").cast("long"), F.col("source_size") * max_passes)
    sources = materialise(targets.withColumn("limit", limit).withColumn(
        "slots", F.ceil(F.col("limit") / block).cast("long")), "targets")
    needed, n_sources = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count(F.lit(1))).first()
    points = 2 * needed + 8
    while (plan := materialise(schedule(sources, points, n_sources, block, step), "schedule")).count() < needed:
        points *= 2  # another step than the golden ratio may need more
    sources = sources.select("source", "src", "source_size", "target", "limit")
    n_buckets = buckets_for(sized.count())
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    known = (sized.join(sources.withColumnRenamed("source", "__source"),
                        F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
             .withColumn("__order", order).withColumn("__bucket", F.pmod("__order", F.lit(n_buckets))))
    laid = materialise(
        running_total(materialise(known, "known"), ["src"], "__bucket", ["__order", "doc_id", "size"],
                      F.col("size"), "start").drop("__order", "__bucket"),
        "laid")

    passes = (
        laid.where("size > 0")
        .select("src", "start", "size", "limit", "source_size",
                F.explode(F.array(*[F.lit(i) for i in range(max_passes)])).alias("pass"))
        .withColumn("lo", F.col("pass") * F.col("source_size") + F.col("start"))
        .where("lo < limit")
        .withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("limit")))
    )
    pieces = passes.select("src", "start", "pass", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block))).alias("k"))
    low = F.greatest("lo", F.col("k") * block)
    taken = (pieces.join(plan, ["src", "k"])
             .select("src", "start", "pass", "slot", (F.least("hi", (F.col("k") + 1) * block) - low).alias("words"),
                     (F.col("at") + low - F.col("k") * block).alias("at"))
             .groupBy("src", "start", "pass").agg(
                 F.sum("words").alias("words"), F.min("at").alias("at"), F.min("slot").alias("first"),
                 F.count(F.lit(1)).alias("n"))
             .groupBy("src", "start").agg(  # at most max_passes places
                 F.sum("words").alias("taken"), F.sum("n").alias("n_slots"), F.min("first").alias("first_slot"),
                 F.min("at").alias("mix_start"), F.array_sort(F.collect_list("at")).alias("places")))
    # rows of size 0 share their start with the next document, so they stay out of the join
    some = laid.where("size > 0").join(taken, ["src", "start"], "left")
    none = laid.where("size = 0").select("*", *(F.lit(None).cast(taken.schema[c].dataType).alias(c)
                                                for c in taken.columns[2:]))
    return some.unionByName(none.select(some.columns)).select(
        "doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"),
        F.coalesce("n_slots", F.lit(0)).alias("n_slots"), "first_slot", "mix_start", "places")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, in the order of the mix:
    a row for each whole time that the mix takes the document's words, halves
    rounded up, where that pass begins."""
    key, places, place = (fresh(docs, x) for x in ("__id", "__places", "__place"))
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    copies = (mix(docs).where("taken > 0").withColumn("n", times).where("n > 0")
              .groupBy(F.col("doc_id").alias(key))
              .agg(F.max_by(F.slice("places", F.lit(1), F.col("n")), F.struct("n", "mix_start")).alias(places)))
    return (docs.join(copies, F.col("doc_id").eqNullSafe(F.col(key)))
            .withColumn(place, F.explode(places)).orderBy(place).drop(key, places, place))
