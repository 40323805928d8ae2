"""Document fingerprints: 64-bit SimHash (DataFrame functions only).

Terms are pairs of neighbouring lower-cased words (the last word also stands
alone).  Each occurrence of a term votes with its 64-bit hash: a set bit +1, a
clear bit -1, times the term's weight - its length up to ``MAX_WEIGHT``
letters, so that short function words count less.  A fingerprint bit is the
sign of its votes.

Votes are counted inside whole-stage code: one sum holds two 32-bit lanes, so
32 sums give all 64 bits, and terms are never shuffled - they are summed where
their document is.

``within_radius`` finds all fingerprints within a Hamming radius of query
fingerprints by permuted block tables: cut into ``blocks`` pieces, two
fingerprints that differ in at most ``radius`` bits agree in ``blocks -
radius`` pieces, so each choice of that many pieces is a table with an
equi-join on it.  Equal fingerprints meet once, as a class.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegraph.llm.common import materialise, row_key, text_or_empty

BITS = 64
MAX_WEIGHT = 12
_LANES = (1 << 32) | 1
_LOW = (1 << 32) - 1


def terms(text: Column) -> Column:
    """Array of (word, next word); the last word has no next one.

    Words are cut at ASCII white space, letters A-Z lowered.
    """
    words = F.split(F.translate(F.trim(F.translate(text, "\t\n\u000b\f\r", "     ")),
                                "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), " +")
    return F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), F.size(words)).alias("b"))


def term_votes(term: Column) -> list[Column]:
    """The 32 two-lane sums over a document's terms, and the sum of weights."""
    a, b = term["a"], term["b"]
    weight = F.least(F.lit(MAX_WEIGHT), F.length(a) + F.coalesce(F.length(b), F.lit(0)) + 1).cast("long")
    h = F.xxhash64(a, b)
    lanes = [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_LANES)) * weight).alias(f"v{j}")
             for j in range(32)]
    return [*lanes, F.sum(weight).alias("total")]


def fingerprint_bits() -> Column:
    """The fingerprint as a long, from the columns of ``term_votes``."""
    def bit(j: int) -> Column:
        lane = F.col(f"v{j % 32}")
        votes = lane.bitwiseAND(F.lit(_LOW)) if j < 32 else F.shiftrightunsigned(lane, 32)
        return F.when(votes * 2 > F.col("total"), F.shiftleft(F.lit(1).cast("long"), j)).otherwise(F.lit(0))

    return reduce(Column.bitwiseOR, map(bit, range(BITS)))


def hex_bits(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def fingerprints(docs: DataFrame, keys: list[str], texts: dict[str, str]) -> DataFrame:
    """``keys`` and one long column per entry of ``texts`` (name -> text column).

    ``keys`` must tell rows with different texts apart; rows with equal keys
    are one document.
    """
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).alias("text"))
                               for n, c in texts.items()]))
    votes = (docs.select(*keys, each.alias("t"))
             .select(*keys, "t.name", F.explode(terms(F.col("t.text"))).alias("term"))
             .groupBy(*keys, "name").agg(*term_votes(F.col("term")))
             .select(*keys, "name", fingerprint_bits().alias("bits")))
    return votes.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == n, F.col("bits"))).alias(n)
                                      for n in texts])


def following(sizes: DataFrame) -> DataFrame:
    """``key, next_key, take``: the following id (after the last: the first)
    and how many code points the edit of ``key`` takes from it.

    ``sizes``: ``key, doc_id, n_chars``.  Ids are range-partitioned; only the
    first and last id of each range meet in one task.
    """
    ids = sizes.groupBy("key", "doc_id").agg(F.max("n_chars").alias("n_chars"))
    ranged = materialise(ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "ids")
    inside = ranged.withColumn("inner", F.lead("key").over(
        Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first())))
    firsts = ranged.groupBy("part").agg(F.min_by("key", F.struct("doc_id")).alias("key"))
    by_part = Window.orderBy("part")
    everything = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    borders = firsts.select("part", F.coalesce(F.lead("key").over(by_part),
                                               F.first("key").over(everything)).alias("outer"))
    return inside.join(borders, "part").select(
        "key", F.coalesce("inner", "outer").alias("next_key"),
        F.floor(F.col("n_chars") / 4).cast("int").alias("take"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and how alike they are.

    The edit replaces a text's last quarter (floor) of code points by the
    first as many (or all) of the next document's.  Whole texts are shuffled
    once, by id; to the id before goes only the part that its edit takes.

    Defined results: null text counts as empty; a null id comes first in the
    order; rows that repeat id and text are one document; an id with several
    texts has a row for each, and lends to the id before the text part, and
    the fingerprint, that is smallest; a lone document follows itself.
    """
    id_type = docs.schema[id_col].dataType
    # key and text alone, so both joins below share one exchange of the texts
    own = docs.select(row_key(id_col).alias("key"), text_or_empty(text_col).alias("text"))
    sizes = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col).alias("key"),
                        F.length(text_or_empty(text_col)).cast("long").alias("n_chars"))
    links = materialise(following(sizes), "links")
    lent = (own.join(links.select(F.col("next_key").alias("key"), F.col("key").alias("to"), "take"), "key")
            .groupBy("to").agg(F.min(F.expr("left(text, take)")).alias("head")))
    edited = (own.join(lent.withColumnRenamed("to", "key"), "key", "left")
              .withColumn("doc_id", F.nullif("key", F.lit("")).cast(id_type))
              .withColumn("n_chars", F.length("text").cast("long"))
              .withColumn("quarter", F.floor(F.col("n_chars") / 4).cast("int"))
              .withColumn("edited", F.expr("concat(left(text, n_chars - quarter), left(coalesce(head, ''), quarter))"))
              .withColumn("text_sha", F.sha2("text", 256)).withColumn("edited_sha256", F.sha2("edited", 256)))
    keys = ["key", "doc_id", "n_chars", "text_sha", "edited_sha256"]
    prints = materialise(fingerprints(edited, keys, {"own": "text", "edit": "edited"}), "prints")
    after = (links.select("key", "next_key")
             .join(prints.groupBy(F.col("key").alias("next_key")).agg(F.min("own").alias("next_own")), "next_key"))
    return prints.join(after.drop("next_key"), "key").select(
        "doc_id", "n_chars", "edited_sha256",
        hex_bits(F.col("own")).alias("fingerprint"), hex_bits(F.col("edit")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edit")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"))


def _piece(bits: Column, i: int, blocks: int) -> Column:
    lo, hi = BITS * i // blocks, BITS * (i + 1) // blocks
    return F.shiftrightunsigned(bits, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """All pairs ``query, print, distance`` of distinct fingerprints (long
    column ``bits`` in both tables) at a Hamming distance up to ``radius``.

    Exact: ``blocks`` choose ``radius`` tables, each keyed by the pieces that
    agree.  A pair that several tables find is reported by the first of them.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("radius must be below the number of blocks")
    tables = list(combinations(range(blocks), blocks - radius))

    def tabled(df: DataFrame) -> DataFrame:
        rows = F.array(*[F.struct(F.lit(t).alias("table"), F.xxhash64(*[_piece(F.col("bits"), i, blocks) for i in pieces]).alias("slot"))
                         for t, pieces in enumerate(tables)])
        return df.select("bits").distinct().select("bits", F.explode(rows).alias("r")).select("bits", "r.*")

    differs = F.col("query").bitwiseXOR(F.col("print"))
    agree = [reduce(Column.__and__, [_piece(differs, i, blocks) == 0 for i in pieces]) for pieces in tables]
    first = F.coalesce(*[F.when(a, F.lit(t)) for t, a in enumerate(agree)])
    return (tabled(queries).withColumnRenamed("bits", "query")
            .join(tabled(prints).withColumnRenamed("bits", "print"), ["table", "slot"])
            .withColumn("distance", F.bit_count(differs))
            .where((F.col("distance") <= radius) & (F.col("table") == first))
            .select("query", "print", "distance"))
