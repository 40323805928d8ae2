"""N-gram Jaccard join by count vectors in an R-tree.

A document's set holds the hashes of its word 5-grams.  Two documents link
when 100 * |A n B| >= 80 * |A u B|; the result names each document's
component under these links.

Count vectors: the hashes fall into ``GROUPS`` groups, and a document is the
point of its group counts.  The sum of coordinate minima of two points bounds
the overlap of their sets from above, and that of two boxes' upper corners
bounds it for all points in them; so an R-tree over the points is joined with
itself, and only pairs whose bound reaches the threshold are verified, with
the whole sets.  Between ``GROUPS`` groups texts look alike that share most of
their shingles and still do not link, so a pair is first held against the same
bound on fine vectors, of ``FINE`` groups a hash or more, however long the texts,
which take a quarter of a set or less.  A tree holds its own pairs against it,
so those of a group of near copies that cannot link are never written out.

Distribution: a tree over all documents would meet most of itself, since
points of unrelated texts of one length lie close.  So each tree covers the
documents that share a *signature* hash, taken by a rule that no linked pair
escapes:

* All documents' shingles stand in one order: rare before frequent, then by
  hash.  A document signs with its first k.  All but d = n - ceil(0.8 n) of A's
  n hashes are shared with a linked B; while the first common hash is not among
  A's first k, those k all belong to the at most d others.  With k = d + 1 that
  is impossible.  Of the r rare ones at least r - d are shared, and among
  themselves they stand by hash, so with the k of ``signature_size`` the chance
  is below 1e-22 per pair - less than that of two different 5-grams having one
  64-bit hash.  A document signs with the smaller of the two numbers.
* Frequent are the at most ``FREQUENT_KNOWN`` shingles that most documents hold
  among the smallest hashes they might sign with, if ``FREQUENT_ROWS`` do.  Any
  such list keeps the rule, since only the order depends on it; a good one keeps
  passages that many documents share out of the signatures.
* Documents with equal sets are one class, represented by its smallest id.

Links are looked for between components.  Every representative is compared with
one leader of each signature it shares (a star, linear in the signatures): the
smallest one first, then others by a hashed order, as long as that finds a
twentieth of all links so far and ``STARS`` times at most.  Few signatures then hold more than one
component; only there trees are built, and only pairs of different components
compared: one pair of every two components first, the rest where these are still
apart.  No pair is lost that would change a component, and no group of near
copies is expanded into all its pairs.

A pair is reported by the tree of the smallest signature that it shares, so
the many trees that hold it write it out once.

A signature shared by more than ``TREE_ROWS`` documents of different
components is dealt out in blocks, every two blocks (and each with itself)
being a tree join of its own, so no task receives an unbounded group.

Defined results: null and empty texts, and texts without words, have an empty
set, link with nothing and are their own component; texts of fewer than five
words have one shingle, all their words; rows that repeat are copies of each
other; rows without an id take part in no link and get no component; an empty
table gives no rows; extra columns are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegraph.llm.common import fresh, materialise, text_or_empty
from pulsegraph.llm.components import components

N = 5
GROUPS = 64
#: chance per linked pair that it shares no signature
MISS = 1e-22
TREE_ROWS = 2048
#: pairs of a cell that one task verifies
CELL_PAIRS = 2048
#: smaller shared signatures that a row of a tree carries
LOWER = 64
#: rounds of stars before the trees
STARS = 3
#: bound of the broadcast list of frequent shingles, 8 bytes each
FREQUENT_KNOWN = 1 << 17
FREQUENT_ROWS = 16
#: of whole sets, 8 bytes a shingle
BLOCK_BYTES = 32 << 20
LEAF = 16
#: bound of the broadcast that filters texts before their sets are built
FILTER_SLOTS = 1 << 20
#: groups a shingle of the fine count vectors, half a byte each
FINE = 2
_ODD = np.uint64(0x9E3779B97F4A7C15)


# -- sets ---------------------------------------------------------------------

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: by byte: no white space; by place in the word (below 64) and byte: what it adds to the word's hash
_INSIDE = np.array([chr(b) not in " \t\n\v\f\r" for b in range(256)])
_PLACED = _mix(np.arange(1, (64 << 8) + 1, dtype=np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the text's words in order, each the sum over its bytes of
    a hash of place and byte.  ``bytes`` lowers A-Z only."""
    raw = np.frombuffer(text.encode("utf-8", "replace").lower(), np.uint8)
    inside = _INSIDE[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    if not len(edges):
        return np.empty(0, np.uint64)
    lengths = edges[1::2] - edges[::2]
    first = np.cumsum(lengths) - lengths
    placed = (np.arange(lengths.sum()) - np.repeat(first, lengths) << 8) + raw[inside]
    values = _PLACED[placed] if lengths.max() <= 64 else _mix(placed.astype(np.uint64) + np.uint64(1))
    return np.add.reduceat(values, first)


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word 5-grams."""
    w = word_hashes(text)
    if len(w) == 0:
        return w
    n = min(N, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = _mix(h * _ODD + w[i:len(w) - n + 1 + i])
    return np.unique(h)


def signature_size(n: int, rare: int) -> int:
    """How many of its n hashes, ``rare`` of them not frequent, a document signs with."""
    others = n - -(-80 * n // 100)
    if others == 0 or rare <= others:
        return others + 1
    return min(others + 1, math.ceil(math.log(MISS) / math.log(others / rare)))


def signature(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first of the set's sorted hashes, rare before frequent."""
    if not len(s):
        return s
    known = np.zeros(len(s), bool)
    if len(frequent):
        known = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
    rare = s[~known]
    k = signature_size(len(s), len(rare))
    return np.concatenate([rare[:k], s[known][:max(k - len(rare), 0)]])


def frequent_shingles(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Sorted hashes of the most frequent shingles among twice the smallest ones of every text."""
    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            found = [np.empty(0, np.uint64)]
            for text in batch.column(0):
                s = shingle_set(text.as_py())
                # a copy, as a view would keep the whole set
                found.append(s[:2 * signature_size(len(s), len(s))].copy() if len(s) else s)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["hash"])

    counts = (docs.select(text_or_empty(text_col)).mapInArrow(batches, "hash bigint")
              .groupBy("hash").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= FREQUENT_ROWS))
    top = counts.orderBy(F.desc("rows"), "hash").limit(FREQUENT_KNOWN).select("hash").toPandas()["hash"]
    return np.sort(top.to_numpy(np.int64).view(np.uint64))


def sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, digest, signature, counts, fine`` of every whole text."""
    id_type = docs.schema[id_col].dataType.simpleString()
    known = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, text_col))

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = known.value
        for batch in stream:
            n, digest, signed, counts, fine = [], [], [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py())
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                signed.append(signature(s, frequent).view(np.int64))
                counts.append(np.bincount((s % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)
                              .astype("<u4").tobytes())
                fine.append(fine_counts(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(signed, pa.list_(pa.int64())), pa.array(counts, pa.binary()), pa.array(fine, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "signature", "counts", "fine"])

    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col)).mapInArrow(
        batches, f"doc_id {id_type}, n_shingles bigint, digest binary, signature array<bigint>, counts binary, fine binary")


def with_sets(rows: DataFrame) -> DataFrame:
    """``rows`` with the packed set of ``text``, their last column, as ``shingles`` in its place.

    Rows of one text stand together after a join, so its set is built once."""
    kept = [c for c in rows.columns if c != "text"]

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, packed = None, b""
        for batch in stream:
            out = []
            for text in batch.column(len(kept)):
                if (text := text.as_py()) != at:
                    at, packed = text, shingle_set(text).tobytes()
                out.append(packed)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.binary())], names=[*kept, "shingles"])

    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.select(*kept, "text").mapInArrow(batches, f"{schema}, shingles binary")


# -- bounds and the tree -------------------------------------------------------

def reaches(overlap: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """100 * overlap >= 80 * union, with ``sizes`` = |A| + |B|."""
    return 180 * overlap >= 80 * sizes


def fine_counts(s: np.ndarray) -> bytes:
    """Counts of the set's hashes in at least ``FINE`` groups a hash, half a byte each;
    empty, which bounds nothing, where a count needs more."""
    groups = GROUPS
    while groups < FINE * len(s):
        groups *= 2
    counts = np.bincount((s % np.uint64(groups)).astype(np.int64), minlength=groups)
    return (counts[::2] | counts[1::2] << 4).astype(np.uint8).tobytes() if counts.max() < 16 else b""


def _unpacked(fine: bytes) -> np.ndarray:
    packed = np.frombuffer(fine, np.uint8)
    return np.stack([packed & 15, packed >> 4], axis=1).ravel()


def may_link(x: bytes, y: bytes) -> bool:
    """Whether two sets of these fine counts may reach the threshold.

    Numbers of groups are powers of two times ``GROUPS``, so the larger one folds onto the smaller."""
    if not x or not y:
        return True
    p, q = _unpacked(x), _unpacked(y)
    groups = min(len(p), len(q))
    p, q = (v.reshape(-1, groups).sum(axis=0, dtype=np.int64) for v in (p, q))
    return bool(reaches(int(np.minimum(p, q).sum()), int(p.sum() + q.sum())))


class Tree:
    """A packed R-tree: leaves of ``LEAF`` points, each level grouping as many boxes below."""

    def __init__(self, points: np.ndarray):
        # size first: the bound depends on it most; then the coordinate that varies most
        widest = points[:, points.var(axis=0).argmax()] if len(points) else points[:, :0]
        self.order = np.lexsort((widest, points.sum(axis=1)))
        points = points[self.order]
        self.levels = [(points, points)]  # lower and upper corners, points first
        while len(self.levels[-1][0]) > 1:
            low, high = self.levels[-1]
            starts = np.arange(0, len(low), LEAF)
            self.levels.append((np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))


def _bounded(a: tuple, i: np.ndarray, b: tuple, j: np.ndarray) -> np.ndarray:
    """Which pairs of boxes may hold a pair of points that reaches the threshold."""
    out = np.empty(len(i), bool)
    for s in range(0, len(i), 1 << 13):
        p, q = i[s:s + (1 << 13)], j[s:s + (1 << 13)]
        overlap = np.minimum(a[1][p], b[1][q]).sum(axis=1, dtype=np.int64)
        sizes = a[0][p].sum(axis=1, dtype=np.int64) + b[0][q].sum(axis=1, dtype=np.int64)
        out[s:s + (1 << 13)] = reaches(overlap, sizes)
    return out


def _children(i: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each entry's children on a level of n boxes, and which entry they are of."""
    counts = np.minimum(n - i * LEAF, LEAF)
    entry = np.repeat(np.arange(len(i)), counts)
    within = np.arange(len(entry)) - np.repeat(np.cumsum(counts) - counts, counts)
    return i[entry] * LEAF + within, entry


def tree_join(a: Tree, b: Tree, chunk: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into the points of a and of b) whose bound reaches the threshold.

    Depth first, ``chunk`` box pairs at a time, so memory stays bounded.
    """
    if not len(a.order) or not len(b.order):
        return
    start = np.zeros(1, np.int64)
    stack = [(len(a.levels) - 1, len(b.levels) - 1, start, start)]
    while stack:
        x, y, i, j = stack.pop()
        keep = _bounded(a.levels[x], i, b.levels[y], j)
        i, j = i[keep], j[keep]
        if x == 0 and y == 0:
            yield a.order[i], b.order[j]
            continue
        for s in range(0, len(i), chunk):
            p, q = i[s:s + chunk], j[s:s + chunk]
            if x >= y:
                p, entry = _children(p, len(a.levels[x - 1][0]))
                stack.append((x - 1, y, p, q[entry]))
            else:
                q, entry = _children(q, len(b.levels[y - 1][0]))
                stack.append((x, y - 1, p[entry], q))


def _small_groups(group: np.ndarray, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within groups of up to a leaf's size: one leaf each, so all their
    points meet directly.  ``group`` is sorted."""
    box = (points, points)
    for shift in range(1, LEAF):
        i = np.flatnonzero(group[shift:] == group[:-shift]) if len(group) > shift else np.empty(0, np.int64)
        if not len(i):
            return
        keep = _bounded(box, i, box, i + shift)
        yield i[keep], i[keep] + shift


# -- links ---------------------------------------------------------------------

CELL = ["cell", "left", "right"]
PART = [*CELL, "part"]


def bounded(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose fine count vectors reach the threshold, with their cells."""
    def bound(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            keep = [may_link(x.as_py(), y.as_py()) for x, y in zip(batch.column(5), batch.column(6))]
            yield batch.select(range(5)).filter(pa.array(keep, pa.bool_()))

    vectors = reps.select("id", "fine")
    schema = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in ("a", "b", *CELL))
    return (pairs.join(vectors.withColumnRenamed("id", "a").withColumnRenamed("fine", "x"), "a")
            .join(vectors.withColumnRenamed("id", "b").withColumnRenamed("fine", "y"), "b")
            .select("a", "b", *CELL, "x", "y").mapInArrow(bound, schema))


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that link, by their whole sets.

    Only the sets of documents in ``pairs`` are built.  A cell holds about
    twice ``BLOCK_BYTES`` of sets; its pairs are dealt out by ``a``, about
    ``CELL_PAIRS`` a part, and a set goes once to each part that has a pair of
    its document.
    """
    known = materialise(pairs, "near")
    if known.isEmpty():
        return known.select("a", "b")
    parts = known.groupBy(*CELL).agg(F.ceil(F.count(F.lit(1)) / CELL_PAIRS).alias("parts"))
    # read five times below
    near = materialise(known.join(parts, CELL).select(
        "a", "b", *CELL, F.pmod(F.xxhash64("a"), "parts").cast("int").alias("part")), "near-parts")
    members = near.select(*PART, F.col("a").alias("id")).union(near.select(*PART, "b")).distinct()
    needed = materialise(members.select("id").distinct(), "needed")
    named = docs.select(F.col("doc_id").alias("id"), text_or_empty().alias("text"))
    # most texts fall at a filter of at most FILTER_SLOTS hash values, before the shuffle by id
    slot = F.pmod(F.xxhash64("id"), F.lit(FILTER_SLOTS))
    slots = needed.select(slot.alias("slot")).distinct()
    some = named.withColumn("slot", slot).join(F.broadcast(slots), "slot", "left_semi").drop("slot")
    # the texts move once, by id; their sets are built beside the list of parts they go to
    whole = some.join(needed, "id", "left_semi").dropDuplicates(["id"])
    id_type = near.schema["a"].dataType.simpleString()
    rows = (with_sets(members.join(whole, "id").select(*PART, "id", "text")).select(*PART, F.lit(False).alias("pair"), "id", F.lit(None).cast(id_type).alias("b"), "shingles")
            .unionByName(near.select(*PART, F.lit(True).alias("pair"), F.col("a").alias("id"), "b",
                                     F.lit(None).cast("binary").alias("shingles"))))

    def links(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cell by cell: first the sets, then the pairs."""
        at, held = None, {}
        for batch in stream:
            out: list[tuple] = []
            cells = zip(*(batch.column(i).to_pylist() for i in range(4)))
            rows = zip(cells, *(batch.column(i).to_pylist() for i in (4, 5, 6)), batch.column(7))
            for cell, pair, a, b, shingles in rows:
                if cell != at:
                    at, held = cell, {}
                if not pair:
                    held[a] = np.frombuffer(shingles.as_py(), np.uint64)
                    continue
                x, y = held[a], held[b]
                near = np.minimum(np.searchsorted(y, x), len(y) - 1)
                if reaches(int((y[near] == x).sum()), len(x) + len(y)):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], batch.schema.field(5).type) for i in (0, 1)], names=["a", "b"])

    return (rows.repartition(*PART).sortWithinPartitions(*PART, "pair")
            .mapInArrow(links, f"a {id_type}, b {id_type}"))


def star_pairs(signatures: DataFrame, turn: int) -> DataFrame:
    """Each representative with one leader of every signature it shares, if that
    is of another component and of a size that may link; a cell is a part of what hangs under a leader.

    The leader is the smallest id in the first turn, and the first by a hash after it."""
    order = F.struct("id", "component", "n") if turn == 0 else F.struct(
        F.xxhash64(F.lit(turn), "id").alias("by"), "id", "component", "n")
    leaders = (signatures.groupBy("hash").agg(F.min(order).alias("first"), F.min("component").alias("low"),
                                              F.max("component").alias("high"))
               .where("low < high").select("hash", F.col("first.id").alias("a"), F.col("first.component").alias("of"),
                                             F.col("first.n").alias("of_n")))
    alike = 100 * F.least("n", "of_n").cast("long") >= 80 * F.greatest("n", "of_n").cast("long")
    pairs = materialise(signatures.join(leaders, "hash").where("component != of").where(alike)
                        .groupBy("a", F.col("id").alias("b")).agg(F.min("n").alias("n")), "star-pairs")
    parts = pairs.groupBy("a").agg(_blocks(F.sum("n"), F.count(F.lit(1))).alias("blocks"))
    return pairs.join(parts, "a").select("a", "b", F.col("a").cast("string").alias("cell"), F.lit(0).alias("left"),
                                         F.pmod(F.xxhash64("b"), "blocks").cast("int").alias("right"))


def _blocks(shingles: Column, rows: Column) -> Column:
    """Into how many blocks a group is dealt out, so that one has about
    ``TREE_ROWS`` documents and ``BLOCK_BYTES`` of sets at most."""
    return F.ceil(F.greatest(rows / TREE_ROWS, shingles * 8 / BLOCK_BYTES)).cast("int")


def cross_pairs(known: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs of different components that share a signature and whose bounds
    reach the threshold, by tree joins."""
    mixed = (known.groupBy("hash").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                       _blocks(F.sum("n"), F.count(F.lit(1))).alias("blocks"))
             .where("low < high").select("hash", "blocks"))
    rows = known.join(mixed, "hash")
    # at most signature_size hashes each; a pair that shares only others below its
    # hash comes more than once
    shared = rows.groupBy("id").agg(F.collect_list("hash").alias("shared"))
    rows = (rows.join(reps.join(shared, "id"), "id")
            .withColumn("lower", F.slice(F.array_sort(F.filter("shared", lambda x: x < F.col("hash"))), 1, LOWER)))
    # block i meets blocks i.. as the left side and blocks ..i as the right one
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least(own, other).alias("left"), F.greatest(own, other).alias("right")))
    tasks = (rows.withColumn("own", own).withColumn("meet", F.explode(meets))
             .select("hash", "meet.left", "meet.right", "own", "id", "component", "counts", "fine", "lower"))
    id_type = reps.schema["id"].dataType.simpleString()

    def join_groups(table: pa.Table) -> pa.Table:
        h, left, right, own = (table.column(c).to_numpy() for c in ("hash", "left", "right", "own"))
        ids, comp = table.column("id"), table.column("component").to_numpy()
        points = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<u4").reshape(-1, GROUPS)
        new = np.r_[True, (h[1:] != h[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])]
        group = np.cumsum(new) - 1
        starts = np.r_[np.flatnonzero(new), len(h)]
        sizes = np.diff(starts)
        small = np.flatnonzero(sizes[group] <= LEAF)
        lists, lower = table.column("lower").combine_chunks(), {}
        fine = table.column("fine").to_pylist()
        found = []

        def lower_of(x: int) -> frozenset:
            if x not in lower:
                lower[x] = frozenset(lists[x].as_py())
            return lower[x]

        def report(i: np.ndarray, j: np.ndarray) -> None:
            """Most pairs of a hot group lie in one component; none of those is kept."""
            keep = comp[i] != comp[j]
            i, j = i[keep], j[keep]
            first = np.fromiter((lower_of(x).isdisjoint(lower_of(y)) and may_link(fine[x], fine[y])
                                 for x, y in zip(i.tolist(), j.tolist())), bool, len(i))
            found.append((i[first], j[first]))

        # small groups of two blocks hold pairs of one block too; those come again from its own
        for i, j in _small_groups(group[small], points[small]):
            report(small[i], small[j])
        for g in np.flatnonzero(sizes > LEAF):
            rows = np.arange(starts[g], starts[g + 1])
            if left[rows[0]] == right[rows[0]]:
                sides = rows, rows
            else:
                sides = rows[own[rows] == left[rows]], rows[own[rows] == right[rows]]
            trees = [Tree(points[s]) for s in sides]
            for i, j in tree_join(*trees):
                report(sides[0][i], sides[1][j])
        i = np.concatenate([np.empty(0, np.int64), *(f[0] for f in found)])
        j = np.concatenate([np.empty(0, np.int64), *(f[1] for f in found)])
        return pa.table({"a": ids.take(pa.array(i)), "b": ids.take(pa.array(j)), "hash": h[i], "left": left[i],
                         "right": right[i]})

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole groups at a time: what may go on in the next batch waits."""
        waiting: list[pa.RecordBatch] = []
        for batch in stream:
            if not batch.num_rows:
                continue
            keys = [batch.column(i).to_numpy() for i in range(3)]
            same = np.logical_and.reduce([k == k[-1] for k in keys])
            cut = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield from join_groups(pa.Table.from_batches([*waiting, batch.slice(0, cut)])).to_batches()
                waiting = []
            waiting.append(batch.slice(cut))
        if waiting:
            yield from join_groups(pa.Table.from_batches(waiting)).to_batches()

    pairs = (tasks.repartition("hash", "left", "right").sortWithinPartitions("hash", "left", "right")
             .mapInArrow(batches, f"a {id_type}, b {id_type}, hash bigint, left int, right int"))
    # a pair is reported under the smallest signature it shares, whose tree is its
    # cell; trees of two blocks may repeat what those of one block report
    return (pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .agg(F.min(F.struct("hash", "left", "right")).alias("m"))
            .select("a", "b", F.col("m.hash").cast("string").alias("cell"), "m.left", "m.right"))


def with_components(signatures: DataFrame, component: DataFrame | None) -> DataFrame:
    """``hash, id, n, component``; without links everything is its own component."""
    if component is None:
        return signatures.withColumn("component", F.col("id"))
    return signatures.join(component, "id", "left").select(
        "hash", "id", "n", F.coalesce("component", "id").alias("component"))


def apart_pairs(pairs: DataFrame, component: DataFrame) -> DataFrame:
    """The pairs of two components, with these (``low, high``)."""
    of_a, of_b = (component.select(F.col("id").alias(x), F.col("component").alias(f"of_{x}")) for x in "ab")
    both = (pairs.join(of_a, "a", "left").join(of_b, "b", "left")
            .withColumn("of_a", F.coalesce("of_a", "a")).withColumn("of_b", F.coalesce("of_b", "b")))
    return both.where("of_a != of_b").select(
        *pairs.columns, F.least("of_a", "of_b").alias("low"), F.greatest("of_a", "of_b").alias("high"))


def joined(component: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components after some more links: those that the links touch are merged."""
    if component is None:
        return materialise(components(links), "component")
    if links.isEmpty():
        return component
    roots = components(apart_pairs(links, component).select(F.col("low").alias("a"), F.col("high").alias("b")))
    ends = links.select(F.explode(F.array("a", "b")).alias("id")).select("id", F.col("id").alias("component"))
    known = component.unionByName(ends).groupBy("id").agg(F.min("component").alias("was"))
    roots = roots.withColumnRenamed("id", "was")
    return materialise(known.join(roots, "was", "left").select(
        "id", F.coalesce("component", "was").alias("component")), "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per input row."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    all_sets = materialise(sets(docs), "sets")
    some = all_sets.where("n_shingles > 0 and doc_id is not null")
    classes = materialise(some.groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"),
        F.first("counts").alias("counts"), F.first("fine").alias("fine")), "classes")
    reps = classes.select("id", "counts", "fine")
    signatures = materialise(classes.select("id", F.col("n").cast("int").alias("n"), F.explode("signature").alias("hash")), "signatures")
    component, links = None, 0
    for turn in range(STARS):
        pairs = star_pairs(with_components(signatures, component), turn)
        star = materialise(verified(bounded(pairs, reps), docs), "star")
        component = joined(component, star)
        new = star.count()
        links += new
        if 20 * new < links:
            break
    cross = materialise(cross_pairs(with_components(signatures, component), reps), "cross")
    first = materialise(apart_pairs(cross, component).groupBy("low", "high").agg(
        F.min(F.struct("a", "b", *CELL)).alias("m")).select("m.*"), "first")
    component = joined(component, materialise(verified(first, docs), "links"))
    rest = apart_pairs(cross, component).drop("low", "high").join(first.select("a", "b"), ["a", "b"], "left_anti")
    final = joined(component, materialise(verified(rest, docs), "links"))
    of_class = classes.select("digest", "id").join(final, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component"))
    return (all_sets.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") == 0, F.col("doc_id"))
                    .when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with all their columns."""
    key = fresh(docs, "__id")
    keep = near_duplicates(docs).where("doc_id = component_id or component_id is null").select(
        F.col("doc_id").alias(key)).distinct()
    return docs.join(keep, F.col("doc_id").eqNullSafe(F.col(key)), "left_semi")
