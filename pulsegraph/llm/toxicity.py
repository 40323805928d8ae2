"""Toxicity by compression distance: two zstandard dictionaries.

Training (on a bounded sample of labelled rows, see ``TrainingBounds``):

* The ordinary dictionary is trained by zstandard on ordinary text.
* The toxic dictionary is trained by zstandard on the part of toxic text that
  sets it apart: words whose share of toxic documents is well above their
  share of ordinary ones.  The ordinary dictionary follows it, so both say the
  same about ordinary wording, and a window compresses better with the toxic
  one only where it holds toxic wording.
* Thresholds are calibrated on the half of the sample that the dictionaries
  have not seen: the gain from which, and the compressed length up to which, a
  window counts as a hit, and a logistic curve from the document's hits to a
  score between 0 and 1.

Scoring: every text is cut, whole, into words (at most ``WORD_BYTES`` at a
time).  A window is a word within a fixed phrase that both dictionaries hold,
so zstandard's fixed costs are the same in every window.  Its gain is its
compressed length with the ordinary dictionary minus that with the toxic one;
its cost is what the word adds to the phrase with the toxic one.  Scoring is a
map over Arrow batches with a bounded cache of windows; nothing is shuffled,
and the model (some ten kilobytes) travels with the task.  Labels, language,
source and id are no input of a score.

Defined results: null and empty texts have no hits and get the curve's base
score; without labelled rows of both kinds every score is 0; rows that repeat
are scored each; repeated or conflicting labels count as toxic if any is;
extra columns are ignored, whatever they are called.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from pulsegraph.llm.common import fresh, text_or_empty

WORD_BYTES = 64
LEVEL = 6
#: bytes of the ordinary dictionary on either side of a window's word; zstandard
#: starts no match in the last eight bytes of its input
PHRASE_BYTES = 24
#: windows that a task remembers
CACHE_WINDOWS = 400_000
_BLANK = re.compile(r"[\t\n\v\f\r]")
_WORD = re.compile(rb"[^\s.,;:!?\"'()\[\]{}|*#$%&<>=/+]{1,64}")


@dataclass(frozen=True)
class TrainingBounds:
    """What is fetched to train the model, at any input size."""

    rows_per_label: int = 3000
    chars_per_row: int = 16_384
    dictionary_bytes: int = 16_384


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    limits: tuple[tuple[int, int], ...]  # kinds of hits: (least gain, most cost)
    curve: tuple[float, ...]  # base; for each kind, per log count and per log share of hits

    def scorer(self) -> Callable[[str], float]:
        window = windows(self.ordinary, self.toxic)
        cache: dict[str, tuple[int, ...] | None] = {}
        sizes: dict[str, int] = {}  # words of the chunks in the cache

        def add(chunk: str) -> None:
            own = words(chunk)
            found = _hits([window(w) for w in own], self.limits)
            cache[chunk], sizes[chunk] = found if any(found) else None, len(own)

        def score(text: str) -> float:
            n, of_all = np.zeros(len(self.limits)), 0
            for chunks in pieces(text):
                new = set(chunks).difference(cache)
                if len(cache) + len(new) > CACHE_WINDOWS:
                    cache.clear()
                    sizes.clear()
                    new = set(chunks)
                for chunk in new:
                    add(chunk)
                for found in filter(None, map(cache.__getitem__, chunks)):
                    n += found
                of_all += sum(map(sizes.__getitem__, chunks))
            return float(1 / (1 + np.exp(-np.dot(self.curve, _features(n, of_all)))))

        return score


def pieces(text: str, chars: int = 1 << 20) -> Iterator[list[str]]:
    """The whole text, lower-cased and cut at spaces, about ``chars`` at a time."""
    i = 0
    while i < len(text):
        j = text.find(" ", i + chars) if len(text) - i > chars else -1
        piece, i = (text[i:], len(text)) if j < 0 else (text[i:j], j)
        yield _BLANK.sub(" ", piece.lower()).split(" ")


def words(chunk: str) -> list[bytes]:
    return _WORD.findall(chunk.encode("utf-8", "replace"))


def windows(ordinary: bytes, toxic: bytes) -> Callable[[bytes], tuple[int, int]]:
    """word -> (gain, cost)."""
    def compressor(content: bytes) -> zstandard.ZstdCompressor:
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=data, level=LEVEL, write_checksum=False,
                                        write_content_size=False, write_dict_id=False)

    a, b = compressor(ordinary).compress, compressor(toxic).compress
    phrase = ordinary[-2 * PHRASE_BYTES:].rjust(2 * PHRASE_BYTES, b" ")
    before, after = phrase[:PHRASE_BYTES] + b" ", b" " + phrase[PHRASE_BYTES:]
    empty = len(b(before + after))

    def window(word: bytes) -> tuple[int, int]:
        data = before + word + after
        cost = len(b(data))
        return len(a(data)) - cost, cost - empty

    return window


def _hits(found: list[tuple[int, int]], limits: tuple[tuple[int, int], ...]) -> tuple[int, ...]:
    return tuple(sum(gain >= g and cost <= c for gain, cost in found) for g, c in limits)


def _features(hits: Iterable[float], of_all: int) -> np.ndarray:
    hits = np.asarray(hits, float)
    return np.concatenate(([1.0], np.log1p(hits), np.log1p(100 * hits / max(1, of_all))))


def _train(samples: list[bytes], size: int) -> bytes:
    """zstandard's dictionary for ``samples``; the samples themselves if they are too few to train on."""
    joined = b" ".join(samples)
    if len(joined) <= size:
        return joined.ljust(64)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return joined[-size:]


def distinctive(toxic: list[str], ordinary: list[str], min_rows: int = 2, min_share: float = 0.005,
                ratio: float = 12.0) -> set[bytes]:
    """Words of at least ``min_share`` of the toxic texts, at least ``ratio`` times their share of ordinary ones."""
    counts = [Counter(w for t in texts for w in set(words(t.lower()))) for texts in (toxic, ordinary)]
    share = {w: n / len(toxic) for w, n in counts[0].items() if n >= min_rows}
    return {w for w, s in share.items()
            if s >= min_share and s >= ratio * (counts[1][w] + 1) / (len(ordinary) + 1)}


def fit(rows: list[tuple[str, int]], bounds: TrainingBounds = TrainingBounds()) -> ToxicityModel | None:
    """``rows``: (text, toxic 0/1).  Every other row of each label trains the
    dictionaries, the others calibrate.  None if a label is missing."""
    texts = [[t for t, y in rows if y == label] for label in (0, 1)]
    if not texts[0] or not texts[1]:
        return None
    seen = [ts[::2] for ts in texts]
    unseen = [ts[1::2] or ts for ts in texts]
    base = _train([b" " + c.lower().encode("utf-8", "replace") + b" "
                   for t in seen[0] for c in (t[i:i + 64] for i in range(0, len(t), 64))], bounds.dictionary_bytes)
    apart = distinctive(seen[1], seen[0])
    samples = [b" " + b" ".join(own) + b" " for t in seen[1] if (own := [w for w in words(t.lower()) if w in apart])]
    toxic = _train(samples, bounds.dictionary_bytes // 8) + base if samples else base
    return calibrate(base, toxic, [(t, y) for y in (0, 1) for t in unseen[y]])


def calibrate(base: bytes, toxic: bytes, held: list[tuple[str, int]]) -> ToxicityModel:
    """The kinds of hits with the least log loss - one kind, then a second
    beside it - and their logistic curve by Newton's method."""
    window, known = windows(base, toxic), {}
    texts = [words(t.lower()) for t, _ in held]
    for w in set().union(*texts):
        gain, cost = window(w)
        if gain > 0:
            known[w] = gain, cost
    of_text = [([known[w] for w in ws if w in known], len(ws)) for ws in texts]
    y = np.array([label for _, label in held], float)

    def curve(limits: tuple[tuple[int, int], ...]) -> tuple[float, tuple[float, ...]]:
        x = np.array([_features(_hits(found, limits), n) for found, n in of_text])
        w, ridge = np.zeros(x.shape[1]), 1e-1
        for _ in range(30):
            p = 1 / (1 + np.exp(-x @ w))
            w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)),
                                    x.T @ (y - p) - ridge * w)
        p = np.clip(1 / (1 + np.exp(-x @ w)), 1e-9, 1 - 1e-9)
        return -float(np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))), tuple(map(float, w))

    grid = [(g, c) for g in range(1, 6) for c in (3, 4, 5, 7, 10, 99)]
    first = min(grid, key=lambda limit: curve((limit,))[0])
    limits = min(((first, second) for second in grid), key=lambda both: curve(both)[0])
    return ToxicityModel(base, toxic, limits, curve(limits)[1])


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, bounds: TrainingBounds = TrainingBounds()) -> ToxicityModel | None:
    """Fit on at most ``rows_per_label`` rows of each label, chosen by hash of
    the id among the rows that are not held out."""
    known = (labels.where(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64(F.lit("toxicity"), F.col("doc_id"))
    chosen = [known.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(bounds.rows_per_label)
              for label in (0, 1)]
    sample = chosen[0].unionByName(chosen[1])  # at most 2 * rows_per_label narrow rows
    rows = (docs.select("doc_id", F.substring(text_or_empty(), 1, bounds.chars_per_row).alias("text"))
            .join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
            .orderBy(order, "doc_id").select("text", "toxic").collect())
    return fit([(r.text, r.toxic) for r in rows], bounds)


def score(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text",
          keep: tuple[str, ...] = ("doc_id",), out: str = "score") -> DataFrame:
    """``keep`` columns and the score of each row's whole text."""
    n = len(keep)

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer() if model else lambda _: 0.0
        for batch in stream:
            # one text at a time is a Python string: a batch may hold many MB of them
            scores = [of(t.as_py() or "") for t in batch.column(n)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), pa.array(scores, pa.float64())],
                                             names=[*keep, out])

    schema = StructType([docs.schema[c] for c in keep]).add(out, DoubleType())
    return docs.select(*[docs[c] for c in keep], docs[text_col].cast("string").alias(fresh(docs, "__text"))).mapInArrow(batches, schema)


def classify(docs: DataFrame, labels: DataFrame, bounds: TrainingBounds = TrainingBounds()) -> DataFrame:
    """``doc_id, held_out, score, predicted``: one row per input row."""
    scored = score(docs, train(docs, labels, bounds))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    columns = tuple(docs.columns)
    name = fresh(docs, "__score")
    return score(docs, train(docs, labels), keep=columns, out=name).where(F.col(name) < 0.5).drop(name)
