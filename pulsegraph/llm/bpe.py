"""BPE encoding and decoding by speculation and verification.

For a tokenizer file with word ends (``word_bpe_49k.json``) the result equals
the tokenizers library's ``encode(add_special_tokens=False)`` without
truncation or padding and ``decode(skip_special_tokens=False)``.

* Propose: greedy longest match over the tokens that plain merging can reach.
* Verify: a token sequence is what BPE makes of its word exactly when no
  merge can ever cross a border between neighbours.  All distinct adjacent
  pairs of a batch are checked together in numpy: both tokens are taken apart
  merge by merge, latest first, and at every moment the two symbols that touch
  must have no merge that would have come first.
* Only words with a failing pair (or without a greedy cover) are merged
  exactly: short ones together in numpy, long ones with a heap, in O(n log n)
  for a word of n bytes.

Tasks read Arrow batches, walk a text in pieces cut at spaces, and keep
bounded caches of what they have encoded.  Nothing is shuffled.

Letters and digits are those of the ``regex`` module's Unicode version; a code
point that the tokenizers library's older version does not know yet may be
split otherwise there (of U+0000-U+2FFFF, 2,038 with the versions used here,
none of them in use before 2024).

Defined results: null and empty text give no tokens, decoded as ''; rows that
repeat are encoded each; an empty table gives no rows; columns other than the
ones named in ``keep`` are ignored, whatever they are called.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from pulsegraph.llm.common import fresh

WORD_END = "</w>"
#: stands behind the last byte of a word while tokens are looked up (bytes are read as Latin-1)
END = "Ā"
NEVER = np.int64(1) << 40

#: what stands between spaces, and words, that a task keeps encoded
CACHE_CHUNKS = 250_000
CACHE_WORDS = 100_000
#: characters that are split at a time
PIECE_CHARS = 1 << 20
#: rows that are encoded before they are sent on
BATCH_ROWS = 500
#: failing words up to this length are merged together, longer ones with a heap each
TOGETHER_CHARS = 64


def byte_characters() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 characters stand for their own
    byte, the other bytes for the characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Cache:
    """What a task has encoded: chunks between spaces, and words."""

    def __init__(self) -> None:
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}


class WordBpe:
    """A byte-level BPE tokenizer whose words end in a marked token."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["end_of_word_suffix"] != WORD_END or spec["decoder"] is not None:
            raise ValueError("this encoder reads tokenizers with word ends and no decoder")
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.size = len(vocab | self.special)
        if {*vocab.values(), *self.special.values()} != set(range(self.size)):
            raise ValueError("token ids must run from 0 without gaps")
        self.names = np.full(self.size, "", object)
        for name, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = name

        # merges: rank by pair, and how each token came about
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        self.rank = np.full(self.size, -1, np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        a = np.array([vocab[x] for x, _ in pairs], np.int64)
        b = np.array([vocab[y] for _, y in pairs], np.int64)
        made = np.array([vocab[x + y] for x, y in pairs], np.int64)
        ranks = np.arange(len(pairs))
        if len(set(made.tolist())) < len(made) or (self._rank_after(made, ranks, a, b)).any():
            raise ValueError("each merge must make a new token of earlier ones")
        self.left[made], self.right[made], self.rank[made] = a, b, ranks
        self.made = made
        key = a * self.size + b
        order = np.argsort(key)
        self.keys, self.key_ranks = key[order], ranks[order]
        self.merge = dict(zip(zip(a.tolist(), b.tolist()), zip(ranks.tolist(), made.tolist())))

        # tokens that merging their own bytes yields; others can't be proposed
        whole = self.compatible(a, b, ranks, ranks - 1)
        reach = np.ones(self.size, bool)
        for x, y, t, ok in zip(a.tolist(), b.tolist(), made.tolist(), whole.tolist()):
            reach[t] = ok and reach[x] and reach[y]
        alphabet = byte_characters()
        ids: dict[str, int] = {}
        self.base: dict[str, int] = {}
        for name, i in vocab.items():
            ends = name.endswith(WORD_END) and len(name) > len(WORD_END)
            body = "".join(chr(alphabet[c]) for c in (name[: -len(WORD_END)] if ends else name))
            text = body + END if ends else body
            if reach[i]:
                ids[text] = i
            if len(body) == 1:
                self.base[text] = i
        #: every beginning of a token; -1 for those that are no token themselves
        self.tokens = {t[:j]: -1 for t in ids for j in range(1, len(t))} | ids
        self.special_split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))

    def _rank_after(self, made, ranks, a, b):
        rank_of = np.full(self.size, -1, np.int64)
        rank_of[made] = ranks
        return (rank_of[a] >= ranks) | (rank_of[b] >= ranks)

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, until_a=None, until_b=None) -> np.ndarray:
        """For each pair of neighbours: does no merge ever cross their border?

        ``until_a``: the rank at which the left symbol is merged into more;
        a crossing merge comes first if its rank is lower.  ``until_b``: the
        same on the right, where a crossing merge of equal rank comes first
        too, since it lies further left.
        """
        good = np.ones(len(a), bool)
        at = np.arange(len(a))
        a, b = a.copy(), b.copy()
        until_a = np.full(len(a), NEVER - 1) if until_a is None else until_a.copy()
        until_b = np.full(len(a), NEVER - 1) if until_b is None else until_b.copy()
        while len(at):
            rank = self.pair_rank(a, b)
            crosses = (rank < until_a) & (rank <= until_b)
            good[at[crosses]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~crosses & ((ra >= 0) | (rb >= 0))
            at, a, b, ra, rb, until_a, until_b = (x[go] for x in (at, a, b, ra, rb, until_a, until_b))
            undo_a = ra > rb  # the later merge is undone first
            until_a = np.where(undo_a, ra, until_a)
            until_b = np.where(undo_a, until_b, rb)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return good

    def propose(self, word: str) -> list[int] | None:
        """Greedy longest match over ``word`` (Latin-1 bytes and END); None if it gets stuck."""
        out, i, n, token = [], 0, len(word), self.tokens.get
        while i < n:
            best, j = -1, i + 1
            while j <= n and (t := token(word[i:j])) is not None:
                if t >= 0:
                    best, end = t, j
                j += 1
            if best < 0:
                return None
            out.append(best)
            i = end
        return out

    def merge_exactly(self, word: str) -> list[int]:
        """Lowest rank first, leftmost among equals."""
        parts = [*word[:-2], word[-2:]]
        ids = [self.base[p] for p in parts]
        n, merge = len(ids), self.merge
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, x, y, new = heapq.heappop(heap)
            j = after[i] if ids[i] == x else -1
            if j < 0 or ids[j] != y:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q >= 0 and (m := merge.get((ids[p], ids[q]))):
                    heapq.heappush(heap, (m[0], p, ids[p], ids[q], m[1]))
        return [t for t in ids if t >= 0]

    def merge_together(self, words: list[str]) -> list[list[int]]:
        """``merge_exactly`` for many short words at once: every round makes
        the next merge of each word (lowest rank, leftmost) in numpy."""
        ids = np.array([self.base[p] for w in words for p in (*w[:-2], w[-2:])], np.int64)
        word = np.repeat(np.arange(len(words)), [len(w) - 1 for w in words])
        done_ids, done_words = [], []
        while len(ids):
            rank = np.full(len(ids), NEVER)
            rank[:-1] = np.where(word[1:] == word[:-1], self.pair_rank(ids[:-1], ids[1:]), NEVER)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(ids)])
            more = np.repeat(lowest < NEVER, sizes)
            done_ids.append(ids[~more])
            done_words.append(word[~more])
            hits = np.flatnonzero(more & (rank == np.repeat(lowest, sizes)))
            hits = hits[np.r_[True, word[hits[1:]] != word[hits[:-1]]]] if len(hits) else hits
            ids[hits] = self.made[rank[hits]]
            more[hits + 1] = False
            ids, word = ids[more], word[more]
        ids, word = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return np.split(ids[order], np.cumsum(np.bincount(word, minlength=len(words)))[:-1])

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Token ids of each word, packed as little-endian unsigned 32-bit integers."""
        marked = [w.encode().decode("latin-1") + END for w in words]
        proposed = [self.propose(w) for w in marked]
        lengths = np.fromiter((len(p) if p else 1 for p in proposed), np.int64, len(proposed))
        flat = np.fromiter((t for p in proposed for t in (p or (0,))), np.int64, int(lengths.sum()))
        word_of = np.repeat(np.arange(len(words)), lengths)
        inner = np.flatnonzero(word_of[1:] == word_of[:-1])
        pairs, which = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)[which]
        failed = np.zeros(len(words), bool)
        failed[word_of[inner[~good]]] = True
        failed[[i for i, p in enumerate(proposed) if p is None]] = True
        packed = flat.astype("<u4").tobytes()
        ends = np.cumsum(lengths) * 4
        out = [packed[e - 4 * n:e] for e, n in zip(ends.tolist(), lengths.tolist())]
        failing = np.flatnonzero(failed).tolist()
        short = [i for i in failing if len(marked[i]) <= TOGETHER_CHARS]
        if short:
            for i, ids in zip(short, self.merge_together([marked[i] for i in short])):
                out[i] = ids.astype("<u4").tobytes()
        for i in failing:
            if len(marked[i]) > TOGETHER_CHARS:
                out[i] = np.array(self.merge_exactly(marked[i]), "<u4").tobytes()
        return out

    def chunks(self, text: str) -> Iterator[list[str]]:
        """``text`` (no special tokens in it) cut at spaces and line ends, piece
        by piece; no word crosses white space, and normalising a text is
        normalising what stands between."""
        i = 0
        while i < len(text):
            j = text.find(" ", i + PIECE_CHARS) if len(text) - i > PIECE_CHARS else -1
            piece, i = (text[i:], len(text)) if j < 0 else (text[i:j], j)
            yield piece.replace("\n", " ").split(" ")

    def split_words(self, chunk: str) -> list[str]:
        if not chunk.isascii():
            # letter by letter, so a final sigma is an ordinary one
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        return self.pattern.findall(chunk.lower())

    def learn(self, chunks: list[str], cache: Cache) -> None:
        """Encode ``chunks`` into ``cache``."""
        words = [self.split_words(c) for c in chunks]
        new = list({w for ws in words for w in ws if w not in cache.words})
        if len(cache.words) + len(new) > CACHE_WORDS:
            cache.words = {w: cache.words[w] for ws in words for w in ws if w in cache.words}
        if new:
            cache.words.update(zip(new, self.encode_words(new)))
        known = cache.words.__getitem__
        cache.chunks.update((c, b"".join(map(known, ws))) for c, ws in zip(chunks, words))

    def encode_all(self, texts: list[str], cache: Cache) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        chars = 0

        def flush() -> None:
            seen = set().union(*(c for _, c in waiting))
            new = [c for c in seen if c not in cache.chunks]
            if len(cache.chunks) + len(new) > CACHE_CHUNKS:
                # what is in use now is what is frequent
                cache.chunks = {c: cache.chunks[c] for c in seen.difference(new)}
            if new:
                self.learn(new, cache)
            known = cache.chunks.__getitem__
            for i, chunks in waiting:
                out[i].append(b"".join(map(known, chunks)))
            waiting.clear()

        for i, text in enumerate(texts):
            at = 0
            found = list(self.special_split.finditer(text)) if "<|" in text else []
            for m in [*found, None]:
                for chunks in self.chunks(text[at:m.start() if m else len(text)]):
                    waiting.append((i, chunks))
                    chars += sum(map(len, chunks))
                    if chars > PIECE_CHARS:
                        flush()
                        chars = 0
                if m:
                    flush()
                    out[i].append(self.special[m.group()].to_bytes(4, "little"))
                    at = m.end()
        flush()
        return [b"".join(x) for x in out]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text], Cache())[0]

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4")
        return " ".join(self.names[ids[ids < self.size]])


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def slices(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``BATCH_ROWS``: what a task makes of one stays small."""
    for batch in stream:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def encode_batches(stream: Iterable[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    """Replace the last column, a text, by ``n_tokens`` and ``token_ids``."""
    bpe, cache = load(tokenizer), Cache()
    for batch in slices(stream):
        *kept, texts = batch.columns
        packed = bpe.encode_all([t or "" for t in texts.to_pylist()], cache)
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary())],
            names=[*batch.schema.names[:-1], "n_tokens", "token_ids"])


def decode_batches(stream: Iterable[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    """Add ``decoded`` behind the last column, packed token ids."""
    bpe = load(tokenizer)
    for batch in slices(stream):
        texts = [bpe.decode(p or b"") for p in batch.columns[-1].to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                         names=[*batch.schema.names, "decoded"])


def _kept(df: DataFrame, keep: tuple[str, ...]) -> StructType:
    return StructType([df.schema[c] for c in keep])


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text",
           keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_tokens`` and ``token_ids`` (little-endian unsigned 32-bit, packed)."""
    schema = _kept(docs, keep).add("n_tokens", LongType()).add("token_ids", BinaryType())
    return docs.select(*keep, docs[text_col].cast("string").alias(fresh(docs, "__text"))).mapInArrow(
        lambda stream: encode_batches(stream, tokenizer), schema)


def decode(tokens: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, the packed ``token_ids`` and what they decode to."""
    schema = _kept(tokens, keep).add("token_ids", BinaryType()).add("decoded", StringType())
    return tokens.select(*keep, "token_ids").mapInArrow(lambda stream: decode_batches(stream, tokenizer), schema)


def round_trip(docs: DataFrame, tokenizer: str, text_col: str = "text",
               keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``encode`` and then ``decode`` in one pass: one Python worker a task instead of two."""
    schema = _kept(docs, keep).add("n_tokens", LongType()).add("token_ids", BinaryType()).add("decoded", StringType())
    return docs.select(*keep, docs[text_col].cast("string").alias(fresh(docs, "__text"))).mapInArrow(
        lambda stream: decode_batches(encode_batches(stream, tokenizer), tokenizer), schema)
