"""Secret scans with multipart credential linking.

Base spans are found by pattern, leftmost and non-overlapping per kind (see
``base_spans``).  Beside them stand weak candidates, which mean nothing alone:

* ``ident``    an account, client, user or access-key identifier in an assignment;
               its name may end a longer one (``DB_USER``, ``aws_access_key_id``),
* ``key``      a bare or assigned mixed run of 32 or more Base64 letters,
* ``endpoint`` a URL or an assigned host.

Parts of one credential stand near each other.  Every identifier (weak ones
and access-key ids) opens a scope of ``RADIUS`` code points to either side; an
interval join on (document, cell of the text) links it with the secrets (weak
ones, assigned and hex ones) whose start lies in the scope.  A weak
identifier or key is reported when its complement is in scope, an endpoint
when a linked identifier and a linked secret are.  The joins are semi joins:
no pair of candidates is ever written out.  Base spans stay whatever the links.

The scan is a map over whole texts; only documents that hold both roles enter
the joins, with their candidates and no text.

Defined results: null and empty texts have no spans; rows that repeat get a
row each; an id with several texts has its spans kept apart by a hash of the
text; an empty table gives no rows; extra columns are ignored, whatever they
are called.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegraph.llm.common import materialise, row_key, text_or_empty

RADIUS = 300

#: fixed by the contract of the scan
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{16,}")
BASE_KINDS = ("assign", "access", "hex")
WEAK_KINDS = ("ident", "key", "endpoint")

_KEYWORDS = ("passw", "secret", "token", "api")
_IDENT_WORDS = ("access", "client", "account", "user", "login")
# names may follow "_" or "-", so they start where no letter or digit stands before
IDENT = re.compile(r"""(?i:(?<![A-Za-z0-9])(?:(?<!secret_)(?<!secret-)access_?key(?:_?id)?|client[_\x20]?id|account(?:_?(?:id|name))?|user(?:_?name|[_\x20]?id)?|login))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{4,})""", re.ASCII)
KEY = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/]{32,}+={0,2}+(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"""(?i:https?)://[^\s"'<>]+|(?i:(?<![A-Za-z0-9])(?:host(?:name)?|endpoint(?:_?suffix)?|server|data\x20source))["']?\x20*[:=]\x20*["']?(?i:tcp:)?([A-Za-z0-9.-]+(?::\d+)?)""", re.ASCII)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Assignments with a value of 12 or more letters, access-key ids of 18 or
    more, hex runs of 16 or more; by start, then kind as listed."""
    out: list[Span] = []
    lowered = text.lower()
    if any(k in lowered for k in _KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    # a run that is long enough is the whole of a leftmost match of HEX
    out += [("hex", m.start(), m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], BASE_KINDS.index(s[0])))


def _looks_random(token: str) -> bool:
    return (any(c.islower() for c in token) and any(c.isupper() for c in token)
            and any(c.isdigit() for c in token))


def weak_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak candidates that overlap no base span; none without any identifier."""
    lowered = text.lower()
    idents = []
    if any(w in lowered for w in _IDENT_WORDS):
        idents = [("ident", *m.span(1)) for m in IDENT.finditer(text)]
    if not idents and not any(kind == "access" for kind, _, _ in base):
        return []
    found = idents + [("key", *m.span()) for m in KEY.finditer(text) if _looks_random(m.group())]
    found += [("endpoint", *m.span(1 if m.group(1) else 0)) for m in ENDPOINT.finditer(text)]
    taken = sorted((s, e) for _, s, e in base)
    out, i = [], 0
    for kind, s, e in sorted(found, key=lambda x: (x[1], WEAK_KINDS.index(x[0]))):
        while i < len(taken) and taken[i][1] <= s:
            i += 1
        if not any(a < e and s < b for a, b in taken[i:i + 3]):
            out.append((kind, s, e))
    return out


_SPAN = pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int64())])
_SPANS = "array<struct<start: bigint, rank: int, kind: string, end: bigint>>"


def _rows(spans: list[Span]) -> list[dict]:
    kinds = BASE_KINDS + WEAK_KINDS
    return [{"start": s, "rank": kinds.index(k), "kind": k, "end": e} for k, s, e in spans]


def scanned_batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, key, text_hash, text`` with the spans in place of the text.

    One text at a time is a Python string: a batch may hold many MB of them."""
    for batch in stream:
        base, weak = [], []
        for text in batch.column(3):
            text = text.as_py()
            found = base_spans(text)
            base.append(_rows(found))
            weak.append(_rows(weak_spans(text, found)))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(3)), pa.array(base, pa.list_(_SPAN)), pa.array(weak, pa.list_(_SPAN))],
            names=["doc_id", "key", "text_hash", "base", "weak"])


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, key, text_hash, base, weak``: the spans of every whole text."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col).alias("key"),
                       F.xxhash64(text).alias("text_hash"), text.alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scanned_batches, f"doc_id {id_type}, key string, text_hash bigint, base {_SPANS}, weak {_SPANS}")


def _cell(at: Column) -> Column:
    return F.floor(at / RADIUS)


def _in_scope(spans: DataFrame, of: DataFrame) -> DataFrame:
    """The rows of ``spans`` with a row of ``of`` whose start is within ``RADIUS`` of theirs."""
    around = of.select(F.col("key").alias("k"), F.col("text_hash").alias("h"), F.col("start").alias("at"),
                       F.explode(F.sequence(_cell(F.col("start")) - 1, _cell(F.col("start")) + 1)).alias("c"))
    return spans.join(around, (F.col("key") == F.col("k")) & (F.col("text_hash") == F.col("h"))
                      & (_cell(F.col("start")) == F.col("c"))
                      & (F.abs(F.col("start") - F.col("at")) <= RADIUS), "left_semi")


def linked(scanned: DataFrame) -> DataFrame:
    """``key, text_hash, start, rank, kind, end``: the weak spans that complementary parts confirm."""
    has = [F.exists(F.concat("base", "weak"), lambda s: s["kind"].isin(*kinds))
           for kinds in (("access", "ident"), ("assign", "hex", "key"))]
    spans = materialise(
        scanned.where((F.size("weak") > 0) & has[0] & has[1]).dropDuplicates(["key", "text_hash"])
        .select("key", "text_hash", F.explode(F.concat("base", "weak")).alias("s"))
        .select("key", "text_hash", "s.*"), "spans")
    idents = spans.where(F.col("kind").isin("access", "ident"))
    secrets = spans.where(F.col("kind").isin("assign", "hex", "key"))
    linked_idents, linked_secrets = _in_scope(idents, secrets), _in_scope(secrets, idents)
    endpoints = _in_scope(_in_scope(spans.where("kind = 'endpoint'"), linked_idents), linked_secrets)
    return (linked_idents.where("kind = 'ident'").unionByName(linked_secrets.where("kind = 'key'"))
            .unionByName(endpoints))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, spans``: arrays of base spans, and of these and the linked weak ones."""
    scanned = materialise(candidates(docs, id_col, text_col), "candidates")
    added = (linked(scanned).groupBy(F.col("key").alias("k"), F.col("text_hash").alias("h"))
             .agg(F.collect_set(F.struct("start", "rank", "kind", "end")).alias("added")))
    return (scanned.join(added, (F.col("key") == F.col("k")) & (F.col("text_hash") == F.col("h")), "left")
            .select("doc_id", "base", F.array_sort(F.concat(
                "base", F.coalesce("added", F.array().cast(_SPANS)))).alias("spans")))


def span_list(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan(docs).select("doc_id", *map(count, BASE_KINDS), F.sha2(span_list("base"), 256).alias("base_sha256"),
                             span_list("spans").alias("spans"))
