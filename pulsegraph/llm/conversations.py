"""Conversation structure repair: the cheapest edits that make roles alternate.

A conversation's role initials must read ``(s?(ua)+)?``.  A row may be kept,
given the other role (user / assistant), or deleted, and empty user /
assistant rows may be inserted anywhere; blank and repeated rows must be
deleted, and a truncated row that stays costs extra.  Among the cheapest edit
sequences the one whose letters (``D I K R``) are ASCII-least is emitted.

Square-root checkpointed dynamic programme, laid out for Spark:

1. A conversation's N rows are cut into blocks of ceil(sqrt N) rows.  One
   conversation may hold a third of all rows, so rows are ordered by a range
   partitioning that splits it, and a block never leaves its partition.  A
   block is one letter a row (its initial and fault); texts stay behind.
2. Each block yields the 4 x 4 costs of crossing it, from each state of the
   role pattern to each (all blocks at once, in parallel).
3. Walking each conversation's blocks backward, these give the cost-to-go of
   the four states, and it is stored only at the block borders: the
   checkpoints.  A task holds four numbers, whatever the conversation's size.
4. Each block recomputes the cost-to-go of its own rows from its checkpoint
   and walks forward from each of the four states it may be entered in,
   taking the ASCII-least edit that is tight (in parallel again).
5. Walking the blocks forward picks the state that each is really entered in.

Only the digest of a whole repaired conversation is a sequence by nature: its
rows stream, sorted, through one task that keeps a hash state.

Defined results: rows are taken by turn (nulls first), then role, then the
SHA-256 of the text, so equal rows are neighbours.  A null role, text or
conversation id counts as one space in text, and a null conversation is one
conversation.  An empty role has no initial and cannot stay as it is.  Of rows
that repeat role and text the first stays.  Conversations without rows give
zeros, no edits and the digest of the empty string; an empty table gives no
rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from pulsegraph.llm.common import CRC32_SQL, crc32_sql, materialise
from pulsegraph.session import checkpoint_root

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: states of the role pattern: nothing yet, after s, after u, after a
START, S, U, A = range(4)
#: next state by state and initial
STEP = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
#: the only role that an insertion or a new role can bring in a state
NEXT = {START: U, S: U, U: A, A: U}
ROLE = {U: "user", A: "assistant"}
FAR = 1 << 60
BLANK_SPACE = r"[^\x20\x09-\x0D]"

# --------------------------------------------------------------------------- rows


def _spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with planted faults, told by crc32 of ``conv_id:turn`` mod 20."""
    fault = F.pmod(F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")), F.lit(20))
    text = (F.when(F.col("fault") == 1, F.lit(""))
            .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    return (
        rows.select("conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), fault.alias("fault"))
        .where("fault <> 0")
        .select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                text.alias("text"),
                F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"))
        .drop("copy")
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with a row number ``rid``, a text hash and their own fault; written once, so that ``rid`` is stable."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return materialise(
        rows.select("conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"))
        .select("*", F.unhex(F.sha2("text", 256)).alias("sha"), F.monotonically_increasing_id().alias("rid"),
                F.substring("role", 1, 1).alias("initial"),
                (~F.col("text").rlike(BLANK_SPACE)).alias("blank"),
                (~last.isin(".", "!", "?")).alias("open_end")),
        "conversation-rows")


def _same_conversation(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _classified(numbered: DataFrame) -> DataFrame:
    """Narrow rows with ``fault`` (blank, duplicate, truncated or null) and the conversation's row count."""
    narrow = numbered.drop("text")
    order = F.struct("turn", "rid")
    first = narrow.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("sha").alias("t")).agg(
        F.min(order).alias("first"))
    sizes = narrow.groupBy(F.col("conv_id").alias("cc")).agg(F.count(F.lit(1)).alias("rows"))
    return (
        narrow.join(first, _same_conversation("conv_id", "c") & (F.col("role") == F.col("r")) & (F.col("sha") == F.col("t")))
        .join(sizes, _same_conversation("conv_id", "cc"))
        .select("conv_id", "turn", "role", "sha", "rid", "initial", "rows",
                F.when(F.col("blank"), "blank").when(order > F.col("first"), "duplicate")
                .when(F.col("open_end"), "truncated").alias("fault"))
    )


def _blocks(classified: DataFrame) -> DataFrame:
    """One row a block: ``conv_id, part, block, codes, initials, rids``, its rows in order.

    ``codes`` has a letter a row: its initial (``s u a`` or ``x``), in capitals
    if it is truncated, ``-`` if it must go.
    """
    spark = classified.sparkSession
    checkpoint_root(spark)
    order = ["conv_id", "turn", "role", "sha", "rid"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    code = (F.when(F.col("fault").isin("blank", "duplicate"), "-")
            .when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter))
    # range borders are sampled, so the partitions are drawn once and kept
    ranged = (classified.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id())
              .select("*", code.alias("code")).checkpoint())
    here = Window.partitionBy("part", "conv_id")
    # a partition's share of a conversation is cut by that conversation's block length
    number = F.row_number().over(here.orderBy(*order[1:])) - 1
    return materialise(
        ranged.withColumn("n", number)
        .withColumn("block", F.floor(F.col("n") / F.ceil(F.sqrt("rows"))))
        .groupBy("conv_id", "part", "block")
        .agg(F.array_sort(F.collect_list(F.struct("n", "code", "initial", "rid"))).alias("x"))
        .select("conv_id", "part", "block", F.array_join("x.code", "").alias("codes"),
                F.col("x.initial").alias("initials"), F.col("x.rid").alias("rids")),
        "conversation-blocks")


# --------------------------------------------------------------------------- costs inside a block


def _edits(code: str, state: int) -> Iterator[tuple[str, int, int]]:
    """``letter, cost, next state`` of the edits that use up a row, in ASCII order."""
    yield "D", DELETE, state
    if code != "-":
        extra = TRUNCATED if code.isupper() else 0
        kept = STEP.get((state, code.lower()))
        if kept is not None:
            yield "K", KEEP + extra, kept
        yield "R", REROLE + extra, NEXT[state]


def _with_insertions(costs: list[int]) -> list[int]:
    """Cost-to-go of the states where rows may be inserted first; two lead back to the same role."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
    return costs


def _back(code: str, after: list[int]) -> list[int]:
    return _with_insertions([min(cost + after[to] for _, cost, to in _edits(code, q)) for q in range(4)])


END = tuple(_with_insertions([0, FAR, FAR, 0]))


def crossing(codes: str) -> tuple[int, ...]:
    """Row by row the 4 x 4 costs of crossing a block, from each state to each."""
    columns = []
    for to in range(4):
        costs = [0 if q == to else FAR for q in range(4)]
        for code in reversed(codes):
            costs = _back(code, costs)
        columns.append(costs)
    return tuple(min(columns[to][q], FAR) for q in range(4) for to in range(4))


def walks(codes: str, after: tuple[int, ...], is_last: bool) -> tuple[tuple[int, tuple[str, ...]], ...]:
    """For each entry state: the state at the end and each row's edits, the ASCII-least tight ones.

    ``after`` is the checkpoint behind the block.  An edit is its letter, and
    the initial of the role it brings after ``I`` and ``R``.  Insertions are
    noted before the row they precede; those at the very end after the last row.
    """
    costs = [list(after)]
    for code in reversed(codes):
        costs.append(_back(code, costs[-1]))
    costs.reverse()
    found = []
    for state in range(4):
        letters = []
        for i, code in enumerate(codes):
            done = ""
            letter = ""
            while letter in ("", "I"):
                left = costs[i][state]
                tight = [(e, to) for e, cost, to in _edits(code, state) if cost + costs[i + 1][to] == left]
                if INSERT + costs[i][NEXT[state]] == left:
                    tight.append(("I", NEXT[state]))
                letter, state = min(tight)
                done += letter + (ROLE[state][0] if letter in "IR" else "")
            letters.append(done)
        while is_last and costs[-1][state] > 0:
            state = NEXT[state]
            letters[-1] += "I" + ROLE[state][0]
        found.append((state, tuple(letters)))
    return tuple(found)


#: many short conversations share their codes; longer blocks are not worth keeping
SHORT = 40


@lru_cache(maxsize=20_000)
def _kept_crossing(codes: str) -> tuple[int, ...]:
    return crossing(codes)


@lru_cache(maxsize=20_000)
def _kept_walks(codes: str, after: tuple[int, ...], is_last: bool) -> tuple:
    return walks(codes, after, is_last)


# --------------------------------------------------------------------------- Arrow helpers


def _map(df: DataFrame, f: Callable[[dict], dict], schema: str) -> DataFrame:
    """``f`` on every row, by Arrow batches."""
    def batches(it):
        for batch in it:
            yield pa.RecordBatch.from_pylist([f(r) for r in batch.to_pylist()], schema=arrow)

    arrow = _arrow(schema)
    return df.mapInArrow(batches, schema)


def _fold(df: DataFrame, order: list[Column], start: Callable[[], object],
          step: Callable[[object, dict], dict | None], schema: str,
          end: Callable[[object], dict] | None = None) -> DataFrame:
    """Stream each conversation's rows in order through ``step(state, row)``.

    A task keeps one state; it may get several conversations and never holds
    the rows of one.  Rows that ``step`` answers with None give no output;
    ``end(state)`` adds a row for each conversation.
    """
    arrow = _arrow(schema)

    def batches(it):
        key, state, seen = None, None, False
        for batch in it:
            out = []
            for row in batch.to_pylist():
                if not seen or row["conv_id"] != key:
                    if seen and end:
                        out.append(end(state) | {"conv_id": key})
                    key, state, seen = row["conv_id"], start(), True
                if (made := step(state, row)) is not None:
                    out.append(made)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if seen and end:
            yield pa.RecordBatch.from_pylist([end(state) | {"conv_id": key}], schema=arrow)

    sorted_ = df.repartition("conv_id").sortWithinPartitions("conv_id", *order)
    return sorted_.mapInArrow(batches, schema)


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


# --------------------------------------------------------------------------- repair


def _id_type(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def repaired_blocks(blocks: DataFrame) -> DataFrame:
    """``conv_id, part, block, rids, edits, cost, illegal``: each row's edits, the whole conversation's
    cost (on its first block, else null) and the illegal neighbours up to the block's last row."""
    kind = _id_type(blocks)
    place = f"conv_id {kind}, part int, block long"
    costs = _map(blocks.select("conv_id", "part", "block", "codes"),
                 lambda r: {k: r[k] for k in ("conv_id", "part", "block")} | {"crossing": (_kept_crossing if len(r["codes"]) <= SHORT else crossing)(r["codes"])},
                 f"{place}, crossing array<long>")

    def backward(at: dict, r: dict) -> dict:
        after = at.get("costs", END)
        c = r["crossing"]
        at["costs"] = tuple(min(c[4 * q + to] + after[to] for to in range(4)) for q in range(4))
        last, at["last"] = "last" not in at, False
        return {k: r[k] for k in ("conv_id", "part", "block")} | {"after": after, "last": last, "total": at["costs"][START]}

    ends = materialise(_fold(costs, [F.desc("part"), F.desc("block")], dict, backward,
                             f"{place}, after array<long>, last boolean, total long"), "conversation-ends")
    key = [_same_conversation("conv_id", "c"), F.col("part") == F.col("p"), F.col("block") == F.col("b")]
    renamed = {"conv_id": "c", "part": "p", "block": "b"}

    def variants(r: dict) -> dict:
        walk = _kept_walks if len(r["codes"]) <= SHORT else walks
        found = walk(r["codes"], tuple(r["after"]), r["last"])
        return ({k: r[k] for k in ("conv_id", "part", "block", "total", "initials", "rids")}
                | {"exits": [x[0] for x in found], "letters": [x[1] for x in found]})

    walked = materialise(
        _map(blocks.join(ends.withColumnsRenamed(renamed), on=_all(key))
             .select("conv_id", "part", "block", "codes", "initials", "rids", "after", "last", "total"),
             variants, f"{place}, total long, initials array<string>, rids array<long>, exits array<int>, "
                       "letters array<array<string>>"),
        "conversation-walks")

    def forward(at: dict, r: dict) -> dict:
        state, first = at.get("state", START), "state" not in at
        pairs = 0 if first else int(at["initial"] + r["first"] not in ("su", "ua", "au"))
        at["state"], at["initial"] = r["exits"][state], r["last"]
        return ({k: r[k] for k in ("conv_id", "part", "block")}
                | {"state": state, "cost": r["total"] if first else None, "border_illegal": pairs})

    entered = _fold(walked.select("conv_id", "part", "block", "exits", "total", F.get("initials", F.lit(0)).alias("first"),
                                  F.get("initials", F.size("initials") - 1).alias("last")),
                    [F.asc("part"), F.asc("block")], dict, forward,
                    f"{place}, state int, cost long, border_illegal int")
    pairs = F.transform(F.sequence(F.lit(1), F.size("initials") - 1),
                        lambda i: F.concat(F.get("initials", i - 1), F.get("initials", i)))
    illegal = F.when(F.size("initials") > 1, F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))).otherwise(0)
    return materialise(
        walked.join(entered.withColumnsRenamed(renamed), on=_all(key))
        .select("conv_id", "part", "block", "rids", F.get("letters", F.col("state")).alias("edits"), "cost",
                (illegal + F.col("border_illegal")).cast("long").alias("illegal")),
        "conversation-edits")


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _edit_rows(numbered: DataFrame, edited: DataFrame) -> DataFrame:
    """``conv_id, part, block, n, k, edit, role, text``: one row an edit, in order of (part, block, n, k)."""
    placed = edited.select("part", "block", F.posexplode(F.arrays_zip("rids", "edits")).alias("n", "e")).select(
        "part", "block", "n", F.col("e.rids").alias("r"),
        F.regexp_extract_all("e.edits", F.lit("([A-Z][ua]?)"), F.lit(1)).alias("tokens"))
    edit = F.substring("token", 1, 1)
    return (
        numbered.select("conv_id", "rid", "role", "text").join(placed, F.col("rid") == F.col("r"))
        .select("conv_id", "part", "block", "n", F.posexplode("tokens").alias("k", "token"), "role", "text")
        .select("conv_id", "part", "block", "n", "k", edit.alias("edit"),
                F.when(F.substring("token", 2, 1) == "u", ROLE[U]).when(F.substring("token", 2, 1) == "a", ROLE[A])
                .otherwise(F.col("role")).alias("role"),
                F.when(edit == "I", "").otherwise(F.col("text")).alias("text"))
    )


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id, part, block, n, k, edit, role, text``: what became of every row of ``conv_id, turn, role, text``.

    In order of ``(part, block, n, k)`` inside a conversation; rows whose edit
    is not ``D`` are the repaired conversation.
    """
    numbered = _numbered(rows)
    return _edit_rows(numbered, repaired_blocks(_blocks(_classified(numbered))))


def repair_digest(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row a ``conv_id`` of ``conversations``: faults, cost, edits and the digest of its repair."""
    numbered = _numbered(rows)
    classified = _classified(numbered)
    edited = repaired_blocks(_blocks(classified))
    count = lambda what: F.sum((F.col("fault") == what).cast("long")).alias(what)
    faults = classified.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"),
        *[F.coalesce(count(x), F.lit(0)).alias(x) for x in ("blank", "duplicate", "truncated")])
    letters = F.regexp_replace(F.array_join("edits", ""), "[ua]", "")
    costs = edited.groupBy(F.col("conv_id").alias("c1")).agg(
        F.sum("illegal").alias("illegal"), F.max("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "block", letters.alias("a")))),
                                 lambda x: x["a"]), "").alias("audit"))

    def line(at: dict, r: dict) -> None:
        if "sha" in at:
            at["sha"].update(b"\n")
        else:
            at["sha"] = hashlib.sha256()
        at["sha"].update(f"{r['role']}:{r['text']}".encode())

    digests = _fold(_edit_rows(numbered, edited).where("edit <> 'D'"),
                    [F.asc("part"), F.asc("block"), F.asc("n"), F.asc("k")], dict, line,
                    f"conv_id {_id_type(numbered)}, sha256 string",
                    lambda at: {"sha256": at["sha"].hexdigest()}).withColumnRenamed("conv_id", "c2")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (
        conversations.select("conv_id").distinct()
        .join(faults.withColumnRenamed("conv_id", "c0"), _same_conversation("conv_id", "c0"), "left")
        .join(costs, _same_conversation("conv_id", "c1"), "left")
        .join(digests, _same_conversation("conv_id", "c2"), "left")
        .select("conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
    )


# --------------------------------------------------------------------------- the same in SQL


def _best(options: str) -> str:
    return f"list_min(list_filter([{options}], lambda x: x.c IS NOT NULL))"


def _edit_sql(letter: str, cost: str, tail: str, line: str = "''") -> str:
    return f"{{'c': {cost} + {tail}.c, 'a': '{letter}' || {tail}.a, 't': {line} || {tail}.t}}"


def repair_sql() -> str:
    """DuckDB SQL for ``repair_digest`` of the damaged table ``conversations``: whole suffixes, state by state."""
    inserted = {q: f"chr(10) || '{ROLE[to]}:'" for q, to in NEXT.items()}
    used = {}
    for q in range(4):
        kept = " ".join(f"WHEN '{i}' THEN v{STEP[q, i]}" for i in "sua" if (q, i) in STEP)
        extra = f"CASE WHEN n.code = 'T' THEN {TRUNCATED} WHEN n.code = '.' THEN 0 END"
        used[q] = _best(", ".join([
            _edit_sql("D", str(DELETE), f"v{q}"),
            _edit_sql("K", f"{extra} + {KEEP}", f"(CASE n.initial {kept} END)", "chr(10) || n.line"),
            _edit_sql("R", f"{extra} + {REROLE}", f"v{NEXT[q]}", f"{inserted[q]} || n.text")]))
    once = ", ".join(f"{_best(f'u{q}, ' + _edit_sql('I', str(INSERT), f'u{NEXT[q]}', inserted[q]))} AS w{q}" for q in range(4))
    twice = ", ".join(f"{_best(f'w{q}, ' + _edit_sql('I', str(INSERT), f'w{NEXT[q]}', inserted[q]))} AS v{q}" for q in range(4))
    end = {START: [], S: [U, A], U: [A], A: []}
    ends = ", ".join(
        f"{{'c': CAST({INSERT * len(x)} AS BIGINT), 'a': '{'I' * len(x)}', 't': " + " || ".join(
            ["''", *[f"chr(10) || '{ROLE[r]}:'" for r in x]]) + f"}} AS v{q}" for q, x in end.items())
    return f"""
WITH RECURSIVE {CRC32_SQL},
hashed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                  {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fault
           FROM conversations, crc_table),
damaged AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
                   CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
            FROM hashed WHERE fault <> 0),
placed AS (SELECT conv_id, turn, role, text, left(role, 1) AS initial, role || ':' || text AS line,
                  regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
           FROM damaged),
copies AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM placed),
n AS (SELECT *, CASE WHEN last = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
             CASE WHEN last = '' OR nth > 1 THEN '-' WHEN last NOT IN ('.', '!', '?') THEN 'T' ELSE '.' END AS code,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
      FROM copies),
back AS (SELECT conv_id, max(i) AS i, {ends} FROM n GROUP BY conv_id
         UNION ALL
         SELECT conv_id, i, {twice}
         FROM (SELECT conv_id, i, {once}
               FROM (SELECT b.conv_id, b.i - 1 AS i, {", ".join(f"{used[q]} AS u{q}" for q in range(4))}
                     FROM back b JOIN n ON n.conv_id IS NOT DISTINCT FROM b.conv_id AND n.i = b.i))),
faults AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
           FROM n GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.v0.c, 0) AS cost,
       coalesce(b.v0.a, '') AS audit, sha256(coalesce(b.v0.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN back b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = 0
"""
