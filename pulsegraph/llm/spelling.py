"""Spelling variant grouping: words one edit apart, and the common form each leads to.

1. Words are counted in the JVM: runs of letters of every whole text.
2. A word and a near one share a whole half: the edit lies in the other.  So a
   word of m code points meets its near words in the group of its first
   floor(m / 2) code points and in that of its remaining ones; a word enters the
   groups of m - 1, m and m + 1, as it may be asked for by words that long.
   That is six rows a word, however many words there are.
3. Groups are packed by hash into bins of about ``BIN_WORDS`` rows.  Each bin
   is one task's vocabulary: a bidirectional FM-index is built over it
   (``fm_index.py``) and asked by search schemes, one half exact, one error in
   the other.  A group larger than a bin is cut by a hash of its words and its
   questions go to every part, so no bin grows with the data.
4. A task returns a count and a best form for each word, never the pairs.
   Where both halves find a word, the first counts it.
5. Roots follow by pointer doubling: a form is at least ``RATIO`` times as
   frequent, so chains are logarithmic in the largest count.

Words of very many code points are searched symbol by symbol and cost time in
proportion to their length.

Defined results: a null text has no words and a null id counts as the empty
string; rows that repeat are counted each; an empty table gives no rows; of
near words of equal count the smallest in code-point order is the form.  Extra
columns are ignored.
"""

from __future__ import annotations

import string

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegraph.llm.common import CRC32_SQL, crc32_sql, materialise, text_or_empty
from pulsegraph.llm.fm_index import BidirectionalIndex

LETTERS = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: one in so many runs loses a code point
DAMAGE = 199
BIN_WORDS = 16_384
#: questions searched side by side; bounds a task's memory
TOGETHER = 2_048


def damaged_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least_length: int = LEAST_LENGTH) -> DataFrame:
    """``word``: every run of at least ``least_length`` letters, lower-cased, one in 199 without one code point."""
    lowered = F.translate(text_or_empty(text_col), string.ascii_uppercase, string.ascii_lowercase)
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    at = (F.col("h") % F.col("n")).cast("int")
    return (
        docs.select(id_col, F.explode(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))).alias("run"))
        .withColumn("n", F.length("run")).where(F.col("n") >= least_length)
        .select("run", "n", F.crc32(key.cast("binary")).alias("h"))
        .select(F.when(F.col("h") % DAMAGE == 0,
                       F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.col("n"))))
                .otherwise(F.col("run")).alias("word"))
    )


def _groups(words: DataFrame, bin_words: int) -> DataFrame:
    """``bin, part, first_half, word, n, indexed, asks``: six rows a word, questions to a large group once a part."""
    length = F.length("word")
    first = lambda m: F.struct(
        F.lit(True).alias("first_half"), m.alias("m"), F.substring("word", F.lit(1), F.floor(m / 2).cast("int")).alias("half"))
    second = lambda m: F.struct(
        F.lit(False).alias("first_half"), m.alias("m"),
        F.right("word", m - F.floor(m / 2).cast("int")).alias("half"))
    lengths = [length - 1, length, length + 1]
    rows = (
        words.select("word", "n", F.inline(F.array(*[first(m) for m in lengths], *[second(m) for m in lengths])))
        .where(F.col("m") >= LEAST_LENGTH)
        .withColumn("asks", F.col("m") == F.length("word"))
    )
    group = ["first_half", "m", "half"]
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"))
    bins = max(1, -(-rows.count() // bin_words))
    large = sizes.where(F.col("rows") > bin_words).withColumn(
        "parts", F.ceil(F.col("rows") / bin_words).cast("int"))
    placed = rows.join(large.drop("rows"), group, "left")
    hashed = lambda *c: F.xxhash64(*c)
    own = F.pmod(hashed(F.col("word")), F.col("parts")).cast("int")
    copies = F.when(F.col("parts").isNull(), F.array(F.struct(F.lit(0).alias("part"), F.lit(True).alias("indexed"),
                                                              F.col("asks").alias("asked")))).otherwise(
        F.transform(F.when(F.col("asks"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own)),
                    lambda p: F.struct(p.alias("part"), (p == own).alias("indexed"), F.col("asks").alias("asked"))))
    name = F.concat_ws("\x01", F.col("first_half").cast("string"), F.col("m").cast("string"), "half")
    return (
        placed.select("first_half", "word", "n", F.explode(copies).alias("c"),
                      F.when(F.col("parts").isNull(), F.pmod(hashed(name), F.lit(bins)).cast("string"))
                      .otherwise(name).alias("bin"))
        .select("bin", "c.part", "first_half", "word", "n", "c.indexed", F.col("c.asked").alias("asks"))
    )


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """One bin: for each asking word the number of its near words and the best of them."""
    indexed = rows[rows["indexed"]].drop_duplicates("word")
    counts = dict(zip(indexed["word"], indexed["n"], strict=True))
    index = BidirectionalIndex(list(counts))
    n = np.array([counts[w] for w in index.words], np.int64)
    out = [pd.DataFrame({"word": [], "n_near": [], "best_n": [], "best": []}).astype({"n_near": int, "best_n": int})]
    for first_half, asking in rows[rows["asks"]].groupby("first_half"):
        queries = asking["word"].tolist()
        for i in range(0, len(queries), TOGETHER):
            some = queries[i:i + TOGETHER]
            q, w = index.near_words(some, bool(first_half))
            if not first_half:  # the first half's search has found those that begin alike
                new = np.array([not index.words[b].startswith(some[a][:len(some[a]) // 2])
                                for a, b in zip(q, w, strict=True)], bool)
                q, w = q[new], w[new]
            order = np.lexsort((w, -n[w], q))
            q, w = q[order], w[order]
            head = np.flatnonzero(np.diff(q, prepend=-1))
            out.append(pd.DataFrame({"word": [some[a] for a in q[head]],
                                     "n_near": np.diff(head, append=len(q)),
                                     "best_n": n[w[head]], "best": [index.words[b] for b in w[head]]}))
    return pd.concat(out).astype({"word": object, "best": object})


def near_counts(words: DataFrame, bin_words: int = BIN_WORDS) -> DataFrame:
    """``word, n_near, best_n, best`` of the words that have near ones; ``words`` is ``word, n``, words distinct."""
    found = _groups(words, bin_words).groupBy("bin", "part").applyInPandas(
        _search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("b"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("x")).select(
        "word", "n_near", (-F.col("x.b")).alias("best_n"), F.col("x.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for every row of ``word, form``: the end of its chain, by pointer doubling."""
    chains = materialise(forms.where("form is not null").select("word", F.col("form").alias("root")), "chains")
    while True:
        onward = chains.select(F.col("word").alias("w"), F.col("root").alias("onward"))
        chains = materialise(
            chains.join(onward, F.col("root") == F.col("w"), "left")
            .select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "chains")
        if chains.where("moved").limit(1).count() == 0:
            return chains.select("word", "root")


def variant_forms(runs: DataFrame, least_count: int = LEAST_COUNT, bin_words: int = BIN_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the words of ``runs`` (``word``) that occur ``least_count`` times."""
    words = materialise(
        runs.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least_count), "words")
    near = near_counts(words, bin_words).withColumnRenamed("word", "w")
    common = F.col("best_n") >= RATIO * F.col("n")
    formed = materialise(
        words.join(near, F.col("word") == F.col("w"), "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(common, F.col("best")).alias("form"), F.when(common, F.col("best_n")).alias("form_n")), "forms")
    ends = roots(formed).withColumnRenamed("word", "w")
    return formed.join(ends, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# --------------------------------------------------------------------------- the same in SQL

VARIANT_SQL = f"""
WITH RECURSIVE {CRC32_SQL},
runs AS (SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                                             '{LETTERS}')) AS run FROM documents)
    WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
hashed AS (SELECT run, n, {crc32_sql("concat(doc_id, ':', run)")} AS h FROM runs, crc_table),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % {DAMAGE} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed)
    WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
gaps AS (SELECT word, i, word[:i] || word[i + 2:] AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (SELECT a.word, b.word AS other FROM gaps a JOIN gaps b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
         UNION SELECT g.word, w.word FROM gaps g JOIN words w ON w.word = g.rest
         UNION SELECT w.word, g.word FROM gaps g JOIN words w ON w.word = g.rest),
best AS (SELECT near.word, count(*) OVER (PARTITION BY near.word) AS n_near, other, w.n AS other_n
         FROM near JOIN words w ON w.word = near.other
         QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, other COLLATE C) = 1),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {RATIO} * w.n THEN other END AS form,
                  CASE WHEN other_n >= {RATIO} * w.n THEN other_n END AS form_n
           FROM words w LEFT JOIN best USING (word)),
chain(word, tip, hops) AS (SELECT word, word, 0 FROM formed
                          UNION ALL SELECT c.word, f.form, hops + 1 FROM chain c JOIN formed f ON f.word = c.tip AND f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT word, max_by(tip, hops) AS root FROM chain GROUP BY word) c ON c.word = f.word
"""
