"""Quality rules with risk-controlled cutoffs (DataFrame functions only).

1. Every whole text is measured inside its own row: words, their code points,
   symbols, repeated lines, words in repeated three-word windows.  No text is
   shuffled; the narrow table of counts is written once.
2. A rule rejects where ``100 * count > cutoff * n_words`` (``below``: where it
   is smaller).  Its cutoffs are fixed beforehand, from lenient to strict.
3. Labelled documents that pass the base rules are the holdout.  Per stratum,
   rule and cutoff, k of the n good ones are rejected; "the false rejection
   rate exceeds ``alpha / rules``" is refuted if the exact binomial tail
   P(Bin(n, alpha / rules) <= k) is at most ``delta / (strata * rules)``.
4. Each rule walks its cutoffs in order and stops at the first that is not
   refuted (fixed-sequence testing), strata and rules share ``delta`` by
   Bonferroni.  So with probability 1 - delta, in every stratum at once, the
   certified rules together reject at most ``alpha`` of the good documents.

The binomial tail is summed downwards from its largest term, over as many
terms as can matter in a double, so its cost does not grow with n.  A stratum
with too few labelled rows certifies nothing and rejects nothing beyond the
base rules.

Defined results: a null text is empty (no words, so the base rules fail it); a
null stratum is a stratum of its own; rows that repeat an id are each measured
(and each counted, if labelled); an id labelled both good and bad counts as
good; null labels and ids count as unlabelled; an empty table gives no rows;
without labels nothing is certified.  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegraph.llm.common import WORD, materialise, text_or_empty

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Rejects where ``100 * count`` is above (``below``: below) ``cutoff * n_words``."""

    name: str
    count: str
    cutoffs: tuple[int, ...]
    below: bool = False


#: cutoffs in hundredths of a word, each from lenient to strict
RULES = (
    Rule("symbols", "n_symbols", (400, 300, 200, 150, 100, 75, 50, 35, 25, 15, 10, 5, 2)),
    Rule("long_words", "word_chars", (2000, 1500, 1200, 1000, 900, 850, 800, 775, 750, 725, 700, 675, 650, 625, 600)),
    Rule("repeated_words", "n_repeat_words", (49, 45, 40, 35, 30, 25, 20, 15, 10)),
    Rule("repeated_lines", "n_dup_lines", (50, 25, 15, 10, 8, 6, 5, 4, 3, 2)),
)
ALPHA, DELTA = 0.05, 0.05
LEAST_WORDS, MOST_REPEATED = 50, 50


# --------------------------------------------------------------------------- counts


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                stratum_col: str = "lang") -> DataFrame:
    """``doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``, one row per row."""
    words = F.col("words")
    last = F.size(words) - 3
    in_window = F.sequence(F.lit(0), last)
    hashes = F.when(last > 0, F.transform(in_window, lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))
    # most texts repeat no window; only the others are sorted
    windows = F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(F.transform(
        in_window, lambda i: F.struct(F.get("hashes", i).alias("h"), F.get(words, i).alias("a"),
                                      F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"), i.alias("i")))))
    sorted_ = F.col("windows")

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    again = F.filter(sorted_, lambda x, j: same(x, F.get(sorted_, j - 1)) | same(x, F.get(sorted_, j + 1)))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    whole = lambda c: c.cast("long")
    return (
        docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"),
                    text_or_empty(text_col).alias("text"))
        .withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
        .withColumn("lines", lines)
        .select("doc_id", "stratum", "words",
                whole(F.size("words")).alias("n_words"),
                whole(F.length(F.array_join("words", ""))).alias("word_chars"),
                whole(F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
                whole(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
                hashes.alias("hashes"))
        .withColumn("windows", windows)
        .select("doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                whole(F.coalesce(F.size(covered), F.lit(0))).alias("n_repeat_words"))
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


# --------------------------------------------------------------------------- exact binomial tail


def log_gamma(x: Column) -> Column:
    """ln Γ(x) for x >= 1, to double precision: Stirling's series at x + 8."""
    y = x + 8.0
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    shift = F.lit(0.0)
    for i in range(8):
        shift = shift + F.log(x + float(i))
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - shift


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k); 1 where k >= n p, which certifies nothing at any level below a half."""
    k, n = k.cast("double"), n.cast("double")
    largest = F.exp(log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1)
                    + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    # terms fall by the factor i (1-p) / ((n-i+1) p); 40 deviations below, nothing is left of a double
    terms = F.least(k, F.ceil(40 * F.sqrt(n * p)) + 100).cast("int")
    tail = F.aggregate(
        F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda at, j: _next_term(at, k - j + 1, n, p),
        lambda at: at["total"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(largest * tail)


def _next_term(at: Column, i: Column, n: Column, p: float) -> Column:
    term = at["term"] * i / (n - i + 1) * ((1 - p) / p)
    return F.struct(term.alias("term"), (at["total"] + term).alias("total"))


# --------------------------------------------------------------------------- cutoffs


def rejects(rule: Rule, cutoff: Column) -> Column:
    left, right = 100 * F.col(rule.count), cutoff * F.col("n_words")
    return left < right if rule.below else left > right


def good_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    return (labels.where((F.col(label_col) == 1) & F.col(id_col).isNotNull())
            .select(F.col(id_col).alias("doc_id")).distinct())


def tested_cutoffs(counts: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES,
                   alpha: float = ALPHA) -> DataFrame:
    """``stratum, rule, step, cutoff, n, k, p_value``: good holdout rows and how many of them each cutoff rejects."""
    holdout = counts.where(~base_failed()).join(good_ids(labels), "doc_id")
    rejected = [F.sum(rejects(r, F.lit(c)).cast("long")).alias(f"{r.name}_{s}")
                for r in rules for s, c in enumerate(r.cutoffs)]
    by_stratum = holdout.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *rejected)
    tests = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(s).alias("step"), F.lit(c).alias("cutoff"),
                               F.col(f"{r.name}_{s}").alias("k"))
                      for r in rules for s, c in enumerate(r.cutoffs)])
    return (by_stratum.select("stratum", "n", F.inline(tests))
            .select("stratum", "rule", "step", "cutoff", "n", "k",
                    binomial_tail(F.col("k"), F.col("n"), alpha / len(rules)).alias("p_value")))


def certified_cutoffs(counts: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES,
                      alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``stratum`` and, per rule, ``<rule>_cutoff``: the strictest certified one, null if there is none."""
    tests = materialise(tested_cutoffs(counts, labels, rules, alpha), "cutoff-tests")
    strata = tests.select("stratum").distinct().count()
    level = delta / max(1, strata * len(rules))
    walked = tests.groupBy("stratum", "rule").agg(F.min(F.when(F.col("p_value") > level, F.col("step"))).alias("stop"))
    held = (tests.join(walked.withColumnsRenamed({"stratum": "s", "rule": "r"}),
                       F.col("stratum").eqNullSafe(F.col("s")) & (F.col("rule") == F.col("r")))
            .where(F.col("stop").isNull() | (F.col("step") < F.col("stop"))))
    return held.groupBy("stratum").agg(*[
        F.max_by(F.when(F.col("rule") == r.name, F.col("cutoff")), F.when(F.col("rule") == r.name, F.col("step")))
        .alias(f"{r.name}_cutoff") for r in rules])


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     stratum_col: str = "lang", rules: tuple[Rule, ...] = RULES,
                     alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Counts of every row, ``base_failed``, ``kept`` and the ``failed_rules`` by name, comma-joined."""
    counts = materialise(text_counts(docs, id_col, text_col, stratum_col), "text-counts")
    cutoffs = certified_cutoffs(counts, labels, rules, alpha, delta).withColumnRenamed("stratum", "__s")
    failed = F.array_compact(F.array(*[
        F.when(rejects(r, F.col(f"{r.name}_cutoff")), F.lit(r.name)) for r in rules]))
    return (
        counts.join(cutoffs, F.col("stratum").eqNullSafe(F.col("__s")), "left")
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                base_failed().alias("base_failed"),
                (~base_failed() & (F.size(failed) == 0)).alias("kept"),
                F.array_join(failed, ",").alias("failed_rules"))
    )


# --------------------------------------------------------------------------- the same in SQL


def verdict_sql(rules: tuple[Rule, ...] = RULES, alpha: float = ALPHA, delta: float = DELTA) -> str:
    """DuckDB SQL for ``quality_verdicts`` on ``documents`` and ``labels``."""
    p = alpha / len(rules)
    grid = ", ".join(f"('{r.name}', {s}, {c})" for r in rules for s, c in enumerate(r.cutoffs))
    measured = "CASE rule " + " ".join(
        f"WHEN '{r.name}' THEN 100 * {r.count} {'<' if r.below else '>'} cutoff * n_words" for r in rules) + " END"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '{WORD}') AS ws FROM d),
windows AS (SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
            FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS n
          FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
counts AS (SELECT d.r, doc_id, stratum, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
                  length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
                  coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
           FROM d JOIN w USING (r) LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
base AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM counts),
grid(rule, step, cutoff) AS (VALUES {grid}),
good AS (SELECT * FROM base WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
tests AS (SELECT stratum, rule, step, cutoff, count(*) AS n, count(*) FILTER ({measured}) AS k
          FROM good CROSS JOIN grid GROUP BY ALL),
tail AS (SELECT stratum, rule, step, cutoff, CASE WHEN k >= n * {p} THEN 1 ELSE list_sum(list_transform(range(0, k + 1),
             lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p})))) END AS p_value
         FROM tests),
walked AS (SELECT *, max(p_value) OVER (PARTITION BY stratum, rule ORDER BY step)
                     <= {delta} / ((SELECT count(*) FROM (SELECT DISTINCT stratum FROM tests)) * {len(rules)}) AS held FROM tail),
chosen AS (SELECT stratum, rule, max_by(cutoff, step) AS cutoff FROM walked WHERE held GROUP BY ALL),
failed AS (SELECT r, string_agg(rule, ',' ORDER BY pos) AS failed_rules
           FROM base JOIN chosen ON base.stratum IS NOT DISTINCT FROM chosen.stratum
           JOIN (SELECT rule, row_number() OVER () AS pos FROM (VALUES {", ".join(f"('{r.name}')" for r in rules)}) v(rule)) USING (rule)
           WHERE {measured} GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules IS NULL AS kept, coalesce(failed_rules, '') AS failed_rules
FROM base LEFT JOIN failed USING (r)
"""
