"""Spelling variants, conversation repair and quality rules against brute force, with edge cases."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegraph.llm import conversations, quality, registry, spelling
from pulsegraph.llm.fm_index import BidirectionalIndex, Wavelet, suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: extra columns whose names the operators use inside
CLASH = "word string, n long, fault string, stratum string, rid long, part int, block long, words string"


def clash(df):
    return df.select("*", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in CLASH.split(", ")])


# --------------------------------------------------------------------------- op11


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_suffix_array_and_wavelet():
    rng = np.random.default_rng(1)
    for _ in range(30):
        t = np.append(rng.integers(1, 4, rng.integers(0, 40)), 0)
        assert suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
        w, lo, hi = Wavelet(t, 5), *sorted(rng.integers(0, len(t) + 1, 2))
        for c in range(5):
            a, b, less = w.ranks(np.array([lo]), np.array([hi]), np.array([c]))
            assert (a[0], b[0], less[0]) == ((t[:lo] == c).sum(), (t[:hi] == c).sum(), (t[lo:hi] < c).sum())
        who, symbols, a, b, less = w.symbols_in(np.array([lo]), np.array([hi]))
        assert sorted(symbols.tolist()) == sorted(set(t[lo:hi].tolist())) and set(who.tolist()) <= {0}


def test_index_finds_every_word_one_edit_away():
    rng = random.Random(3)
    for _ in range(60):
        letters = "abé"[:rng.randint(1, 3)]
        words = list({"".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(rng.randint(1, 60))})
        index = BidirectionalIndex(words)
        asked = [*words, "zz" + words[0], words[0] + "z"]
        for first_half in (True, False):
            q, w = index.near_words(asked, first_half)
            want = {(i, j) for i, a in enumerate(asked) for j, b in enumerate(index.words) if one_edit(a, b)
                    and (b.startswith(a[:len(a) // 2]) if first_half else b.endswith(a[len(a) // 2:]))}
            assert set(zip(q.tolist(), w.tolist(), strict=True)) == want


def brute_variants(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            counts[w[:h % len(w)] + w[h % len(w) + 1:] if h % 199 == 0 else w] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {a: [b for b in words if one_edit(a, b)] for a in words}
    form = {a: b for a in words if near[a] and words[b := min(near[a], key=lambda x: (-words[x], x))] >= 5 * words[a]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


@pytest.mark.parametrize("bin_words", [8, spelling.BIN_WORDS])  # 8: every group is cut into parts
def test_variants_equal_brute_force(spark, bin_words):
    rng = random.Random(11)
    base = ["running", "manager", "élégante", "ÀÉÎõüÿ", "zzzzzzz", "aaaaaa", "aaaaaab", "prefixes"]
    rows = [(None, None), (1, ""), (2, "short to be a word"), (3, "x" * 3000)] + [(i, "x" * 3000) for i in range(4, 10)]
    for i in range(10, 400):
        words = []
        for _ in range(12):
            w = rng.choice(base[:rng.randint(1, len(base))])
            if rng.random() < 0.3:  # a few variants that repeat, so that they reach the least count
                k = rng.randrange(3)
                w = w[:2] + w[3:] if k == 0 else w[:-1] + "q" if k == 1 else w + "s"
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i if i % 7 else None, " ,".join(words)))
    rows += rows[10:40]  # repeated rows
    docs = clash(spark.createDataFrame(rows, "doc_id long, text string"))
    got = spelling.variant_forms(spelling.damaged_runs(docs), bin_words=bin_words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_variants(rows)
    assert {tuple(r) for r in got.collect()} == want
    assert any(w[4] > 2 for w in want)


def test_variants_chain_and_ties(spark):
    # abcdef -> abcdefg -> abcdefgh; two equally frequent neighbours of mnopqr: the smaller one
    counts = {"abcdef": 5, "abcdefg": 25, "abcdefgh": 125, "mnopqr": 5, "mnopqs": 30, "mnopqa": 30, "single": 9}
    runs = spark.createDataFrame([(w,) for w, n in counts.items() for _ in range(n)], "word string")
    got = {r.word: r for r in spelling.variant_forms(runs).collect()}
    assert (got["abcdef"].form, got["abcdef"].root, got["abcdef"].form_n) == ("abcdefg", "abcdefgh", 25)
    assert (got["mnopqr"].form, got["mnopqr"].n_near) == ("mnopqa", 2)
    assert (got["mnopqa"].form, got["mnopqa"].n_near, got["mnopqa"].root) == (None, 2, "mnopqa")
    assert (got["single"].form, got["single"].n_near, got["single"].root) == (None, 0, "single")


# --------------------------------------------------------------------------- op12


def brute_repair(rows, insert=5):
    """Counts and the cheapest repair of ``(role, text)`` rows, by best-first search over whole edit strings."""
    seen, kinds = set(), []
    for role, text in rows:
        letters = re.sub(r"[\x20\x09-\x0D]", "", text)
        kinds.append("blank" if not letters else "duplicate" if (role, text) in seen
                     else "truncated" if letters[-1] not in ".!?" else "")
        seen.add((role, text))
    whole, begun = re.compile(r"(s?(ua)+)?"), re.compile(r"s?(ua)*u?")
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, initials, out = heapq.heappop(heap)
        if i == len(rows) and whole.fullmatch(initials):
            return kinds, cost, audit, "\n".join(out)
        if (i, initials[-1:]) in done:
            continue
        done.add((i, initials[-1:]))
        steps = [(insert, "I", i, r[0], f"{r}:") for r in ("user", "assistant")]
        if i < len(rows):
            role, text = rows[i]
            steps.append((2, "D", i + 1, "", None))
            if kinds[i] not in ("blank", "duplicate"):
                extra = 5 if kinds[i] else 0
                steps += [(1 + extra, "R", i + 1, r[0], f"{r}:{text}") for r in ("user", "assistant")]
                if role:
                    steps.append((extra, "K", i + 1, role[0], f"{role}:{text}"))
        for more, letter, j, initial, line in steps:
            if begun.fullmatch(initials + initial):
                heapq.heappush(heap, (cost + more, audit + letter, j, initials + initial, out + ((line,) if line is not None else ())))


def expected(rows, insert=5):
    """``rows``: conversation, turn, role, text."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        by[c].append(((turn is not None, turn or 0), role, hashlib.sha256(text.encode()).hexdigest(), turn, text))
    want = {}
    for c, group in by.items():
        group.sort()
        turns = [g[3] for g in group if g[3] is not None]
        initials = [g[1][:1] for g in group]
        kinds, cost, audit, out = brute_repair([(g[1], g[4]) for g in group], insert)
        want[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("blank"),
                   kinds.count("duplicate"), kinds.count("truncated"),
                   sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                   cost, audit, hashlib.sha256(out.encode()).hexdigest())
    return want


NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
SCHEMA = "conv_id long, turn long, role string, text string"


def random_conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(0, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None] if rng.random() < 0.3
                              else ["user", "assistant"])
            text = rng.choice(["Yes.", "No!", "and so", None, "", " \t\n", "Well?\n", "é.", "Yes. "])
            rows.append((c if c else None, rng.choice([t, t, None, t + 3]), role, text))
    return rows + [(500, i % 5, "user" if i % 3 else "assistant", f"line {i % 90}.") for i in range(400)]


def test_repair_equals_brute_force(spark):
    rows = random_conversations(7, 120)
    df = clash(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    every = df.select("conv_id").union(spark.createDataFrame([(10_000,)], "conv_id long"))
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair_digest(df, every).collect()}
    want = expected(rows)
    assert got.pop(10_000) == NOTHING
    assert got == want


def test_repair_inserts_where_that_is_cheapest(spark, monkeypatch):
    rng = random.Random(4)
    for insert in (0.5, 5):  # at half an edit, insertions beat deletions
        monkeypatch.setattr(conversations, "INSERT", insert)
        end = tuple(conversations._with_insertions([0, conversations.FAR, conversations.FAR, 0]))
        for _ in range(150):
            rows = [(rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b", "", "c!", "d?"]))
                    for _ in range(rng.randint(1, 6))]
            kinds, cost, audit, out = brute_repair(rows, insert)
            codes = "".join("-" if k in ("blank", "duplicate") else (r[0].upper() if k else r[0])
                            for (r, _), k in zip(rows, kinds, strict=True))
            _, edits = conversations.walks(codes, end, True)[conversations.START]
            assert re.sub("[ua]", "", "".join(edits)) == audit
            # the same, with the cost carried over a border between two blocks
            cut = rng.randint(0, len(codes))
            a, b = conversations.crossing(codes[:cut]), conversations.crossing(codes[cut:])
            through = [min(b[4 * q + t] + end[t] for t in range(4)) for q in range(4)]
            assert min(a[t] + through[t] for t in range(4)) == cost


def test_damage_and_empty_tables(spark):
    rows = [(c, t, "assistant", "Yes. No!") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    got = conversations.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    want = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        if fault:
            text = "" if fault == 1 else "Yes No" if fault == 2 and text != " " else text
            want += [(c, t, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.repair_digest(empty, empty).collect() == []
    assert conversations.repair(empty).collect() == []
    assert spelling.variant_forms(spelling.damaged_runs(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


def test_repair_rows_hold_the_repaired_conversation(spark):
    rows = [(1, 0, "system", "Hello."), (1, 1, "assistant", "No."), (1, 2, "user", "Why?"), (1, 3, "tool", "So.")]
    got = conversations.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("part", "block", "n", "k").collect()
    kept = [(r.role, r.text) for r in got if r.edit != "D"]
    _, _, audit, out = brute_repair([r[2:] for r in rows])
    assert "".join(r.edit for r in got) == audit
    assert "\n".join(f"{a}:{b}" for a, b in kept) == out


# --------------------------------------------------------------------------- op13

WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta"]
TEXTS = [None, "", " \t\n", "one two three", "a b c a b c a b c", "x " * 60, "a b a b a b a", "# $ %% &|<>* # é😀",
         "line one\nline one\n\n \nline two\r\nline two\nline one ", " ".join(f"w{i % 50}" for i in range(400)),
         " ".join(f"w{i}" for i in range(30_000)), "y" * 20_000]


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark):
    rng = random.Random(5)
    texts = TEXTS + [" ".join(rng.choices(WORDS[:rng.randint(1, 7)], k=rng.randint(0, 60))) for _ in range(150)]
    rows = [(i if i else None, t, None if i % 5 == 0 else "en") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + rows[:20], "doc_id long, text string, lang string")
    got = Counter(tuple(r) for r in quality.text_counts(clash(docs).drop("stratum")).collect())
    want = Counter((i, lang, *brute_counts(t)) for i, t, lang in rows + rows[:20])
    assert got == want


def test_binomial_tail_is_exact(spark):
    cases = [(k, n) for n in (1, 7, 50, 400, 3000) for k in {0, 1, n // 100, n // 60, n // 30} if k <= n]
    df = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), 0.03).alias("p"))
    for k, n, p in df.collect():
        want = sum(math.comb(n, i) * 0.03**i * 0.97 ** (n - i) for i in range(k + 1))
        assert p == (1.0 if k >= n * 0.03 else pytest.approx(want, rel=1e-9))
    big = spark.createDataFrame([(9_000, 1_000_000)], "k long, n long").select(
        quality.binomial_tail(F.col("k"), F.col("n"), 0.01).alias("p")).first().p
    assert big == pytest.approx(4.3e-24, rel=0.5)  # ten deviations below the mean


def quality_tables(spark, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(1_500):
        good, lang = rng.random() < 0.8, rng.choice(["en", "en", "de", None])
        words = [rng.choice(WORDS) + str(rng.randrange(300)) for _ in range(80)]
        if not good:
            words = [w + "##" for w in words]
        docs.append((i, " ".join(words), lang))
        if i % 10:
            labels.append((i, int(good), 0))
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels + [(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int"))


def test_cutoffs_follow_from_the_bounds(spark):
    docs, labels = quality_tables(spark)
    counts = quality.text_counts(docs).cache()
    tests = [r.asDict() for r in quality.tested_cutoffs(counts, labels).collect()]
    got = {r.stratum: r.asDict() for r in quality.certified_cutoffs(counts, labels).collect()}
    strata = {t["stratum"] for t in tests}
    assert strata == {"en", "de", None}
    level = quality.DELTA / (len(strata) * len(quality.RULES))
    for s in strata:
        for rule in quality.RULES:
            held = None
            for t in sorted((t for t in tests if t["stratum"] == s and t["rule"] == rule.name), key=lambda t: t["step"]):
                p = quality.ALPHA / len(quality.RULES)
                tail = sum(math.comb(t["n"], i) * p**i * (1 - p) ** (t["n"] - i) for i in range(t["k"] + 1))
                if tail > level:
                    break
                held = t["cutoff"]
            assert got.get(s, {}).get(f"{rule.name}_cutoff") == held
    assert got["en"]["symbols_cutoff"] == 2 and got.get("de", {}).get("symbols_cutoff") is None
    verdicts = {r.doc_id: r for r in quality.quality_verdicts(docs, labels).collect()}
    lang = {r.doc_id: r.lang for r in docs.collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    bad = [v for i, v in verdicts.items() if lang[i] == "en" and truth.get(i) == 0]
    assert bad and not any(v.kept for v in bad) and all("symbols" in v.failed_rules for v in bad)
    good = [v for i, v in verdicts.items() if truth.get(i) == 1]
    assert sum(not v.kept for v in good) <= quality.ALPHA * len(good)


def test_false_rejections_stay_below_the_limit(spark):
    """Labels without any signal: whatever is certified rejects at most the stated share of good documents."""
    rng = random.Random(9)
    docs = [(i, " ".join(["word%d" % rng.randrange(9999) for _ in range(60)] + ["#"] * rng.choice([0, 0, 0, 0, 1, 9])), "en")
            for i in range(3_000)]
    labels = [(i, int(rng.random() < 0.5), 0) for i in range(3_000)]
    out = quality.quality_verdicts(spark.createDataFrame(docs, "doc_id long, text string, lang string"),
                                   spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    truth = dict((i, q) for i, q, _ in labels)
    good = [r for r in out.collect() if truth[r.doc_id]]
    assert sum(not r.kept for r in good) <= quality.ALPHA * len(good)


def test_quality_without_labels_or_rows(spark):
    docs, labels = quality_tables(spark)
    out = quality.quality_verdicts(docs.limit(20), labels.limit(0)).collect()
    assert len(out) == 20 and all(r.kept == (not r.base_failed) for r in out)
    assert quality.quality_verdicts(docs.limit(0), labels).collect() == []


def test_queries_run_whole_tables(spark, sf):
    for name in ("op11_spelling", "op12_conversation", "op13_quality"):
        out = registry.QUERIES[name](spark, sf)
        assert out.count() > 0
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert registry.op13_quality(spark, sf).count() == docs.count()
