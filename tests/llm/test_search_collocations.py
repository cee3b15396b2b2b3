"""Collocations, exact top-k and ranked lexical search against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from samples import documents, empty, multiset
from segflow.llm import collocations, exact_search, lexical

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- collocations -----------------------------------------------------------


def plain_collocations(rows, support, longest=5, first=2000):
    n, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {x: c for x, c in f.items() if c >= support}
    out = []
    for lang in n:
        own = {p: c for (g, p), c in often.items() if g == lang}
        held = defaultdict(int)
        for p, c in own.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    held[p[i : i + size]] = max(held[p[i : i + size]], c)
        found = []
        for p, a in own.items():
            if len(p) > 1 and 100 * held[p] < 100 * a:
                score, _, left, right = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed, count, words):
    dice = random.Random(seed)
    known = ["a", "b", "the", "Of", "x\xa0y", "größe", "\x1c", "日本", "ends.", "cut, here", "tab\tbed", "f"]
    return [(i, " ".join(dice.choices(known, k=dice.randrange(words))), dice.choice(["en", "de", None, "und", ""]), "s", 0) for i in range(count)]


@pytest.mark.parametrize("support, longest, first", [(3, 5, 2000), (10, 3, 7), (1, 2, 2000)])
def test_collocations_equal_a_plain_count(spark, support, longest, first):
    rows = texts(1, 120, 40) + texts(2, 1, 3)
    docs = documents(spark, rows + rows[:30])
    got = collocations.collocations(docs, collocations.Settings(support=support, longest=longest), first)
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows + rows[:30], support, longest, first)


def test_phrases_over_awkward_rows(spark):
    from samples import DOCS

    docs = documents(spark)
    for shards in (1, 8):
        got = collocations.collocations(docs, collocations.Settings(support=2, shards=shards))
        assert sorted(map(tuple, got.collect())) == plain_collocations(DOCS, 2)
    assert collocations.collocations(empty(spark)).collect() == []
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_a_phrase_spread_thinly_over_all_shards_is_found(spark):
    # each shard holds about an eighth of it, and one text is as long as all others
    rows = [(i, f"w{i} q{i} rare pair z{i}", "en", "s", 0) for i in range(100)] + [(1000, " ".join(f"v{i}" for i in range(500)), "en", "s", 0)]
    got = collocations.collocations(documents(spark, rows)).collect()
    assert [(r.phrase, r.a, r.l, r.r, r.n) for r in got] == [("rare pair", 100, 100, 100, 1000)]


def test_small_bit_tables_and_streams_lose_nothing(spark, monkeypatch):
    rows = texts(3, 200, 60)
    monkeypatch.setattr(collocations, "SEGMENT", 16)
    got = collocations.collocations(documents(spark, rows), collocations.Settings(support=4, most_bits=1 << 16))
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, 4)
    text = ("one two three, four five. " * 50).encode()
    assert [w for words in collocations.cut_words(text) for w in words if w != b"."] == re.findall(rb"[a-z]+", text)


def test_scores_pass_64_bits(spark):
    counts = [(10**13, 10**15, 3 * 10**13, 7 * 10**13), (100, 10**16, 100, 101), (3, 7, 5, 2)]
    df = spark.createDataFrame(counts, "a long, n long, l long, r long")
    got = [r[0] for r in df.select(collocations.score(*[df[c] for c in "anlr"])).collect()]
    assert got == [1000 * a * n // (x * y) for a, n, x, y in counts]


# ---- exact top-k ------------------------------------------------------------


def plain_top(rows, k, asks):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in sorted((i, [x for x in v]) for i, v in rows if (i, None) != (i, v) and any(i == j for j, _ in usable) and asks(i)):
        if any(i == j and [math.floor(256 * x) for x in v] == w for j, w in usable if all(x is not None for x in v)):
            queries.setdefault(i, [math.floor(256 * x) for x in v])
    out = []
    for q, v in queries.items():
        scores = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in usable if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return out


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, score long, `_lot` int, label int").repartition(3)


def test_exact_top_k_equals_brute_force(spark):
    dice = np.random.default_rng(0)
    values = dice.normal(size=(400, 9)).astype(np.float32).astype(float)
    values[dice.random(values.shape) < 0.5] = 0
    values[100:130] = values[99]  # ties
    rows = [(int(i) - 200, v.tolist()) for i, v in enumerate(values)]
    rows += [(None, values[0].tolist()), (1000, None), (1010, [0.0] * 9), (1001, [1.0, None] + [0.0] * 7), (1002, [math.nan] * 9), (1003, [math.inf] + [1.0] * 8), (1020, []), (1030, [0.5, -0.25])]
    rows += [rows[5]] * 40 + [rows[10], rows[10]]
    asks = lambda i: i % 10 == 0
    for settings in (exact_search.Settings(), exact_search.Settings(block=50, lot=7, at_once=3, tasks=5)):
        got = exact_search.search(vectors(spark, [(*r, 1, 2, 3) for r in rows]), exact_search.F.col("vec_id") % 10 == 0, 5, settings)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert multiset(map(tuple, got.collect())) == multiset(plain_top(rows, 5, asks))
    none = exact_search.search(vectors(spark, []), exact_search.F.col("vec_id") % 10 == 0)
    assert none.collect() == []
    few = exact_search.search(vectors(spark, [(0, [1.0], 1, 1, 1), (3, [-1.0], 1, 1, 1)]), exact_search.F.lit(True), 5)
    assert sorted(map(tuple, few.collect())) == [(0, 1, 3, -65536), (3, 1, 0, -65536)]


def test_exact_top_k_of_numbers_beyond_64_bits(spark):
    rows = [(0, [1e30, 1.0, 2.0**55]), (1, [3e30, -7.5, 1.0]), (2, [-1e300, 0.0, 0.0]), (3, [1e-9, -1e-9, 0.0]), (4, [0.0, 5000000.25, 2.0**54])]
    got = exact_search.search(vectors(spark, [(*r, 1, 2, 3) for r in rows], "double"), exact_search.F.lit(True), 5)
    assert multiset(map(tuple, got.collect())) == multiset(plain_top(rows, 5, lambda i: True))


# ---- ranked lexical search --------------------------------------------------


def plain_ranking(docs, items, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    counts = [(d, Counter(term.findall((t or "").translate(LOWER)))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    total, length, df = len(counts), sum(sum(c.values()) for _, c in counts), Counter(t for _, c in counts for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(term.findall((t or "").translate(LOWER)))
    out = []
    for i, terms in asked.items():
        scored = []
        for d, c in counts:
            m = 50 + 50 * sum(c.values()) * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(i, rank, None if gone else d, -s) for rank, (s, gone, d) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.mark.parametrize("settings", [lexical.Settings(), lexical.Settings(block_terms=10, postings=300, short=0.02, window=16), lexical.Settings(postings=2000, short=0.5, window=64)])
def test_ranking_equals_brute_force(spark, settings):
    dice = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Größe", "日本", "x-y", "A_b"]
    weights = [1 / (1 + i) for i in range(len(words))]
    rows = [(i, " ".join(dice.choices(words, weights, k=dice.randrange(60)))) for i in range(500)]
    rows += [rows[3]] * 5 + [(None, rows[4][1]), (600, None), (601, ""), (602, "-- ..."), (603, "w1 " * 9000), (-4, rows[7][1])]
    items = [(i, " ".join(dice.choices(words, k=dice.randrange(1, 25)))) for i in range(12)] + [(12, None), (13, "nowhere"), (14, "w0"), (14, "w1 w1"), (15, ""), (None, "w5")]
    docs = documents(spark, [(d, t, "en", "s", 0) for d, t in rows])
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("terms", lexical.F.lit("own"))
    got = lexical.search(docs, asked, 20, settings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert multiset(map(tuple, got.collect())) == multiset(plain_ranking(rows, items, 20))


def test_ranking_of_awkward_tables(spark):
    from samples import DOCS

    items = [(1, "text comes mot KEIN"), (2, "boats")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(documents(spark), asked).collect()
    assert multiset(map(tuple, got)) == multiset(plain_ranking([(d, t) for d, t, *_ in DOCS], items, 50))
    assert lexical.search(empty(spark), asked).collect() == []
    assert lexical.search(documents(spark), asked.where("item_id > 5")).collect() == []


def test_long_products_of_document_lengths():
    n = np.array([10**7, 3], np.int64)
    assert lexical.share(n, 10**13, 5 * 10**15).tolist() == [50 + 50 * 10**20 // (5 * 10**15), 50]


def test_tables_of_phrases_are_taken_back(spark, monkeypatch):
    from pyspark import SparkContext

    made, first = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: made.append(first(self, value)) or made[-1])
    docs = spark.createDataFrame([(i, "a b c d e. a b", "x") for i in range(200)], "doc_id long, text string, lang string")
    assert collocations.phrase_counts(docs).where("phrase = 'a b'").first().n == 400
    assert len(made) == 5 and not any(b._jbroadcast.isValid() for b in made)
