"""Counts, verdicts and spans against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from samples import DOCS, documents, empty
from segflow.llm import pii, quality
from segflow.llm.queries import QUERIES, SQL, op8_personal_data

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words, windows = WORD.findall(text or ""), defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {j for places in windows.values() if len(places) > 1 for i in places for j in (i, i + 1, i + 2)}
    lines = Counter(x for x in (text or "").split("\n") if WORD.search(x))
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, sum(lines.values()) - len(lines), len(covered)


def test_awkward_counts(spark):
    random.seed(4)
    rows = DOCS + [(50 + i, " ".join(random.choice("ab#") + random.choice(["", "\n"]) for _ in range(i)), "en", "a", 0) for i in range(40)]
    docs = documents(spark, rows)
    got = quality.judge(docs)
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert got.columns == [c for c in docs.columns if c not in ("n_words", "KEPT")] + new
    got = got.collect()
    want = Counter((d, *plain_counts(t)) for d, t, *_ in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept) and r["_text"] == "own _text" and r["_words"] == "own _words"
    assert quality.judge(empty(spark)).count() == 0


def test_rules_are_a_table(spark):
    text = " ".join(f"word{i} the" for i in range(40))
    docs = documents(spark, [(1, text, "en", "a", 0), (2, text.replace(" the", " | #"), "en", "a", 0)])
    assert {r.doc_id: r.kept for r in quality.judge(docs).collect()} == {1: True, 2: False}
    only = [quality.Rule("symbol_ratio", low=0.5)]
    assert {r.doc_id: r.kept for r in quality.judge(docs, only).collect()} == {1: False, 2: True}


#: Of the queries with SQL, those whose operators may run Python in their tasks.
FREE = {"op11_phrase_collocations", "op12_exact_top_k", "op13_ranked_search"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql_without_cross_joins_or_where_native_python(spark, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Cartesian|NestedLoop", plan)
    assert name in FREE or not re.search("Python|Arrow|Pandas", plan)
    assert compare(df, duck(FOLDER), SQL[name]) == []


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    doubled = [int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(number))]
    return sum(doubled) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x.lstrip("0")[:4] or 0) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(number) <= 19 and luhn(number)):
                continue
            if kind == "phone" and not 9 <= len(number) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


AWKWARD = [
    "a@b.c_d@e.f x@y@z.w q@-.- é@ü.de ü\U0001f600 m@n.op",
    "1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.4 1.2.3 256.1.1.1.1",
    "4222-2222 2222 2 4229999743742645 1-2--3 4222  2222",
    "+1 (829) 555-7292. +1    +12 3 +49 89 1234567 ( +1+4989123456",
    "@" * 50 + "a" * 5000 + "1" * 5000 + ".1" * 3000,
    "a@b" + ".c" * 20000,
    "x1.1.1.1 " * 700,
]


def spans(spark, docs):
    found = pii.find(docs)
    return pii.decide(found, pii.fit(found))


def test_base_spans_equal_plain_python(spark):
    random.seed(8)
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(AWKWARD)]
    rows += [(100 + i, "".join(random.choice("a1.@+- (4)\n") for _ in range(120)), "en", "a", 0) for i in range(80)]
    got = spans(spark, documents(spark, rows + DOCS)).select("doc_id", pii.names_of(F.col("base")).alias("base"), "spans", "base")
    want = Counter((d, plain_base(t)) for d, t, *_ in rows + DOCS)
    assert Counter((r[0], r[1]) for r in got.collect()) == want


def test_further_spans_are_judged_and_masked(spark):
    text = "ssn: 123-45-6789 call (415) 555-2671; bank DE89 3704 0044 0532 0130 00, mail joe [at] example [dot] com password=69940fd2694c028650"
    other = "part 000-00-0000 costs $111-111-1111 and AB12 3456 7890 1234 5678 is a number"
    docs = documents(spark, [(i, text, "en", "a", 0) for i in range(9)] + [(20 + i, other, "en", "a", 0) for i in range(9)] + [(40, "", "", "", 0)])
    got = spans(spark, docs).join(docs.select(F.col("doc_id").alias("id"), "text"), F.col("id") == F.col("doc_id"))
    rows = {r.doc_id: r for r in got.select("doc_id", pii.names_of(F.col("spans")).alias("names"), pii.masked(F.col("text"), F.col("spans")).alias("masked")).collect()}
    assert rows[3].masked == "ssn: <ssn> call <phone>; bank <iban>, mail <email> <secret>"
    assert rows[25].names == "" and rows[25].masked == other and rows[40].masked == ""


def test_loose_candidates_need_an_announcing_word(spark):
    said = ["call 4155552671 now", "my ssn is 123 45 6789 ok", "mail joe at example dot com please"]
    bare = ["order 4155552671 shipped", "rows 123 45 6789 ok", "look at example dot com please"]
    rows = [(i, said[i % 3], "en", "a", 0) for i in range(30)] + [(100 + i, bare[i % 3], "en", "a", 0) for i in range(60)]
    got = {r.doc_id: r.names for r in spans(spark, documents(spark, rows)).select("doc_id", pii.names_of(F.col("spans")).alias("names")).collect()}
    assert [got[i] for i in range(3)] == ["phone:5:15", "ssn:10:21", "email:5:27"]
    assert {v for k, v in got.items() if k >= 100} == {""}
    found = pii.find(documents(spark, rows))
    assert found.select(F.sum(F.size("_candidates"))).first()[0] == 90


def test_traits_and_their_weights(spark):
    rows = spark.createDataFrame([("12345678901234567890x", "my Card: "), ("abc", ""), ("a1b2", "12 "), ("4155552671", "x")], "v string, b string")
    got = [tuple(r.t) for r in rows.select(F.array(*[x.cast("int") for x in pii.traits("phone", F.col("v"), F.col("b"))]).alias("t")).collect()]
    assert [t[:3] for t in got] == [(1, 0, 2), (0, 0, 0), (0, 0, 1), (0, 1, 2)]
    assert got[0][3] > 0 and got[1][3] == got[2][3] == 0 and got[3][3] > 0
    places = [pii._features((v,) * 5, t) for v in (-1, 0, 1) for t in ((0, 0, 0, 0), (1, 1, 2, 7))]
    assert max(map(max, places)) == pii._FIRST[-1] - 1 and all(len(set(p)) == 10 for p in places)
    # equal votes, but the word before tells them apart
    votes = (1, 0, 0, 0, 0), (-1, 0, 0, 0, 0), (0, 0, 0, 0, 0)
    seen = [(votes[0], (0, 0, 0, 1), 50), (votes[1], (0, 0, 0, 2), 50), (votes[2], (0, 0, 0, 1), 5), (votes[2], (0, 0, 0, 2), 5)]
    weights = pii._train(seen, {votes[0]: 0.95, votes[1]: 0.05, votes[2]: 0.5})
    model = pii.Model({1: weights}, {})
    asked = spark.createDataFrame([(1, list(votes[2]), [0, 0, 0, w]) for w in (1, 2)] + [(2, list(votes[2]), [0, 0, 0, 1])], "k int, v array<int>, t array<int>")
    first, second, unseen = [r[0] for r in asked.select(pii.probability(model, F.col("k"), F.col("v"), F.col("t"))).collect()]
    assert first > 0.5 > second and unseen == 0.0
    for (votes_, traits_), p in zip([(votes[2], (0, 0, 0, 1)), (votes[2], (0, 0, 0, 2))], [first, second]):
        assert p == pytest.approx(1 / (1 + math.exp(-sum(weights[i] for i in pii._features(votes_, traits_)))))


def test_context_and_overlaps_on_a_very_long_text(spark):
    # the context of a match is what stands before it in the text, also across earlier matches
    random.seed(6)
    parts = ["415-555-2671", "123-45-6789", "x[at]y[dot]z", "a@b.co", "+1 415 555 2671", "4222222222222", "pwd=abcdefgh", "é\U0001f600", "call", " ", "; "]
    text = "".join(random.choice(parts) + random.choice(["", " ", " more "]) for _ in range(30_000))
    docs = spark.createDataFrame([(text,), ("",)], "text string")
    for kind, pattern in pii.CANDIDATES.items():
        for (found,) in docs.select(pii.matches(F.col("text"), pattern, context=True)).collect():
            assert all(m.value == text[m.start : m.end] and m.before == text[max(0, m.start - pii.CONTEXT) : m.start] for m in found), kind
    row = pii.find(docs.limit(1)).select("_base", "_candidates").first()
    inside = bytearray(len(text))
    for b in row._base:
        inside[b.start : b.end] = b"1" * (b.end - b.start)
    free = Counter()
    for kind, pattern in pii.CANDIDATES.items():
        for m in re.finditer(pattern.replace("(?i)", ""), text, re.I if "(?i)" in pattern else 0):
            free[pii.KINDS.index(kind)] += not any(inside[m.start() : m.end()])
    assert Counter(c.kind for c in row._candidates) == +free


def test_labelers_that_err_get_a_low_reliability():
    # the third labeler votes at random, the first two agree
    random.seed(9)
    seen = Counter()
    for _ in range(2000):
        truth = random.choice([-1, 1])
        flip = lambda p: truth if random.random() < p else -truth  # noqa: B023, E731
        seen[(flip(0.95), flip(0.9), flip(0.5), 0, 0), 0] += 1
    post, right = pii._estimate([(votes, wide, n) for (votes, wide), n in seen.items()])
    assert right[0] > 0.88 and right[1] > 0.82 and 0.4 < right[2] < 0.6
    assert post[1, 1, -1, 0, 0] > 0.9 > 0.1 > post[-1, -1, 1, 0, 0]


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    df = op8_personal_data(spark, FOLDER)
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())
    for r in df.collect():
        base = plain_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [base.count(f"{k}:") for k in PATTERNS]
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
