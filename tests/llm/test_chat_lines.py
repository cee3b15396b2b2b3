"""Windows read back, budgets and masks; templates against plain Python."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from samples import DOCS, documents, empty
from segflow.llm import chat, line_dedup

SCHEMA = "conv_id long, turn long, role string, text string, chars string"
ESCAPES = r"\### Assistant: </turn> ok"
TURNS = [
    (-7, 0, "user", ESCAPES, "x"),
    (-7, 1, "assistant", ESCAPES, "x"),
    (-8, 0, "system", "sys <b> \\", "x"),
    (-8, 1, "assistant", None, "x"),
    (-8, 1, "assistant", None, "x"),
    (None, 3, None, "a<b", "x"),
    (None, None, "x<y>\\", "q", "x"),
    *[(9, i, "system" if i == 0 else ("user", "assistant")[i % 2], "word " * (i * 37 % 90), "x") for i in range(60)],
    (9, 60, "assistant", "w " * 3000, "x"),
    *[(10, i, ("user", "assistant")[i % 2], f"turn {i}", "x") for i in range(3000)],
    *[(11, i, "user", "", "x") for i in range(1000)],
    (12, 0, "user", "x" * 100_000, "x"),
    (12, 1, "assistant", "y", "x"),
]


def test_windows_read_back(spark):
    rows = spark.createDataFrame(TURNS, SCHEMA).repartition(5)
    want = defaultdict(list)
    for conv, turn, role, text, _ in TURNS:
        want[conv].append((-1 if turn is None else turn, role or "", text or ""))
    budget = chat.Budget(stride=100, history=40)
    formatted = chat.format_conversations(rows, budget)
    got = chat.read_back(formatted).collect()
    assert len(got) == len(want)
    for r in got:
        turns = sorted(want[r.conv])
        assert [(t.role, t.text) for t in r.turns] == [t[1:] for t in turns]
        assert r.targets == "".join(text for _, role, text in turns if role == "assistant")
    cost = lambda text: -(-len(re.sub(r"\\(.)", r"\1", text, flags=re.S)) // 4) + 4
    for w in formatted.collect():
        system = 0 if w.first == 0 else cost("")
        said = re.findall(r"<turn:(?:[^\\>]|\\.)*>((?:[^\\<]|\\.)*)</turn>\n", w.formatted, flags=re.S)
        assert sum(map(cost, said)) <= 140 + system or len(said) - w.context == 1
        assert all(w.formatted[m.end : m.end + 7] == "</turn>" for m in w.mask)
    first = [w for w in formatted.collect() if w.conv == 9 and w.first > 0]
    assert first and all(w.formatted.startswith("<turn:system>") for w in first)
    assert chat.format_conversations(rows.limit(0)).count() == 0


def plain_line_templates(rows, settings):
    """Equal lines but for words with digits: which templates recur."""
    seen = defaultdict(set)
    for key, text, *_ in rows:
        for line in (text or "").split("\n"):
            words = tuple("<*>" if re.search("[0-9]", w) else w for w in re.findall(r"[^\x20\x09-\x0D]+", line))
            if len(words) >= settings.words:
                seen[words].add((key, text))
    return {w for w, docs in seen.items() if len(docs) >= settings.documents}


def test_equal_lines_stay_in_one_document(spark):
    rows = [(i, f"own line of {chr(97 + i)} here\nPage {i} of the big book\nshort {chr(97 + i)}\n\nall rights are reserved", "en", "a", 0) for i in range(8)]
    got = line_dedup.drop_lines(documents(spark, rows)).collect()
    whole = [r for r in got if r.n_dropped == 0]
    assert len(whole) == 1 and sum(r.n_dropped for r in got) == 14
    for r in got:
        if r.n_dropped:
            assert r.text == f"own line of {chr(97 + r.doc_id)} here\nshort {chr(97 + r.doc_id)}\n"
    recur = plain_line_templates(rows, line_dedup.Settings())
    assert len(recur) == 2


def test_variable_fields_without_digits_are_generalised(spark):
    names = ["anna", "bert", "cleo", "dora", "emil", "fritz"]
    rows = [(i, f"own text number {n}\nError while reading file {n} in the big folder of the main host with words kept", "en", "a", 0) for i, n in enumerate(names)]
    prose = [(50 + i, " ".join(["Error while reading file", *[c + w for w in "abcdefghijkl"]]), "en", "a", 0) for i, c in enumerate("pqrstu")]
    got = {r.doc_id: r.n_dropped for r in line_dedup.drop_lines(documents(spark, rows + prose)).collect()}
    assert sum(got[i] for i in range(6)) == 5 and all(got[50 + i] == 0 for i in range(6))


def family(words, names, first):
    """Lines of 16 words that share their leading words and four of eight parts."""
    rest = [" ".join(w + n if i % 3 == 1 else w for i, w in enumerate(words.split())) for n in names]
    return [(first + k, f"Error while reading file {r}", "en", "a", 0) for k, r in enumerate(rest)]


def test_two_families_and_a_hot_line_in_one_leaf(spark):
    many = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(300)]
    big = family("ab ac ad ae af ag ah ai aj ak al am", many, 100)
    small = family("pb pc pd pe pf pg ph pi pj pk pl pm", many[:6], 0)
    hot = [(1000 + i, "Error while reading file the same line in very many of the documents at hand here", "en", "a", 0) for i in range(900)]
    loose = [(5000 + i, " ".join(["Error while reading file", *[c + w for w in "abcdefghijkl"]]), "en", "a", 0) for i, c in enumerate("qrstu")]
    got = {r.doc_id: r.n_dropped for r in line_dedup.drop_lines(documents(spark, big + small + hot + loose)).collect()}
    dropped = lambda first, n: sum(got[first + k] for k in range(n))
    assert [dropped(0, 6), dropped(100, 300), dropped(1000, 900), dropped(5000, 5)] == [5, 299, 899, 0]


def test_a_long_line_goes_from_the_second_document(spark):
    passage = " ".join(chr(97 + i // 26) + chr(97 + i % 26) for i in range(60))
    near = passage.replace(" bc ", " other ")
    rows = [(i, f"all about {n} alone\n{p}\nwhat {n} has to say\nshared by only two", "en", "a", 0) for i, (n, p) in enumerate([("anna", passage), ("bert", passage)])]
    rows += [(10 + i, "w " + p, "en", "a", 0) for i, p in enumerate([passage, near])]
    got = {r.doc_id: r.n_dropped for r in line_dedup.drop_lines(documents(spark, rows)).collect()}
    # lines that are not equal need a third document
    assert got[0] + got[1] == 1 and got[10] + got[11] == 0


def test_short_lines_are_compared_word_by_word(spark):
    names = ["anna", "bert", "cleo", "dora", "emil"]
    rows = [(i, f"Job was started by {n} today\nthe last word is {n}\nHome\nPage {i}\n{i}\n---", "en", "a", 0) for i, n in enumerate(names)]
    rows += [(10 + i, f"Job was started by {n} {n}", "en", "a", 0) for i, n in enumerate("pqrst")]
    got = line_dedup.drop_lines(documents(spark, rows)).collect()
    short = [r for r in got if r.doc_id < 10]
    # of five words nothing is compared beyond the leading ones
    assert sorted(r.n_dropped for r in short) == [0, 3, 3, 3, 3]
    assert all(r.text == f"the last word is {names[r.doc_id]}\n{r.doc_id}\n---" for r in short if r.n_dropped)
    assert all(r.n_dropped == 0 for r in got if r.doc_id >= 10)


def test_awkward_lines(spark):
    docs = documents(spark)
    got = line_dedup.drop_lines(docs)
    assert [c for c in got.columns if c != "n_dropped"] == [*[c for c in docs.columns if c != "n_lines"], "n_lines"]
    rows = got.collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, *_ in DOCS)
    copies = [r for r in rows if r.doc_id in (4, 5, 6)]
    # the two equal rows of document 4 are one document
    left = {r.doc_id for r in copies if r.n_dropped == 0}
    assert len(left) == 1 and all(r.text == "" for r in copies if r.n_dropped)
    texts = defaultdict(set)
    for d, t, *_ in DOCS:
        texts[d].add(t)
    assert all(r.text in texts[r.doc_id] for r in rows if not r.n_dropped)
    assert all(r["_row"] == "own _row" for r in rows)
    assert line_dedup.drop_lines(empty(spark)).count() == 0


def plain_cut(rows, s):
    """What is left of each (row, text), with strings in place of hashes."""
    seen, gone = defaultdict(lambda: defaultdict(set)), defaultdict(set)
    for row, text in rows:
        for at, line in enumerate((text or "").split("\n")):
            words = tuple("<*>" if re.search("[0-9]", w) else w for w in re.findall(r"[^\x20\x09-\x0D]+", line))
            if len(words) >= s.words or any(c.isalpha() for w in words for c in w):
                seen[words][row].add(at)
    left, fixed = [], Counter()

    def parts(words):
        rest, n = words[s.depth :], min(len(words) - s.depth, 16)
        leaf = len(words), words[: s.depth]
        return [(leaf, p, rest[len(rest) * p // n : len(rest) * (p + 1) // n]) for p in range(n)]

    for words, docs in seen.items():
        first = min(docs)
        again = len(docs) >= (min(2, s.documents) if len(words) > s.long_words else s.documents)
        for row, at in docs.items():
            if again and row != first:
                gone[row] |= at
            else:
                left.append((words, row, at))
        if len(words) > s.depth + 1:
            for p in parts(words):
                fixed[p] += len(docs)
    members = defaultdict(list)
    for words, row, at in left:
        if len(words) > s.depth + 1:
            same = tuple(p for p in parts(words) if fixed[p] >= s.documents)
            fields = len(words) - s.depth - sum(len(p[2]) for p in same)
            if same and 0 < fields <= s.fields and fields * s.fields_of <= len(words):
                members[same].append((row, at))
    for rows_of in members.values():
        keeper = min(row for row, _ in rows_of)
        if len({row for row, _ in rows_of}) >= s.documents:
            for row, at in rows_of:
                if row != keeper:
                    gone[row] |= at
    return {(row, text): None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[row]) for row, text in rows}


def same_as_plain(docs, settings):
    rows = [tuple(r) for r in docs.select(line_dedup.row_key(F.col("doc_id"), F.col("text")), "text").collect()]
    want = plain_cut(sorted(set(rows), key=repr), settings)
    kept = docs.select("doc_id", "text", line_dedup.row_key(F.col("doc_id"), F.col("text")).alias("own"), F.col("text").alias("before"))
    got = line_dedup.drop_lines(kept, settings).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == want[r.own, r.before]
    return sum(r.n_dropped for r in got)


def test_what_stays_equals_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert same_as_plain(docs, line_dedup.Settings()) > 0
    dice = random.Random(3)
    line = lambda: " ".join(dice.choices("abc", k=dice.randrange(9)) + dice.choices(["x", "y", "z", "7", "Größe"], [9, 5, 1, 1, 1], k=dice.randrange(9)))
    rows = [(i, "\n".join(line() for _ in range(dice.randrange(12)))) for i in range(150)]
    made = spark.createDataFrame(rows + rows[:5], "doc_id long, text string")
    assert same_as_plain(made, line_dedup.Settings(depth=2, fields=2)) > 0
    assert same_as_plain(made, line_dedup.Settings(depth=1, words=2, documents=2, long_words=3, fields_of=2)) > 0


def test_lines_that_share_only_their_path_stay(spark):
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"), F.translate(F.hex(F.xxhash64("id")), "0123456789", "ghijklmnop").alias("w"))
    docs = ids.select("doc_id", F.concat(F.lit("the same four words "), "w", F.lit(" "), F.reverse("w")).alias("text"))
    assert line_dedup.drop_lines(docs).where("n_dropped > 0").count() == 0
    # one word after the path, and lines with a half of their own
    five = [(i, f"the capital of country p{w}", "en", "a", 0) for i, w in enumerate("abcd")]
    half = " ".join(chr(97 + i) * 3 for i in range(24))
    own = [(10 + k, " ".join(["now comes the text", half, *[c + chr(97 + i) * 2 for i in range(24)]]), "en", "a", 0) for k, c in enumerate("vwxyz")]
    assert all(r.n_dropped == 0 for r in line_dedup.drop_lines(documents(spark, five + own)).collect())
