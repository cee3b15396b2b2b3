"""Held-out accuracy, recall, and every stage of the pipeline."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from samples import DOCS, documents, empty
from segflow.llm import ann, language_id, simhash
from segflow.llm.queries import QUERIES
from segflow.session import stored

FOLDER = "/root/testdata/sf0.01"


def plain_grams(text):
    """Counts by bucket, letter by letter."""
    codes = [ord(c) if c.isalpha() else 0 for c in text.lower()]
    counts = Counter()
    for i in range(len(codes)):
        mixed = 0
        for n in range(1, 4):
            if i + n > len(codes):
                break
            part = codes[i : i + n]
            mixed = (mixed * 0x9E3779B1 + part[-1] * 0x85EBCA6B + n) % 2**32
            if any(part) and all(a or b for a, b in zip(part, part[1:])):
                counts[((mixed ^ (mixed >> 15)) * 0xC2B2AE35) % 2**32 >> 17] += 1
    return counts


@pytest.mark.parametrize("piece", [1 << 20, 5])
def test_grams_equal_plain_python(monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE", piece)
    for text in ["a", "The  Größe, x1y été!", "日本語 text", " a b  c "]:
        got = language_id.grams(text)
        assert {i: got[i] for i in np.flatnonzero(got)} == plain_grams(text)
    assert language_id.grams(None) is None and language_id.grams("12 !") is None


@pytest.mark.parametrize("languages", [2, 3, 4, 7, 8, 40])
def test_codewords_differ(languages):
    code = language_id.codewords(languages)
    assert len({tuple(r) for r in code.tolist()}) == languages
    assert (np.abs(code.sum(axis=0)) < languages).all()


def test_wrong_bits_are_corrected():
    code = language_id.codewords(7)
    width = code.shape[1]
    model = language_id.Model([f"l{i}" for i in range(7)], code, np.eye(width), np.ones(width), np.zeros(width), np.ones(code.shape) / width)
    assert model.correctable() >= 15
    for i in range(7):
        bits = code[i] * 2.0
        bits[: model.correctable()] *= -1
        # counts that give these margins
        model.margins = lambda counts, bits=bits: bits
        assert model.decode(np.full(width, 1000))[0] == f"l{i}"


def test_held_out_accuracy(spark):
    rows = QUERIES["op1_language_id"](spark, FOLDER).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(lang) and 0.15 < sum(r.held_out for r in rows) / len(rows) < 0.35
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_most_languages_is_a_parameter(spark):
    rows = [(f"{word} {i}", lang) for lang, word, n in [("a", "alpha", 3), ("b", "beta", 5), ("c", "gamma", 3), ("d", "delta", 1)] for i in range(n)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert language_id.fit(docs).languages == ["a", "b", "c", "d"]
    model = language_id.fit(docs, languages=2)
    assert model.languages == ["a", "b"]
    assert {r.lang_pred for r in language_id.predict(docs, model).collect()} <= {"a", "b"}


def test_awkward_languages(spark):
    docs = documents(spark)
    model = language_id.fit(docs.where(language_id.learns(F.col("doc_id"))))
    got = language_id.predict(docs, model)
    assert [c for c in got.columns if c not in ("score", "ambiguous")] == [*[c for c in docs.columns if c != "lang_pred"], "lang_pred"]
    for r in got.collect():
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in ("en", "fr", "de")) == letter and (letter or (r.lang_pred, r.score) == ("und", 0.0))
    nothing = language_id.fit(empty(spark))
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}
    one = language_id.fit(docs.where("lang = 'en'"))
    assert {r.lang_pred for r in language_id.predict(docs, one).collect()} == {"und", "en"}
    assert language_id.predict(empty(spark), model).count() == 0


def plain_nearest(ids, vectors, query, k):
    scores = (vectors * vectors[query]).sum(axis=1)
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[query]]
    return [(int(ids[i]), float(scores[i])) for i in order[:k]]


def test_recall_and_exact_scores(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    at = {i: n for n, i in enumerate(ids.tolist())}
    got = {}
    for r in QUERIES["op3_learned_partitions"](spark, FOLDER).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in at if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [rank for rank, *_ in found] == list(range(1, 21))
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        for _, v, s in found:
            assert s == pytest.approx(float((vectors[at[v]] * vectors[at[q]]).sum()), rel=1e-12)
        hits += len({v for _, v, _ in found} & {v for v, _ in plain_nearest(ids, vectors, at[q], 20)})
    assert hits >= 0.9 * 20 * len(got)


def test_awkward_vectors(spark):
    random = np.random.default_rng(1)
    rows = [(i, [float(x) for x in random.normal(size=4)], "x") for i in range(1, 30)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0], "x") for i in range(30)]  # ties
    rows += [(200, None, "x"), (220, [0.0] * 4, "x"), (240, [1.0, None, 1.0, 1.0], "x"), (260, [1.0, float("nan"), 1.0, 1.0], "x")]
    rows += [(280, [1.0, float("inf"), 1.0, 1.0], "x"), (300, [1.0, 2.0], "x"), (None, [1.0] * 4, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, part string")
    got = {}
    for r in ann.search(frame, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    good = [(i, v) for i, v, _ in rows if i is not None and v is not None and len(v) == 4 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, vectors = np.array([i for i, _ in good]), np.array([v for _, v in good])
    assert set(got) == {20, 100, 120}
    for q, found in got.items():
        assert [v for _, v in sorted(found)] == [v for v, _ in plain_nearest(ids, vectors, ids.tolist().index(q), 20)]
    few = ann.search(frame.where("vec_id in (20, 21, 100)"), F.col("vec_id") % 20 == 0).collect()
    assert Counter(r.query_id for r in few) == {20: 2, 100: 2}
    assert ann.search(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def clustered(spark, n):
    """Rows around 128 centres."""
    random = np.random.default_rng(3)
    centres = random.normal(size=(128, 12))
    vectors = centres[np.arange(n) % 128] + 0.05 * random.normal(size=(n, 12))
    return spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<double>"), vectors


def test_parts_grow_with_the_table(spark):
    settings = ann.Settings(parts=8, part_rows=250, sample=6000, rounds=300)
    read = []
    for n in (2_000, 8_000):
        frame, vectors = clustered(spark, n)
        index = ann.fit(frame.select(F.col("embedding").alias("vector")), settings)
        assert index.items.shape[1] == max(8, n // 250)
        read.append(n * index.probes / index.items.shape[1])
    # four times the rows, but a query reads about as many
    assert read[1] <= 2 * read[0] and read[1] <= 0.3 * 8_000
    found = {}
    for r in ann.search(frame, F.col("vec_id") % 20 == 0, settings=settings).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(found) == set(range(0, 8_000, 20))
    ids = np.arange(8_000)
    hits = sum(len(found[q] & {v for v, _ in plain_nearest(ids, vectors, q, 20)}) for q in found)
    assert hits >= 0.9 * 20 * len(found)


def test_scores_of_few_queries_at_a_time(monkeypatch):
    random = np.random.default_rng(4)
    vectors = random.normal(size=(60, 5))
    left = pa.table({"vec_id": np.arange(60), "vector": list(vectors)})
    right = pa.table({"query_id": np.arange(0, 60, 4), "vector": list(vectors[::4])})
    whole = ann._best(7, left, right)
    monkeypatch.setattr(ann, "SCORES", 130)
    assert ann._best(7, left, right).equals(whole) and whole.num_rows == 15 * 7


def test_blocks_change_nothing(spark):
    random = np.random.default_rng(2)
    rows = [(i, [float(x) for x in random.normal(size=8)]) for i in range(400)] + [(1000 + i, [0.5] * 8) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    all_parts = ann.Settings(recall=1.1, block=37, query_block=5, parts=4)
    got = {}
    for r in ann.search(frame, F.col("vec_id") % 20 == 0, settings=all_parts).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float32).astype(np.float64)
    for q, found in got.items():
        assert [v for _, v in sorted(found)] == [v for v, _ in plain_nearest(ids, vectors, ids.tolist().index(q), 20)]


def test_parts_are_even():
    random = np.random.default_rng(3)
    near = random.integers(0, 600, (600, 8))
    part = ann.cut(near, np.arange(600), 6)
    assert max(np.bincount(part, minlength=6)) <= 105


# ---- pipeline ---------------------------------------------------------------


def test_stages_keep_clean_documents(spark):
    docs, kept = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, "/root/testdata/sf0.001"), name)
        kept.append((name, docs.count()))
        if name != "bpe_encode":
            assert docs.columns == columns and docs.schema["text"] == before.schema["text"]
            assert docs.where("n_chars != length(text)").count() == 0
        if name == "language_id":
            assert docs.count() >= 0.98 * before.count()
        if name == "simhash_near_dedup":
            # what stays is one row each, and no text stays twice
            assert docs.count() == docs.select("doc_id").distinct().count() == docs.select("text").distinct().count()
        if name == "mix_sources":
            words = lambda d: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in d.select("text").collect())
            assert words(docs) == pytest.approx(words(before), abs=20)
    assert docs.where("n_tokens * 4 != octet_length(ids)").count() == 0
    assert [n for n, _ in kept] == ["language_id", "line_dedup", "simhash_near_dedup", "mix_sources", "bpe_encode"]


def test_own_words_beside_a_shared_passage_stay(spark):
    passage = "\n".join(" ".join(f"{chr(97 + i)}{chr(97 + j)}" for j in range(20)) for i in range(15))
    own = {i: " ".join(f"own{n}{chr(97 + j)}" for j in range(25)) for i, n in enumerate(["anna", "bert", "cleo", "dora"])}
    rows = [(i, f"{passage}\n{t}", "en", "a", 0) for i, t in own.items()] + [(9 + i, passage, "en", "a", 0) for i in range(3)]
    got = corpus_pipeline.drop_repeated_lines(spark, documents(spark, rows), "").collect()
    assert all(sum(t in r.text for r in got) == 1 for t in own.values())
    assert all(sum(line in r.text for r in got) == 1 for line in passage.split("\n"))
    # a copy without a word left goes, one that keeps lines does not
    assert len(got) == 4 + sum(r.doc_id >= 9 for r in got) <= 5 and all(r.text.split() for r in got)


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (documents(spark), empty(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, ""), name)
            if name != "bpe_encode":
                assert docs.columns == columns
            assert "_doc" not in docs.columns or docs.where("_doc != 'own _doc'").count() == 0


def test_rows_of_the_awkward_tables_are_not_lost_by_language(spark):
    got = corpus_pipeline.identify_language(spark, documents(spark, DOCS), "")
    assert {r.doc_id for r in got.collect()} <= {None, 3, 4, 5, 6, 9, -10}


def test_the_near_duplicates_of_the_pipeline_come_without_a_broadcast_of_cells(spark, monkeypatch):
    joined, links = [], simhash.links

    def seen(codes, distance):
        joined.append(links(codes, distance))
        return joined[-1]

    monkeypatch.setattr(simhash, "links", seen)
    docs = spark.createDataFrame([(i, f"some words {i} of text {i % 3}") for i in range(30)], "doc_id long, text string")
    assert corpus_pipeline.drop_near_duplicates(spark, docs, "").count() > 0
    joined[0].collect()
    text = joined[0]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
