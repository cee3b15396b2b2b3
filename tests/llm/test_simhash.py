"""Fingerprints, links and components against plain Python."""

import random
import re

import pytest
import xxhash

from samples import documents, empty
from segflow.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text, width=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    codes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum((2 * sum(c >> b & 1 for c in codes) > len(codes)) << b for b in range(64))


def plain_components(codes, distance):
    root = {k: k for k in codes}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(codes)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (codes[a] ^ codes[b]).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("size", [1 << 20, 7])
def test_fingerprint_equals_plain_python_whole_and_in_pieces(monkeypatch, size):
    monkeypatch.setattr(simhash, "PIECE", size)
    random.seed(3)
    words = ["The", "ÉTÉ", "of", "a", "xyz", "IO", "ß"]
    for n in [0, 1, 2, 3, 4, 9, 60]:
        text = "".join(random.choice(words) + random.choice([" ", "\n", "\t ", "\x0b"]) for _ in range(n))
        assert simhash.simhash(text) == plain_fingerprint(text)


def _joins(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("distance", [1, 2])
def test_cells_are_never_broadcast_on_an_estimate_from_before_the_explode(spark, distance):
    codes = spark.createDataFrame([(c,) for c in range(60)], "_code long")
    text = _joins(simhash.links(codes, distance))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_links_equal_all_pairs(spark, distance):
    random.seed(distance)
    codes = {random.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1, 1 << 63}
    for c in list(codes):
        for bits in (1, 2, 3, 2):
            codes.add(c ^ sum(1 << b for b in random.sample(range(64), bits)))
    signed = [simhash._signed(c) for c in codes]
    found = simhash.links(spark.createDataFrame([(c,) for c in signed], "_code long"), distance).collect()
    want = {tuple(sorted((a, b))) for a in signed for b in signed if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance}
    assert len(found) == len(want) and {(r.a, r.b) for r in found} == want


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1001 + i) for i in range(300)]
    found = dict(simhash.components(spark.createDataFrame(chain + hub, "a long, b long")).collect())
    assert found == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(301)}


def test_awkward_rows(spark):
    rows = simhash.near_duplicates(documents(spark)).collect()
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    assert len(rows) == 12
    want = plain_components({k: plain_fingerprint(t) for k, t in texts.items() if k is not None}, 2)
    for r in rows:
        assert int(r.fingerprint, 16) == plain_fingerprint(texts[r.doc_id])
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]
    assert {r.doc_id: r.component_id for r in rows}[2] == 1
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_one_document_of_each_group_stays_with_its_columns(spark):
    docs = documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 99 for r in kept.collect()) == sorted([1, 3, 4, 7, 9, -10, 99])


def test_different_texts_under_one_key_both_stay(spark):
    rows = [(1, "one text of some words", "en", "a", 1), (1, "quite another one it is", "en", "b", 2), (1, "one text of some words", "en", "a", 1), (2, "one text of some words", "en", "c", 3)]
    kept = simhash.keep_one(documents(spark, rows))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "one text of some words"), (1, "quite another one it is")]


def test_near_copies_meet(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(i, base.replace(f"w{i * 7} ", f"v{i} ", 1), "en", "a", 1) for i in range(20)]
    rows += [(100 + i, " ".join(f"z{i}_{j}" for j in range(100)), "en", "a", 1) for i in range(20)]
    found = simhash.near_duplicates(documents(spark, rows)).collect()
    want = plain_components({r[0]: plain_fingerprint(r[1]) for r in rows}, 2)
    assert {r.doc_id: r.component_id for r in found} == want
