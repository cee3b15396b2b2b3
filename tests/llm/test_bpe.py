"""Ids and decoded texts against the tokenizers library."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from samples import documents, empty
from segflow.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Encoder(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(encoder, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    got = list(encoder.encode(text))
    assert got == want, ascii(text[:80])
    assert encoder.decode(got) == library.decode(want, skip_special_tokens=False)


def test_random_texts(encoder, library):
    random.seed(5)
    letters = "abcdeéßñthingaaa  '.<|>!12́İΣςẞ中文한글\U0001f600ก\xa0 \x1c\x85\n\t"
    for _ in range(1500):
        text = "".join(random.choice(letters) for _ in range(random.randint(0, 60)))
        check(encoder, library, text)
        if random.random() < 0.1:
            check(encoder, library, text + "<|endoftext|><|startoftext|>" + text.replace(" ", "") * 20)


def test_every_letter_of_the_settled_range(encoder, library):
    for code in [*range(bpe.SETTLED + 20), *range(0x2000, 0x2070)]:
        check(encoder, library, f"a{chr(code)}b {chr(code)} {chr(code)}1")


def test_all_vocabulary_words(encoder, library):
    words = [w for w in encoder.vocabulary.final if w.isascii()]
    check(encoder, library, " ".join(words))
    check(encoder, library, "".join(words[:3000]))


def test_new_tries_and_pieces_change_nothing(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "TRIE_STATES", 40)
    monkeypatch.setattr(bpe, "PIECE", 11)
    monkeypatch.setattr(bpe, "GROUP", 100)
    random.seed(6)
    words = ["unbelievable", "their", "rivers,", "Größe", "don't", "a" * 200, "étés"]
    for _ in range(60):
        check(encoder, library, " ".join(random.choice(words) for _ in range(30)))


def test_words_take_their_letters_side_by_side(library, monkeypatch):
    monkeypatch.setattr(bpe, "ABREAST", 100, raising=False)
    monkeypatch.setattr(bpe, "ANSWERS", 16, raising=False)
    with open(PATH, encoding="utf-8") as f:
        encoder = bpe.Encoder(f.read())
    alone, rounds = [], []
    token, steps = bpe.Trie._token, getattr(bpe.Endings, "steps", None)
    monkeypatch.setattr(bpe.Trie, "_token", lambda *a: alone.append(1) or token(*a))
    monkeypatch.setattr(bpe.Endings, "steps", lambda *a: rounds.append(1) or steps(*a), raising=False)
    random.seed(7)
    words = ["".join(random.choice(["th", "e", "ing", "ör", "an", "a\0", "ç", "9", "'s"]) for _ in range(random.randint(1, 9))) for _ in range(1000)]
    words += ["a", "ab", "abc", "a\0", "a\0b", "x" * bpe.TRIE_BYTES, "x" * (bpe.TRIE_BYTES - 1), "É", "İ", "Σας", "e\u0301t\u00e9"]
    check(encoder, library, " ".join(words))
    # a Python call for each letter of each word is what made it slow
    assert not alone and 0 < len(rounds) < 1200 < sum(map(len, set(words)))
    check(encoder, library, "x" * (bpe.TRIE_BYTES + 1) + " " + " ".join(words[:9]))
    assert len(alone) == bpe.TRIE_BYTES + 1


def test_awkward_rows(spark, library):
    vocabulary = bpe.load(spark, PATH)
    docs = documents(spark)
    rows = bpe.encode(docs, vocabulary, decoded=True).collect()
    assert len(rows) == 12 and all(r["_doc"] == "own _doc" for r in rows)
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(want) and bytes(r.ids) == struct.pack(f"<{len(want)}I", *want)
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    again = bpe.decode(bpe.encode(docs, vocabulary, drop=["text"]), vocabulary).collect()
    assert sorted(r.decoded for r in again) == sorted(r.decoded for r in rows)
    assert bpe.encode(empty(spark), vocabulary).count() == 0


def test_query(spark, library):
    from segflow.llm.queries import op4_bpe_round_trip

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op4_bpe_round_trip(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
