"""Language identification by error-correcting output codes.

Every language has a codeword. For each bit a linear classifier over hashed letter
n-grams tells the languages with a 1 there from those with a 0. A text's bits are
decoded to the language whose codeword has the least loss, where each bit counts as
much as its classifier was right on that language. A text whose bits lie further from
its codeword than the code can correct, or whose best two languages are too close, is
flagged as ambiguous.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segflow.llm.common import with_python
from segflow.session import ship

#: Buckets of n-grams, their longest, smoothing, characters read at a time.
BUCKETS, LONGEST, SMOOTH, PIECE = 1 << 15, 3, 0.5, 1 << 20
#: Labelled texts that are read for each language, on average, to fit the classifiers,
#: and the most languages a model can have. The only bounds; both are parameters.
SAMPLE, LANGUAGES = 2000, 1000
#: Most languages of a code with all possible bits; draws of a random code beyond.
EXHAUSTIVE, DRAWS = 7, 50
#: n-grams at which half of a text's evidence counts, and the score below which a
#: text is ambiguous.
HALF, CLEAR = 10, 0.5
UNKNOWN = "und"


# ---- n-grams ----------------------------------------------------------------


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def grams(text: str | None) -> np.ndarray | None:
    """Counts of the text's n-grams by bucket; None if it has no letter.

    Letters are lower-cased and all else is a gap; an n-gram has one to three places and
    no two gaps side by side, and is not a gap alone.
    """
    total, known = None, _letters()
    text = text or ""
    for at in range(0, max(len(text), 1), PIECE):
        piece = text[at : at + PIECE + LONGEST - 1].lower()
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(known[np.minimum(codes, 0x10FFFF)], codes, 0).astype(np.uint32)
        if not codes.any():
            continue
        total = np.zeros(BUCKETS, np.int64) if total is None else total
        ends = len(codes) if at + PIECE >= len(text) else PIECE
        mixed = np.zeros(len(codes), np.uint32)
        good = np.ones(len(codes), bool)
        for n in range(1, LONGEST + 1):
            size = len(codes) - n + 1
            if size <= 0:
                break
            mixed = mixed[:size] * np.uint32(0x9E3779B1) + codes[n - 1 :] * np.uint32(0x85EBCA6B) + np.uint32(n)
            if n > 1:
                good = good[:size] & ((codes[n - 2 : -1] != 0) | (codes[n - 1 :] != 0))
            places = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0xC2B2AE35)
            counted = good if n > 1 else codes != 0
            kept = places[:ends][counted[:ends]] >> np.uint32(17)
            total += np.bincount(kept, minlength=BUCKETS)
    return total


# ---- codes ------------------------------------------------------------------


def codewords(languages: int) -> np.ndarray:
    """A row of 1 and -1 for each language; no two rows are equal, and no column is
    constant or another's opposite. All such columns for few languages, else the draw
    of 10 log2(n) columns whose two nearest rows are furthest apart."""
    if languages < 2:
        return np.ones((languages, 1), np.int8)
    if languages <= EXHAUSTIVE:
        columns = [(1, *rest) for rest in itertools.product((1, -1), repeat=languages - 1) if -1 in rest]
        return np.array(columns, np.int8).T
    random, best, distance = np.random.default_rng(7), None, -1
    width = math.ceil(10 * math.log2(languages))
    for _ in range(DRAWS):
        code = random.choice(np.array([1, -1], np.int8), (languages, width))
        if (np.abs(code.sum(axis=0)) == languages).any():
            continue
        apart = (width - (code.astype(np.int32) @ code.T.astype(np.int32))) // 2
        nearest = apart[~np.eye(languages, dtype=bool)].min()
        if nearest > distance:
            best, distance = code, nearest
    if best is None or distance < 1:
        raise RuntimeError("no code found")
    return best


@dataclass
class Model:
    """``weights[bucket, bit]``; a bit's value is ``slope * (mean weight - middle)``."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    slope: np.ndarray
    middle: np.ndarray
    trust: np.ndarray

    def margins(self, counts: np.ndarray) -> np.ndarray:
        return counts @ self.weights / max(counts.sum(), 1)

    def decode(self, counts: np.ndarray) -> tuple[str, float, bool]:
        """Language, score (0 to 1) and whether the choice is ambiguous."""
        if not self.languages:
            return UNKNOWN, 0.0, True
        seen = counts.sum()
        bits = self.slope * (self.margins(counts) - self.middle) * (seen / (seen + HALF))
        loss = (self.trust * np.logaddexp(0, -self.code * bits)).sum(axis=1) * self.code.shape[1]
        share = np.exp(loss.min() - loss)
        best = int(np.argmin(loss))
        score = float(share[best] / share.sum())
        apart = (self.code != np.where(bits >= 0, 1, -1)).sum(axis=1)
        return self.languages[best], score, bool(score < CLEAR or apart[best] > apart.min() or apart[best] > self.correctable())

    def correctable(self) -> int:
        """Wrong bits that the code makes good."""
        if len(self.languages) < 2:
            return self.code.shape[1]
        same = self.code.astype(np.int32) @ self.code.T.astype(np.int32)
        apart = (self.code.shape[1] - same) // 2
        return int((apart[~np.eye(len(apart), dtype=bool)].min() - 1) // 2)


# ---- fitting ----------------------------------------------------------------


def learns(key: Column) -> Column:
    """Rows whose crc32 of the key's text, modulo 4, is not 2; never those without a key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = grams(text)
            if counts is not None:
                # each text counts alike, however long
                sums[lang] = sums.get(lang, 0) + counts / counts.sum()
    for lang, share in sums.items():
        at = np.flatnonzero(share)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(share[at], pa.float64())], names=["lang", "bucket", "share"])


def _margins_of(shared, code_row: dict[str, int]) -> Callable:
    model = shared.value

    def work(langs: list[str], texts: list[str]) -> list:
        out = [grams(t) for t in texts]
        return [[None if c is None else [float(x) for x in model.margins(c)] for c in out]]

    return work


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE, languages: int = LANGUAGES) -> Model:
    """A model of the non-null languages of ``docs``; beyond ``languages`` of them, of those with
    the most rows, ties to the smaller name.

    About ``sample`` texts of each language, chosen by a hash of the text, are read;
    equal texts count once. What comes to the driver is one number for each language
    and bucket, and three for each language and bit.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    found = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()}
    if not found:
        return Model([], np.ones((0, 1), np.int8), np.zeros((BUCKETS, 1)), np.ones(1), np.zeros(1), np.ones((0, 1)))
    place = F.xxhash64(F.lit("fit"), "text") / F.lit(2.0**64) + 0.5
    # a language that is not learned has no bound, and no row of it is chosen
    bound = F.create_map(*[x for lang_, n in found.items() for x in (F.lit(lang_), F.lit(sample / n))])
    chosen = rows.where(place < F.element_at(bound, F.col("lang"))).withColumn("_hash", F.xxhash64("text")).dropDuplicates(["lang", "_hash"]).select("lang", "text")
    shares = chosen.mapInArrow(_count_grams, "lang string, bucket int, share double").groupBy("lang", "bucket").agg(F.sum("share").alias("share"))
    learned = sorted(found)
    number = {x: i for i, x in enumerate(learned)}
    sums = np.zeros((len(learned), BUCKETS))
    for r in shares.collect():
        sums[number[r["lang"]], r["bucket"]] = round(r["share"], 9)  # the order of adding leaves no trace
    texts = np.maximum(sums.sum(axis=1, keepdims=True), 1e-9)
    # smoothing as if each language had further text spread over all buckets
    likely = (sums / texts * BUCKETS + SMOOTH) / (BUCKETS * (1 + SMOOTH))
    code = codewords(len(learned))
    weights = np.zeros((BUCKETS, code.shape[1]))
    for b in range(code.shape[1]):
        ones, zeros = likely[code[:, b] > 0], likely[code[:, b] < 0]
        if len(ones) and len(zeros):
            weights[:, b] = np.log(ones.mean(axis=0)) - np.log(zeros.mean(axis=0))
    model = Model(learned, code, weights, np.ones(code.shape[1]), np.zeros(code.shape[1]), np.ones(code.shape))
    return _calibrated(chosen, model, number)


def _calibrated(chosen: DataFrame, model: Model, number: dict[str, int]) -> Model:
    """Where each bit's values lie for each language gives its middle and slope, and how
    often they are on the right side how far it is trusted."""
    bits = model.code.shape[1]
    shared = chosen.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField("_margins", T.ArrayType(T.DoubleType()))]
    seen = with_python(chosen, ["lang", "text"], fields, partial(_margins_of, shared, number), ["text"]).where("_margins is not null")
    each = seen.select("lang", F.posexplode("_margins").alias("bit", "m"))
    stats = each.groupBy("lang", "bit").agg(F.avg("m").alias("mean"), F.coalesce(F.var_pop("m"), F.lit(0.0)).alias("var"), F.count("*").alias("n"))
    means, spread, trust = (np.zeros((len(number), bits)) for _ in range(3))
    for r in stats.collect():
        means[number[r["lang"]], r["bit"]], spread[number[r["lang"]], r["bit"]] = round(r["mean"], 9), round(r["var"], 9)
    slope, middle = np.ones(bits), np.zeros(bits)
    for b in range(bits):
        one, zero = model.code[:, b] > 0, model.code[:, b] < 0
        if one.any() and zero.any():
            low, high = means[zero, b].max(), means[one, b].min()
            middle[b] = (low + high) / 2
            # far enough from the middle to be sure, but no surer than a value of 8
            slope[b] = min(max(means[one, b].mean() - means[zero, b].mean(), 1e-6) / (spread[:, b].mean() + 1e-6), 16 / max(means[one, b].mean() - means[zero, b].mean(), 1e-6))
    side = np.where(model.code > 0, 1, -1) * (means - middle)
    # share of values on the right side, taken as normally spread
    trust = np.array([[0.5 * (1 + math.erf(s / math.sqrt(2 * (v + 1e-9)))) for s, v in zip(a, b)] for a, b in zip(side, spread)])
    trust = np.maximum(trust - 0.5, 0.01)
    return Model(model.languages, model.code, model.weights, slope, middle, trust / trust.sum(axis=1, keepdims=True))


# ---- prediction -------------------------------------------------------------


def _predictions(shared) -> Callable:
    model = shared.value

    def work(texts: list[str | None]) -> list:
        out = []
        for text in texts:
            counts = grams(text)
            out.append((UNKNOWN, 0.0, True) if counts is None else model.decode(counts))
        return [list(x) for x in zip(*out)] if out else [[], [], []]

    return work


def predict(docs: DataFrame, model: Model, text: str = "text", drop: Sequence[str] = ()) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``ambiguous`` from each whole text alone.

    Null texts and those without a letter are ``und`` with score 0. Columns with the new
    names are replaced, all others but ``drop`` pass through; nothing is shuffled. The model that
    is broadcast has a fixed size: buckets times bits.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    return with_python(docs, [text], fields, partial(_predictions, shared), drop)
