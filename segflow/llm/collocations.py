"""Phrase collocations by partitioned mining (SON).

The documents of a language are dealt into a few shards by hash. Every shard is mined
completely, at the part of the support that its share of the words gives: a phrase that
is frequent in the whole is that frequent in one shard at least. The union of what the
shards found is counted in all documents, by the phrases' texts, so the counts are exact.

A shard is not a task: there are as many shards at any size, so the lowered support stays
well above one, and each is spread over all tasks, which count what they read before it is
shuffled. A shard is mined by length: a phrase is counted only where both its shorter ends
are frequent in the shard. Tasks learn that from a bit table of bounded size over
hashes: what collides there, or in the hashes, is counted once more than needed in the
end, and nothing is lost. Words are hashed once and stored; texts are read twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segflow.llm.common import MOST_BITS, bit_table, bound_batches
from segflow.session import ship, stored

#: Capitals become small letters, the marks that end a piece one mark, tabs spaces.
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(_CAPITALS + _ENDS + b"\t", _CAPITALS.lower() + b"." * len(_ENDS) + b" ")
#: No word holds this mark, so it may stand between words as the end of a piece.
_END = b"."
#: Bytes of a text that are cut into words at a time, at the end of a piece, and words of a
#: stream that are counted at a time; longer texts and pieces come whole.
SEGMENT, STREAM = 1 << 20, 1 << 18
#: Odd multipliers that mix 64-bit numbers.
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Bits of a key that are a hash; shorter keys are less to shuffle. Phrases whose keys collide
#: are counted together, so no frequent one is lost, however large the corpus.
_KEY_BITS = 40
#: Low bits of a key that number the shard.
_SHARD_BITS = 3
#: Words that a task counts before it shuffles, on average, counts that it holds at a time, and
#: words whose counts come together in a bucket.
_TASK_WORDS, _HELD, _BUCKET_WORDS = 1 << 22, 1 << 20, 1 << 19


@dataclass(frozen=True)
class Settings:
    """``support``: occurrences a phrase needs. ``longest``: words of a phrase. ``shards``:
    parts that are mined on their own, 8 at most. ``most_bits``: size of the largest bit
    table, which is what is broadcast."""

    support: int = 100
    longest: int = 5
    shards: int = 3
    most_bits: int = MOST_BITS


# ---- words and keys ---------------------------------------------------------


def cut_words(text: bytes) -> Iterator[list[bytes]]:
    """Lists of words, with a mark after each piece; texts are cut only between pieces."""
    plain, at = text.translate(_PLAIN), 0
    while at < len(plain):
        cut = plain.find(_END, at + SEGMENT) + 1 or len(plain)
        yield [*plain[at:cut].replace(_END, b" . ").split(), _END]
        at = cut


@dataclass
class _Words:
    """A stream of words: ``codes`` number the texts in ``known``, whose hashes are
    ``hashes`` (0 for the end of a piece); ``row`` is the row that each came from."""

    codes: np.ndarray
    known: pa.Array
    hashes: np.ndarray
    row: np.ndarray


def _read_words(texts: pa.Array) -> Iterator[_Words]:
    """Streams of about a segment each, whole texts where they are shorter."""
    flat, lengths, rows = [], [], []
    size = 0
    for i, text in enumerate(texts.cast(pa.binary()).to_pylist()):
        for words in cut_words(text or b""):
            flat.extend(words)
            lengths.append(len(words))
            rows.append(i)
            size += len(words)
            if size >= STREAM:
                yield _coded(flat, lengths, rows)
                flat, lengths, rows, size = [], [], [], 0
    if flat:
        yield _coded(flat, lengths, rows)


def _coded(flat: list[bytes], lengths: list[int], rows: list[int]) -> _Words:
    import xxhash

    coded = pa.array(flat, pa.large_binary()).dictionary_encode()
    known = coded.dictionary
    hashes = np.fromiter((0 if w == _END else xxhash.xxh3_64_intdigest(w) or 1 for w in known.to_pylist()), np.uint64, len(known))
    return _Words(coded.indices.to_numpy(), known, hashes, np.repeat(rows, lengths))


def _grams(hashes: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For lengths from 1: hashes of the phrases that begin at each place, and which of them
    lie inside one piece."""
    inside = hashes != 0
    grams, whole = hashes, inside
    for length in range(1, longest + 1):
        yield grams, whole
        grams = grams[:-1] * _STEP + hashes[length:] if len(grams) > 1 else grams[:0]
        whole = whole[:-1] & inside[length:] if len(whole) > 1 else whole[:0]


def _keys(grams: np.ndarray, language: np.ndarray) -> np.ndarray:
    """Hashes of language and phrase; the lowest bits are left for a shard."""
    x = grams ^ language
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x ^= x >> np.uint64(29)
    return x >> np.uint64(64 - _KEY_BITS) << np.uint64(64 - _KEY_BITS)


def _in_shard(keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """What the bit table of a length knows a key of a shard by."""
    return keys ^ (shard << np.uint64(64 - _SHARD_BITS))


# ---- mining -----------------------------------------------------------------


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words' hashes of each text and their number, in rows of a segment at most."""
    for batch in batches:
        language, shard = batch.column("language").to_numpy(), batch.column("shard").to_numpy()
        for words in _read_words(batch.column("text")):
            hashes = words.hashes[words.codes]
            cuts = np.flatnonzero(np.diff(words.row, prepend=-1))
            ends = np.append(cuts[1:], len(hashes))
            own = words.row[cuts]
            packed = pa.array([hashes[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())
            n = np.add.reduceat((hashes != 0).astype(np.int64), cuts)
            yield pa.RecordBatch.from_arrays([pa.array(language[own]), pa.array(shard[own]), pa.array(n), packed], names=["language", "shard", "n", "words"])


def _streams(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes of the words, language and shard of each, for a few rows at a time."""
    column = batch.column("words")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    hashes = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.uint64)
    offsets = (offsets - offsets[0]) // 8
    language, shard = batch.column("language").to_numpy().view(np.uint64), batch.column("shard").to_numpy().astype(np.uint64)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + STREAM, side="right")) - 1)
        lengths = np.diff(offsets[first : last + 1])
        yield hashes[offsets[first] : offsets[last]], np.repeat(language[first:last], lengths), np.repeat(shard[first:last], lengths)
        first = last


def _summed(language: np.ndarray, keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key of a language once, in order, with the sum of its counts."""
    order = np.argsort(keys)
    language, keys, n = language[order], keys[order], n[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (language[1:] != language[:-1])
    first = np.flatnonzero(new)
    return language[first], keys[first], np.add.reduceat(n, first) if len(first) else n


def _mine(length: int, buckets: int, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases of ``length`` words whose two ends, one word shorter, are in
    the table of their shard; packed by bucket of the keys."""
    held, size = [], 0
    for batch in batches:
        for hashes, language, shard in _streams(batch) if batch.num_rows else ():
            shorter = None
            for n, (grams, whole) in enumerate(_grams(hashes, length), 1):
                if n == length - 1:
                    shorter = np.zeros(len(grams), bool)
                    at = np.flatnonzero(whole)
                    shorter[at] = shared.value.holds(_in_shard(_keys(grams[at], language[at]), shard[at]))
                if n == length:
                    at = np.flatnonzero(whole if shorter is None else whole & shorter[:-1] & shorter[1:])
                    held.append(_summed(language[at], _keys(grams[at], language[at]) | shard[at], np.ones(len(at), np.int64)))
                    size += len(held[-1][1])
            if size >= _HELD:
                yield _packed(held, buckets)
                held, size = [], 0
    if size:
        yield _packed(held, buckets)


def _bytes(numbers: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` lowest bytes of each number, the lowest first."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def _numbers(planes: bytes, width: int) -> np.ndarray:
    """The numbers of which ``planes`` holds all lowest bytes, then all next ones, and so on."""
    out = np.zeros((len(planes) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def _packed(held: list[tuple[np.ndarray, ...]], buckets: int) -> pa.RecordBatch:
    """A row for each bucket and language, with its keys by shard and hash: the hashes as
    steps from one to the next, their shards and counts.

    A bucket is a range of hashes, so a step is about the range of all hashes over the keys held,
    however many buckets there are. Bytes of one place stand together: the high ones of
    steps and counts are nearly all zero, shards are runs, and the shuffle compresses both.
    """
    joined = [np.concatenate(x) for x in zip(*held)]
    held.clear()
    language, keys, n = _summed(*joined)
    del joined
    names, number = np.unique(language, return_inverse=True)
    del language
    hashed, shard = keys >> np.uint64(64 - _KEY_BITS), (keys & np.uint64((1 << _SHARD_BITS) - 1)).astype(np.uint8)
    del keys
    cell = (hashed * np.uint64(buckets) >> np.uint64(_KEY_BITS)).astype(np.int64) * len(names) + number
    del number
    order = np.argsort(cell << _SHARD_BITS | shard, kind="stable")
    cell, hashed, shard, n = cell[order], hashed[order], shard[order], n[order]
    del order
    cuts = np.flatnonzero(np.diff(cell, prepend=-1))
    steps = np.diff(hashed, prepend=np.uint64(0))
    steps[cuts] = hashed[cuts]
    spans = list(zip(cuts, np.append(cuts[1:], len(cell))))
    columns = [pa.array(cell[cuts] // len(names)), pa.array(names[cell[cuts] % len(names)].view(np.int64))]
    for x in (_bytes(steps, _KEY_BITS // 8), shard, _bytes(n, 4)):
        columns.append(pa.array([x[a:b].T.tobytes() for a, b in spans], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "language", "keys", "shards", "counts"])


def _sum_bucket(table: pa.Table) -> pa.Table:
    """The keys of a bucket and language that are frequent in their shard."""
    steps, shards, counts = (table.column(c).to_pylist() for c in ("keys", "shards", "counts"))
    # sums and steps are modulo the range of hashes: a step back to the next shard's first is one forward
    hashed = np.concatenate([np.cumsum(_numbers(s, _KEY_BITS // 8)) for s in steps])
    n = np.concatenate([_numbers(c, 4) for c in counts]).astype(np.int64)
    keys = hashed << np.uint64(64 - _KEY_BITS) | np.frombuffer(b"".join(shards), np.uint8)
    _, keys, n = _summed(np.zeros(len(n), np.uint8), keys, n)
    needed = np.array(table.column("needed")[0].as_py())
    frequent = keys[n >= needed[(keys & np.uint64((1 << _SHARD_BITS) - 1)).astype(np.int64)]]
    return pa.table({"key": frequent.astype(np.uint64).view(np.int64)})


def _frequent(docs: DataFrame, settings: Settings) -> DataFrame:
    """``key`` of every phrase, of any length, that is frequent in one of its shards."""
    spark = docs.sparkSession
    shard = F.pmod(F.xxhash64(F.lit("shard"), "key", "text"), F.lit(settings.shards)).alias("shard")
    read = docs.select(F.xxhash64("lang").alias("language"), shard, "text")
    words = stored(read.mapInArrow(_hashed, "language long, shard long, n long, words binary"), "words")
    own = F.col("key").bitwiseAND((1 << _SHARD_BITS) - 1).alias("shard")
    in_shard = F.col("key").bitwiseXOR(F.shiftleft(own, 64 - _SHARD_BITS))
    sizes = words.groupBy("language", "shard").agg(F.sum("n").alias("own"))
    whole = sizes.groupBy("language").agg(F.sum("own").alias("whole")).where("whole > 0")
    # the least whole number that is not below the shard's part of the support
    share = F.expr(f"cast((cast(own as decimal(30, 0)) * {settings.support} + whole - 1) div whole as bigint)")
    total = sizes.agg(F.coalesce(F.sum("own"), F.lit(0))).first()[0]
    words = words.select("language", "shard", "words").coalesce(max(-(-total // _TASK_WORDS), spark.sparkContext.defaultParallelism))
    needs = sizes.join(whole, "language").select("language", "shard", share.alias("needed"))
    by_shard = F.map_from_entries(F.collect_list(F.struct("shard", "needed")))
    needs = needs.groupBy("language").agg(by_shard.alias("_by")).select("language", F.array(*[F.coalesce(F.try_element_at("_by", F.lit(i).cast("long")), F.lit(1).cast("long")) for i in range(1 << _SHARD_BITS)]).alias("needed"))
    needs = stored(needs, "needs")
    buckets = max(-(-total // _BUCKET_WORDS), 1)
    kind = "bucket long, language long, keys binary, shards binary, counts binary"
    found, shared = [], None
    for length in range(1, settings.longest + 1):
        each = words.mapInArrow(partial(_mine, length, buckets, shared), kind).join(needs, "language")
        frequent = each.groupBy("bucket", "language").applyInArrow(_sum_bucket, "key long")
        found.append(stored(frequent, "frequent"))
        if shared is not None:
            shared.destroy()  # else every worker keeps the tables of all lengths
        if length < settings.longest:
            shared = spark.sparkContext.broadcast(bit_table(found[-1], in_shard, settings.most_bits))
    return reduce(DataFrame.unionByName, found)


# ---- exact counts -----------------------------------------------------------


def _count(longest: int, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang``, ``phrase``, ``n``: occurrences of each candidate by its text, and of all
    words under a null phrase."""
    for batch in batches:
        if not batch.num_rows:
            continue
        langs = batch.column("lang").dictionary_encode()
        hashed, lang_of = batch.column("language").to_numpy().view(np.uint64), langs.indices.to_numpy()
        for words in _read_words(batch.column("text")):
            hashes, language, lang = words.hashes[words.codes], hashed[words.row], lang_of[words.row].astype(np.int64)
            total = np.bincount(lang[hashes != 0], minlength=len(langs.dictionary))
            yield _named(langs.dictionary, pa.nulls(len(total), pa.string()), total)
            # same numbers mean the same language and words, so texts are never told apart by a hash
            same, passed, width = lang, None, len(words.known)
            for n, (grams, whole) in enumerate(_grams(hashes, longest), 1):
                at = np.flatnonzero(whole if passed is None else whole & passed[:-1] & passed[1:])
                at = at[shared.value.holds(_keys(grams[at], language[at]))]
                _, first, number, counts = np.unique(same[at] * width + words.codes[at + n - 1], return_index=True, return_inverse=True, return_counts=True)
                passed, same = np.zeros(len(grams), bool), np.zeros(len(grams), np.int64)
                passed[at], same[at] = True, number
                begin = at[first]
                phrase = words.known.take(pa.array(words.codes[begin]))
                for i in range(1, n):
                    phrase = pc.binary_join_element_wise(phrase, words.known.take(pa.array(words.codes[begin + i])), pa.scalar(b" ", pa.large_binary()))
                yield _named(langs.dictionary.take(pa.array(lang[begin])), phrase.cast(pa.large_string()).cast(pa.string()), counts)


def _named(lang: pa.Array, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang, phrase, pa.array(n.astype(np.int64))], names=["lang", "phrase", "n"])


def phrase_counts(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang``, ``phrase``, ``n``: every phrase of 1 to ``longest`` words with ``support``
    occurrences in its language; the row of a language with a null phrase counts all words."""
    if not 1 <= settings.shards <= 1 << _SHARD_BITS:
        raise ValueError(f"1 to {1 << _SHARD_BITS} shards")
    spark = docs.sparkSession
    ship(spark)
    bound_batches(spark)
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bare = F.col("key").bitwiseAND(-1 << _SHARD_BITS)
    candidates = _frequent(own, settings).select(bare.alias("key")).distinct()
    shared = spark.sparkContext.broadcast(bit_table(candidates, F.col("key"), settings.most_bits))
    read = own.select("lang", F.xxhash64("lang").alias("language"), "text")
    each = read.mapInArrow(partial(_count, settings.longest, shared), "lang string, phrase string, n long")
    counts = each.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    counted = stored(counts.where(F.col("phrase").isNull() | (F.col("n") >= settings.support)), "phrases")
    shared.destroy()
    return counted


# ---- scores -----------------------------------------------------------------


def _phrase(words: Column) -> Column:
    return F.array_join(words, " ")


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)), exactly: products of three counts need more than 64 bits."""
    a, n, left, right = [c.cast("decimal(17, 0)") for c in (a, n, left, right)]
    return F.call_function("div", a * n * F.lit(1000).cast("decimal(4, 0)"), left * right)


def _scored(counts: DataFrame) -> DataFrame:
    """Every phrase of two words or more with its lowest-scoring cut."""
    total = counts.where("phrase is null").select("lang", F.col("n").alias("_n"))
    known = counts.where("phrase is not null")
    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.size("_words") - 1)).alias("_k")
    each = known.select("lang", "phrase", F.col("n").alias("a"), words.alias("_words")).where(F.size("_words") > 1).select("*", cut)
    each = each.select(
        "lang", "phrase", "a", "_k", _phrase(F.slice("_words", F.lit(1), F.col("_k"))).alias("_first"), _phrase(F.slice("_words", F.col("_k") + 1, F.size("_words"))).alias("_rest")
    )
    first = known.select("lang", F.col("phrase").alias("_first"), F.col("n").alias("l"))
    rest = known.select("lang", F.col("phrase").alias("_rest"), F.col("n").alias("r"))
    both = each.join(first, ["lang", "_first"]).join(rest, ["lang", "_rest"]).join(total, "lang")
    valued = both.withColumn("score", score(F.col("a"), F.col("_n"), F.col("l"), F.col("r")))
    best = valued.groupBy("lang", "phrase").agg(F.min(F.struct("score", "_k", "a", "l", "r", "_n")).alias("_best"))
    return best.select("lang", "phrase", *[F.col("_best")[c].alias(c.strip("_")) for c in ("a", "l", "r", "_n", "score")])


def _contained(counts: DataFrame) -> DataFrame:
    """``lang``, ``phrase`` of those that lie in a longer phrase which occurs as often."""
    words = F.split("phrase", " ")
    longer = counts.where("phrase is not null").select("lang", "n", words.alias("_words")).where(F.size("_words") > 2)
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size("_words") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.size("_words") - size + 1), lambda at: _phrase(F.slice("_words", at, size))),
        )
    )
    parts = longer.select("lang", "n", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("n").alias("_most"))
    return counts.join(parts, ["lang", "phrase"]).where("_most >= n").select("lang", "phrase")


def collocations(docs: DataFrame, settings: Settings = Settings(), first: int = 2000, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: of every language
    the ``first`` phrases of 2 to ``longest`` words by score.

    Texts are read whole, capitals A to Z as small letters; pieces end at ``. , ; : ! ?`` and
    line ends, words at spaces and tabs. ``a`` counts the phrase, overlaps included, ``n``
    all words; ``l`` and ``r`` count the two sides of the cut with the lowest score, the
    first of equal ones. Phrases within a longer one that occurs as often are left out.
    Equal scores go by ``a``, then by the phrase in byte order, so no rank is shared.
    A null language is ``und``, a null or empty text has no word, repeated rows count as
    often as they come; an empty table gives no row. Other columns are not read.
    """
    counts = phrase_counts(docs, settings, key, text, lang)
    kept = _scored(counts).join(_contained(counts), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language is cut to its best in parts, then as a whole
    part = F.pmod(F.xxhash64(F.lit("part"), "phrase"), F.lit(64))
    some = kept.withColumn("_place", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("_place") <= first)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
