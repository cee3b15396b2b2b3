"""Encoding and decoding with a word-end BPE vocabulary, by a trie of distinct words.

For every prefix of a word only the last token of the prefix's encoding is kept:
it is the one token that ends there and may follow the last token of the rest.
Distinct words share a trie, so the state of a shared prefix is computed once: sorted
words lie side by side as they do in the trie, and all of them take a letter at a time. Very long
words visit it depth-first instead, and only the path to the present word is held. The
tokens of a word are read back from its end, last token by last token.
"""

from __future__ import annotations

import gc
import json
import unicodedata
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from segflow.llm.common import with_python

#: Fixed values of the vocabulary's format: the mark of a word's end, and the
#: characters that stand for bytes (printable ones for themselves).
WORD_END = "</w>"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Fixed value: the word pattern of the vocabulary file that this module can read.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters of a text that are cut into words at a time, and of texts whose words are
#: walked together.
PIECE, GROUP = 1 << 20, 1 << 20
#: Bytes of the longest word whose ids are kept and that takes its letters beside others, and how
#: many words and chunks a task keeps before it starts anew. They bound memory and change no result.
TRIE_BYTES, TRIE_STATES = 64, 250_000
#: Words that take their letters side by side, and answers that a table of them keeps (a power of
#: two). They bound memory and change no result.
ABREAST, ANSWERS = 1 << 15, 1 << 18
#: Below this code point case, composition and classes are the same in all versions
#: of Unicode in use here; other texts go through the tokenizer file's own steps.
SETTLED = 0x530


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in the vocabulary."""
    other = iter(range(256, 512))
    return {b: chr(b) if b in PRINTABLE else chr(next(other)) for b in range(256)}


class Vocabulary:
    """Tokens and merges, with what is needed to tell which tokens may be neighbours."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END or spec["decoder"] or spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != WORDS:
            raise ValueError("not a word-end BPE vocabulary of the known form")
        self.spec = text
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ids = model["vocab"]
        letters = {c: b for b, c in byte_letters().items()}
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        self.width = array("i", [0]) * (max(ids.values(), default=-1) + 1)
        for token, i in ids.items():
            ends = token.endswith(WORD_END) and len(token) > len(WORD_END)
            raw = "".join(chr(letters[c]) for c in (token[: -len(WORD_END)] if ends else token))
            (self.final if ends else self.inner)[raw] = i
            self.width[i] = len(raw)
        self.strings = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merge = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(merges)}
        self.parts = {ids[a + b] if not a.endswith(WORD_END) else -1: (ids[a], ids[b]) for a, b in merges}
        if len(self.parts) != len(merges):
            raise ValueError("a token has two merges")
        self.rank = {t: self.merge[p] for t, p in self.parts.items()}
        self.never = len(merges)
        self._edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self._whole: dict[int, bool] = {}
        #: Known answers of :meth:`fits`, by both ids in one number.
        self.known_fits: dict[int, bool] = {}
        # a token that its own letters do not give is never part of an encoding
        self.inner = {w: t for w, t in self.inner.items() if self.whole(t)}
        self.final = {w: t for w, t in self.final.items() if self.whole(t)}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one side (0 left, 1 right) while ``token`` is being built,
        each with the rank of the merge that takes it up."""
        known = self._edges.get((token, side))
        if known is None:
            known, at, until = [], token, self.never
            while True:
                known.append((at, until))
                if at not in self.parts:
                    break
                until = self.rank[at]
                at = self.parts[at][side]
            self._edges[token, side] = known
        return known

    def fits(self, a: int, b: int) -> bool:
        """Whether no merge across the seam comes first when both are built side by
        side. Of equal merges the left one comes first."""
        merge, right = self.merge, self.edge(b, 0)
        found = True
        for x, gone_x in self.edge(a, 1):
            for y, gone_y in right:
                rank = merge.get((x, y))
                if rank is not None and rank < gone_x and rank <= gone_y:
                    found = False
        if len(self.known_fits) > TRIE_STATES:
            self.known_fits.clear()
        self.known_fits[a << 20 | b] = found
        return found

    def whole(self, token: int) -> bool:
        """Whether merging the token's letters gives the token."""
        known = self._whole.get(token)
        if known is None:
            parts = self.parts.get(token)
            known = parts is None or (self.whole(parts[0]) and self.whole(parts[1]) and self._meets(token))
            self._whole[token] = known
        return known

    def _meets(self, token: int) -> bool:
        a, b = self.parts[token]
        own = self.rank[token]
        for x, gone_x in self.edge(a, 1):
            for y, gone_y in self.edge(b, 0):
                rank = self.merge.get((x, y))
                if (x, y) != (a, b) and rank is not None and rank < min(gone_x, own) and rank <= min(gone_y, own):
                    return False
        return True


class Answers:
    """Answers to whole arrays of questions, which are numbers from 0. A place of the table keeps
    the newest answer of the questions that share it."""

    def __init__(self, answer: Callable[[int], int]):
        self.answer = answer
        self.asked, self.told = np.full(ANSWERS, -1, np.int64), np.empty(ANSWERS, np.int32)

    def __call__(self, questions: np.ndarray) -> np.ndarray:
        at = (questions * 0x9E3779B97F4A7C1 >> 40) & (ANSWERS - 1)
        out = self.told[at]
        new = np.flatnonzero(self.asked[at] != questions)
        if len(new):
            fresh = questions[new]
            out[new] = list(map(self.answer, fresh.tolist()))
            self.asked[at[new]], self.told[at[new]] = fresh, out[new]
        return out


class Endings:
    """Which tokens end at a place of a word, longest first.

    A state is the longest end of what was read that begins some token. States,
    what a state falls back to and the tokens that end in it are worked out when
    first needed, and kept.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.go: dict[int, int] = {}
        self.parent, self.letter, self.own = [0], [0], [0]
        for tokens, mark in ((vocabulary.inner, 0), (vocabulary.final, 256)):
            for word, token in tokens.items():
                state, codes = 0, word.encode("latin-1")
                for i, code in enumerate(codes, 1):
                    code += mark * (i == len(codes))
                    found = self.go.get(state << 9 | code)
                    if found is None:
                        found = self.go[state << 9 | code] = len(self.own)
                        self.parent.append(state)
                        self.letter.append(code)
                        self.own.append(-1)
                    state = found
                self.own[state] = token
        self._back: list[int | None] = [0] + [None] * (len(self.own) - 1)
        #: The nearest state with a token, at a state or behind it, and the nearest behind it;
        #: 0 if there is none, -1 if not yet worked out. The other names are for whole arrays.
        self.near, self.behind = array("i", [0]) + array("i", [-1]) * (len(self.own) - 1), array("i", [0]) * len(self.own)
        self.own = array("i", self.own)
        self.all_near, self.all_behind, self.all_own = (np.frombuffer(x, np.int32) for x in (self.near, self.behind, self.own))
        self._steps = Answers(lambda pair: self.step(pair >> 9, pair & 511))

    def step(self, state: int, code: int) -> int:
        found = self.go.get(state << 9 | code)
        if found is None:
            found = self.go[state << 9 | code] = self.step(self.back(state), code) if state else 0
        return found

    def back(self, state: int) -> int:
        if self._back[state] is None:
            parent = self.parent[state]
            self._back[state] = self.step(self.back(parent), self.letter[state]) if parent else 0
        return self._back[state]

    def settle(self, state: int) -> int:
        """Work out ``near`` and ``behind`` of the state and of those it falls back to."""
        if self.near[state] < 0:
            self.behind[state] = self.settle(self.back(state))
            self.near[state] = state if self.own[state] >= 0 else self.behind[state]
        return self.near[state]

    def steps(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """:meth:`step` for each pair, and their ``near`` and ``behind`` worked out."""
        found = self._steps(states.astype(np.int64) << 9 | codes)
        for state in set(found[self.all_near[found] < 0].tolist()):
            self.settle(state)
        return found


class Trie:
    """A trie of words with the last token of each prefix.

    Sorted words are a depth-first walk of it: each keeps what it shares with the word before.
    A word's last letter is of its own kind, as tokens at a word's end are tokens of
    their own, and so never shared.
    """

    def __init__(self, vocabulary: Vocabulary, endings: Endings):
        self.vocabulary, self.endings = vocabulary, endings
        self.widths = np.frombuffer(vocabulary.width, np.int32)
        self._fits = Answers(self._fit)

    def encode(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """The packed ids of each of the sorted ``words`` of byte letters."""
        short = [w for w in words if len(w) <= TRIE_BYTES]
        for at in range(0, len(short), ABREAST):
            some = short[at : at + ABREAST]
            yield from zip(some, self._abreast(some))
        if len(short) < len(words):
            yield from self._deep([w for w in words if len(w) > TRIE_BYTES])

    def _abreast(self, words: list[str]) -> list[bytes]:
        """All words take a letter at a time; only the first word with a prefix works it out."""
        codes = [w.encode("latin-1") for w in words]
        lengths = np.fromiter(map(len, codes), np.int64, len(codes))
        width = int(lengths.max())
        letters = _letters(codes, width)
        keep, number = np.array(_shared(codes)), np.arange(len(codes))
        states, lasts = np.zeros(len(codes), np.int32), np.full((len(codes), width + 1), -1, np.int32)
        for i in range(width):
            own = keep <= i
            rows = np.flatnonzero(own & (i < lengths))
            after = self.endings.steps(states[rows], letters[rows, i] + 256 * (lengths[rows] == i + 1))
            states[rows] = after
            lasts[rows, i + 1] = self._tokens(after, i + 1, rows, lasts)
            first = np.maximum.accumulate(np.where(own, number, 0))
            states, lasts[:, i + 1] = states[first], lasts[first, i + 1]
        return self._read_all(lasts, lengths)

    def _tokens(self, states: np.ndarray, end: int, rows: np.ndarray, lasts: np.ndarray) -> np.ndarray:
        """:meth:`_token` for the states that words number ``rows`` are in."""
        endings, out = self.endings, np.empty(len(states), np.int32)
        open_, at = np.arange(len(states)), endings.all_near[states]
        while len(open_):
            if not at.all():
                raise ValueError("no token ends here")
            token = endings.all_own[at]
            size = self.widths[token]
            good = size == end
            ask = np.flatnonzero(~good)
            good[ask] = self._fits(lasts[rows[open_[ask]], end - size[ask]].astype(np.int64) << 20 | token[ask])
            out[open_[good]] = token[good]
            open_, at = open_[~good], endings.all_behind[at[~good]]
        return out

    def _read_all(self, lasts: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """The packed ids of all words, whose ``lasts`` are rows."""
        rows, ends, taken, counts = np.arange(len(lengths)), lengths, [], np.zeros(len(lengths), np.int64)
        while len(rows):
            tokens = lasts[rows, ends]
            taken.append((rows, tokens))
            counts[rows] += 1
            ends = ends - self.widths[tokens]
            rows, ends = rows[ends > 0], ends[ends > 0]
        until = np.cumsum(counts)
        ids = np.empty(int(until[-1]), "<u4")
        for i, (rows, tokens) in enumerate(taken, 1):
            ids[until[rows] - i] = tokens
        packed, bounds = ids.tobytes(), (4 * until).tolist()
        return [packed[a:b] for a, b in zip([0, *bounds], bounds)]

    def _deep(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Depth-first, one word after the other; the path holds the states of a word's prefixes."""
        step, token_of, go = self.endings.step, self._token, self.endings.go
        codes = [w.encode("latin-1") for w in words]
        path, lasts = [0], [-1]
        for word, letters, keep in zip(words, codes, _shared(codes)):
            del path[keep + 1 :], lasts[keep + 1 :]
            state, end = path[keep], len(letters) - 1
            for i in range(keep, end):
                after = go.get(state << 9 | letters[i])
                state = step(state, letters[i]) if after is None else after
                lasts.append(token_of(state, i + 1, lasts))
                path.append(state)
            yield word, self._read(lasts, token_of(step(state, letters[end] + 256), end + 1, lasts))

    def _fit(self, pair: int) -> bool:
        """:meth:`Vocabulary.fits` of two ids in one number."""
        known = self.vocabulary.known_fits.get(pair)
        return self.vocabulary.fits(pair >> 20, pair & 0xFFFFF) if known is None else known

    def _token(self, state: int, end: int, lasts: list[int]) -> int:
        """The one token that ends in the state and fits what comes before it."""
        endings, width = self.endings, self.vocabulary.width
        at = endings.settle(state)
        while at:
            token = endings.own[at]
            size = width[token]
            if size == end:
                return token
            if self._fit(lasts[end - size] << 20 | token):
                return token
            at = endings.behind[at]
        raise ValueError("no token ends here")

    def _read(self, lasts: list[int], token: int) -> bytes:
        width, out = self.vocabulary.width, [token]
        end = len(lasts) - width[token]
        while end:
            out.append(lasts[end])
            end -= width[lasts[end]]
        return np.array(out[::-1], "<u4").tobytes()


def _letters(words: list[bytes], width: int) -> np.ndarray:
    """A row of ``width`` letters for each word, with zeros behind the shorter ones."""
    return np.array([w[:width] for w in words], f"S{width}").view(np.uint8).reshape(len(words), width)


def _shared(words: list[bytes]) -> list[int]:
    """How many letters each word has in common with the one before, short of the last of either."""
    if not words:
        return []
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = min(int(lengths.max()), TRIE_BYTES)
    letters = _letters(words, width)
    differ = letters[1:] != letters[:-1]
    same = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return [0, *np.minimum(same, np.minimum(lengths[1:], lengths[:-1]) - 1).tolist()]


class Encoder:
    """Text to token ids and back, as the vocabulary file defines it."""

    def __init__(self, text: str):
        import regex

        self.vocabulary = Vocabulary(text)
        self.trie = Trie(self.vocabulary, Endings(self.vocabulary))
        # no word holds a line end, so it may stand between chunks
        self.words = regex.compile(WORDS + r"|\n")
        # without the four control characters that only Python takes for white space
        self.plain = regex.compile(f"[\\x00-\\x1b\\x20-{chr(SETTLED - 1)}\\u2010-\\u2027]*+")
        special = self.vocabulary.special
        self.specials = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.from_letter = {c: chr(b) for b, c in byte_letters().items()}
        strings = self.vocabulary.strings
        self.strings = np.array([strings.get(i) for i in range(max(strings, default=-1) + 1)], object)
        self.library = None
        self.reset()

    def reset(self) -> None:
        """Forget what words and chunks, which lie between white space, are encoded to."""
        self.known_words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def _words(self, chunks: list[str]) -> list[str | list[str]]:
        """Normalised words of each plain chunk, as one letter for each byte; a chunk of letters
        alone is a word."""
        whole = "\n".join(chunks)
        whole = whole.lower() if whole.isascii() else unicodedata.normalize("NFC", whole).replace("Σ", "σ").lower()
        out = whole.split("\n")
        mixed = [i for i, x in enumerate(out) if not x.isalpha()]
        at = iter(mixed)
        for w in self.words.findall("\n".join(["", *map(out.__getitem__, mixed)])):
            if w == "\n":
                out[next(at)] = own = []
            else:
                own.append(w if w.isascii() else w.encode().decode("latin-1"))
        return [x if type(x) is list or x.isascii() else x.encode().decode("latin-1") for x in out]

    def _other_words(self, text: str) -> list[str]:
        """The same for any text, by the steps that the file names."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.vocabulary.spec)
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return ["".join(map(self.from_letter.__getitem__, w)) for w, _ in cut]

    def _pieces(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > PIECE:
            cut = text.find(" ", at + PIECE)
            if cut < 0:
                break
            yield text[at:cut]
            at = cut
        yield text[at:]

    def _parts(self, text: str) -> Iterator[tuple[bytes | list[str] | tuple[str, ...], int]]:
        """Ids of special tokens, lists of chunks, or words of other texts, and their length."""
        at = 0
        for match in self.specials.finditer(text) if self.specials else ():
            yield from self._plain_parts(text[at : match.start()])
            yield self.vocabulary.special[match[0]].to_bytes(4, "little"), 0
            at = match.end()
        yield from self._plain_parts(text[at:] if at else text)

    def _plain_parts(self, text: str) -> Iterator[tuple[list[str] | tuple[str, ...], int]]:
        for piece in self._pieces(text):
            yield piece.split() if self.plain.fullmatch(piece) else tuple(self._other_words(piece)), len(piece)

    def encode_all(self, texts: Sequence[str | None]) -> list[bytes]:
        """Packed ids of every text; about :data:`GROUP` characters at a time."""
        out, group, size = [[] for _ in texts], [], 0
        for i, text in enumerate(texts):
            for part, length in self._parts(text or ""):
                group.append((out[i], part))
                size += length
                if size >= GROUP:
                    self._encode_group(group)
                    group, size = [], 0
        self._encode_group(group)
        return [b"".join(x) for x in out]

    def _encode_group(self, group: list[tuple[list[bytes], bytes | list[str] | tuple[str, ...]]]) -> None:
        if len(self.known) + len(self.known_words) > TRIE_STATES:
            self.reset()
        known, known_words = self.known, self.known_words
        chunks = list(set().union(*(p for _, p in group if type(p) is list)).difference(known))
        cut = self._words(chunks) if chunks else []
        words = set(chain.from_iterable(x for x in cut if type(x) is list)).union((x for x in cut if type(x) is str), *(p for _, p in group if type(p) is tuple)).difference(known_words)
        known_words.update(self.trie.encode(sorted(words)))
        for chunk, own in zip(chunks, cut):
            known[chunk] = known_words[own] if type(own) is str else b"".join(map(known_words.__getitem__, own))
        for out, part in group:
            out.append(part if type(part) is bytes else b"".join(map((known if type(part) is list else known_words).__getitem__, part)))
        for names, kept in ((chunks, known), (words, known_words)):
            for long in [x for x in names if len(x) > TRIE_BYTES]:
                del kept[long]

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], "<u4").tolist()

    def decode(self, ids) -> str:
        """The tokens' strings with a space between them, which is what the library
        does for a file without a decoder. Unknown ids are left out."""
        ids = np.asarray(ids, np.int64)
        found = self.strings[ids[ids < len(self.strings)]].tolist()
        try:
            return " ".join(found)
        except TypeError:
            return " ".join(x for x in found if x is not None)


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One for each worker process and vocabulary."""
    text = shared.value
    key = hash(text)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(text)
    return _ENCODERS[key]


def load(spark: SparkSession, path: str):
    """The vocabulary file, sent to the executors: a file of fixed size (under 2 MB)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


class _Batches:
    """Encodes batches of texts; vocabulary and what words are encoded to go with the task."""

    def __init__(self, shared, with_text: bool):
        self.encoder, self.with_text = _encoder(shared), with_text

    def __call__(self, texts: list[str | None]) -> list:
        packed = self.encoder.encode_all(texts)
        decoded = [[self.encoder.decode(np.frombuffer(x, "<u4")) for x in packed]] if self.with_text else []
        return [[len(x) // 4 for x in packed], packed, *decoded]

    def close(self) -> None:
        # the worker lives on and may run stages of other operators
        self.encoder = None
        _ENCODERS.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def encode(docs: DataFrame, vocabulary, text: str = "text", decoded: bool = False, drop: Sequence[str] = ()) -> DataFrame:
    """Add ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit numbers), and with
    ``decoded`` also ``decoded``, what :func:`decode` makes of them.

    Columns in ``drop`` are read but not returned. Every text, of any length, is encoded
    whole; null counts as empty and gives no token. Columns with the new names are
    replaced, all others pass through. Nothing is shuffled, equal rows give equal
    rows, and an empty table gives one.
    """
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    if decoded:
        fields.append(T.StructField("decoded", T.StringType()))
    return with_python(docs, [text], fields, partial(_Batches, vocabulary, decoded), drop)


def _decode_batch(shared):
    encoder = _encoder(shared)
    return lambda packed: [[encoder.decode(np.frombuffer(x, "<u4")) if x is not None else None for x in packed]]


def decode(tokens: DataFrame, vocabulary, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of ``ids``; null stays null."""
    return with_python(tokens, [ids], [T.StructField("decoded", T.StringType())], partial(_decode_batch, vocabulary))
