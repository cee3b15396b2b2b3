"""Personal data by weak supervision, in column expressions only.

Base finders take e-mail and IP addresses, payment cards and phone numbers by fixed
patterns. Further candidates (written-out addresses, national phone numbers, social
security numbers, bank accounts, credentials) are judged: labelers that look at the
shape, at gazetteers and at the words before vote for, against or not at all;
expectation-maximisation over the counts of vote patterns estimates how reliable each
labeler is; its posteriors train a logistic span classifier, which decides. Candidates are
taken widely: bare digits in the form of a number or an address in plain words are
candidates too, and it takes an announcing word to keep them. The classifier sees the
votes and traits of the span that no labeler uses.

The tables of vote patterns have a fixed number of possible rows, so only they come
to the driver, whatever the data. All else runs in Spark expressions.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.llm.common import boxed, unboxed

#: What the base finders look for, in the order of kinds. Possessive
#: quantifiers and starts bound to where a run begins (or the last match ended) change
#: no match, but keep the time linear and the stack flat on very long runs.
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a finder to be tried.
_SIGN = {"email": "@", "phone": "+"}
#: Patterns of further candidates.
CANDIDATES = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}(?:\x20?[\[(]at[\])]\x20?|\x20at\x20)[A-Za-z0-9-]{{1,63}}(?:(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20)[A-Za-z0-9-]{{1,63}}){{1,8}}",
    "phone": r"(?<![0-9+(.-])(?:\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}|[0-9]{10})(?![0-9])",
    "ssn": r"(?<![0-9-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{3}\x20[0-9]{2}\x20[0-9]{4})(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?i)(?<![A-Za-z0-9])(?:password|passwd|pwd|token|secret|api[_-]?key)\x20?[=:]\x20?[\"']?[A-Za-z0-9/+_.-]{8,200}",
}
KINDS = [*BASE, *[k for k in CANDIDATES if k not in BASE]]
#: Gazetteers and words that announce a kind.
DOMAINS = "com|org|net|edu|gov|info|io|eu|uk|us|de|fr|es|it|nl|ch|at|be|ca|au"
COUNTRIES = "AD|AE|AT|BE|BG|CH|CY|CZ|DE|DK|EE|ES|FI|FR|GB|GR|HR|HU|IE|IT|LT|LU|LV|MT|NL|NO|PL|PT|RO|SE|SI|SK|TR"
CUES = {
    "email": "mail|contact|write|kontakt|courriel|correo",
    "phone": "phone|tel|call|fax|mobile|handy|appel|llam",
    "ssn": "ssn|social|security|sozial",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "secret": "login|user|credential|key|auth",
}
LABELERS = ["shape", "gazetteer", "context", "neighbour", "variety"]
#: Candidates without the marks of their kind: plain words, bare digits, blanks for dashes.
LOOSE = {"email": r"\x20(?:at|dot)\x20", "phone": "^[0-9]{10}$", "ssn": r"\x20"}
#: Traits of a span, with the number of values of each: length, lack of the marks of its
#: kind, share of digits, word before.
WORDS = 8
TRAITS = {"wide": 2, "loose": 2, "digits": 3, "word": WORDS}
#: Code points before a span that count as its context, sums computed at a time,
#: rounds of the two estimates, and the probability from which a span is kept.
CONTEXT, RUN, EM_ROUNDS, FIT_ROUNDS, KEEP = 40, 256, 50, 400, 0.5
#: Candidates of a kind have ten code points or more and do not touch, so a context reaches over
#: four at most; where those of ten touch others, the gaps between make up for it.
REACH = 4


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


# ---- finding ----------------------------------------------------------------


def running(lengths: Column) -> Column:
    """Sums of all earlier elements: first over runs, then within a run."""
    total = lambda some: F.aggregate(some, F.lit(0), lambda a, x: a + x)
    runs = F.transform(F.sequence(F.lit(0), F.expr("0") + F.floor((F.size(lengths) - 1) / RUN).cast("int")), lambda r: total(F.slice(lengths, r * RUN + 1, RUN)))

    def place(runs: Column) -> Column:
        starts = F.transform(runs, lambda x, r: total(F.slice(runs, F.lit(1), r)))
        return let(starts, lambda s: F.transform(lengths, lambda x, i: F.get(s, F.floor(i / RUN).cast("int")) + total(F.slice(lengths, F.floor(i / RUN).cast("int") * RUN + 1, i % RUN))))

    return let(runs, place)


def _last(value: Column) -> Column:
    return F.substring(value, -CONTEXT, CONTEXT)


def matches(text: Column, pattern: str, context: bool = False) -> Column:
    """(``start``, ``end``, ``value``) of all matches from left to right, in code points,
    with ``before``, the :data:`CONTEXT` code points in front, where it is asked for.

    What lies between matches has known lengths, and so have they: places are sums. The
    context is put together from the ends of the last gaps and matches, as cutting it out of
    the text would count from its start for each match.
    """
    none = F.array().cast("array<struct<start:int,end:int,value:string" + (",before:string>>" if context else ">>"))

    def placed(found: Column) -> Column:
        steps = lambda gaps: F.transform(found, lambda v, i: F.get(gaps, i) + F.length(v))

        def in_front(texts: Column) -> Column:
            ends = F.transform(found, lambda v, i: _last(F.concat(_last(F.get(texts, i)), v)))

            def one(ends: Column) -> Column:
                near = lambda i: F.slice(ends, F.greatest(i - REACH + 1, F.lit(1)), F.least(i, F.lit(REACH)))
                return F.transform(found, lambda v, i: _last(F.concat(F.array_join(near(i), ""), _last(F.get(texts, i)))))

            return let(ends, one)

        def spans(texts: Column) -> Column:
            gaps = F.transform(texts, lambda g: F.length(g))

            def one(gaps: Column, starts: Column, before: Column | None) -> Column:
                return F.transform(
                    found,
                    lambda v, i: F.struct(
                        (F.get(starts, i) + F.get(gaps, i)).alias("start"),
                        (F.get(starts, i) + F.get(gaps, i) + F.length(v)).alias("end"),
                        v.alias("value"),
                        *([] if before is None else [F.get(before, i).alias("before")]),
                    ),
                )

            def at(before: Column | None) -> Column:
                return let(gaps, lambda g: let(let(steps(g), running), lambda starts: one(g, starts, before)))

            return let(in_front(texts), at) if context else at(None)

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), spans)).otherwise(none)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a string of digits holds."""

    def doubled(i: Column) -> Column:
        d = F.substring(number, F.length(number) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    places = F.transform(F.sequence(F.lit(1), F.length(number)), doubled)
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10 == 0


def base_holds(kind: str, value: Column) -> Column:
    """Whether a match of the base pattern counts."""
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return let(digits(value), lambda n: F.when(F.length(n).between(13, 19), luhn(n)).otherwise(False))
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """``kind`` (place in :data:`KINDS`), ``start``, ``end`` of what the base finders take."""
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")

    def of(kind: str, pattern: str) -> Column:
        sign = F.contains(text, F.lit(_SIGN[kind])) if kind in _SIGN else text.rlike("[0-9]")
        held = F.filter(matches(text, pattern), lambda m: base_holds(kind, m["value"]))
        number = F.lit(KINDS.index(kind))
        return F.when(sign, F.transform(held, lambda m: F.struct(number.alias("kind"), m["start"].alias("start"), m["end"].alias("end")))).otherwise(none)

    return F.concat(*[of(kind, pattern) for kind, pattern in BASE.items()])


# ---- labelers ---------------------------------------------------------------


def _vote(good: Column, bad: Column | None = None) -> Column:
    vote = F.when(good, 1)
    return (vote if bad is None else vote.when(bad, -1)).otherwise(0)


def _iban_holds(value: Column) -> Column:
    plain = F.regexp_replace(value, " ", "")

    def rest(moved: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            code = F.ascii(F.substring(moved, i, F.lit(1)))
            return F.when(code >= 65, (a * 100 + code - 55) % 97).otherwise((a * 10 + code - 48) % 97)

        return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1

    return let(let(plain, lambda p: F.concat(F.substring(p, F.lit(5), F.length(p)), F.substring(p, 1, 4))), rest)


def _loose(kind: str, value: Column) -> Column:
    return value.rlike(LOOSE[kind]) if kind in LOOSE else F.lit(False)


def votes(kind: str, value: Column, before: Column) -> list[Column]:
    """One vote (1, -1 or 0) of each labeler on a candidate. On a loose one shape and
    gazetteer, which judge little more than its digits, do not vote, and context does
    either way."""
    number = digits(value)
    loose = _loose(kind, value)
    strict = lambda vote: F.when(loose, 0).otherwise(vote)
    shape = {
        "email": lambda: _vote(value.rlike(r"[A-Za-z]{2,24}$"), ~value.rlike(r"[A-Za-z]{2,24}$")),
        "phone": lambda: _vote(number.rlike("^[2-9][0-9]{2}[2-9]"), ~number.rlike("^[2-9][0-9]{2}[2-9]")),
        "ssn": lambda: _vote(number.rlike("^(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)"), number.rlike("^(?:000|666|9)|^[0-9]{3}00|0000$")),
        "iban": lambda: _vote(_iban_holds(value), ~_iban_holds(value)),
        "secret": lambda: _vote(value.rlike(r"[=:][^=:]*[0-9][^=:]*$"), ~value.rlike(r"[=:][^=:]*[0-9][^=:]*$")),
    }[kind]()
    gazetteer = {
        "email": lambda: _vote(value.rlike(rf"(?i)(?:{DOMAINS})$")),
        "phone": lambda: _vote(~number.rlike("^[0-9]11"), number.rlike("^[0-9]11")),
        "ssn": lambda: F.lit(0),
        "iban": lambda: _vote(value.rlike(f"^(?:{COUNTRIES})"), ~value.rlike(f"^(?:{COUNTRIES})")),
        "secret": lambda: _vote(value.rlike("(?i)^(?:password|passwd|token|secret)")),
    }[kind]()
    cue = before.rlike(f"(?i)(?:{CUES[kind]})")
    context = _vote(cue, loose)
    neighbour = _vote(F.lit(False), before.rlike(r"[$€£#§№=/]\s?$"))
    changing = number if kind in ("phone", "ssn", "iban") else F.regexp_replace(value, r"^.*[=:]", "")
    kinds_of = F.size(F.array_distinct(F.split(changing, "")))
    variety = _vote(F.lit(False), kinds_of < 3)
    return [strict(shape), strict(gazetteer), context, neighbour, variety]


def traits(kind: str, value: Column, before: Column) -> list[Column]:
    """The value of each of :data:`TRAITS`: longer than 20; loose; under a third, under two
    thirds or more of it digits; a hash of the last word before, 0 if there is none."""
    length = F.length(value)
    share = F.least(F.floor(F.lit(3) * F.length(digits(value)) / length), F.lit(2))
    word = F.lower(F.regexp_extract(before, r"([A-Za-z]+)[^A-Za-z]*$", 1))
    hashed = F.when(word == "", 0).otherwise(1 + F.pmod(F.xxhash64(word), F.lit(WORDS - 1)))
    return [length > 20, _loose(kind, value), share, hashed]


def _overlaps(spans: Column, m: Column) -> Column:
    """Whether one of the spans, which ascend and don't overlap each other, overlaps ``m``. Jumps
    of halving length count those that end before it; only the next one can reach it."""
    jumps = F.filter(F.array(*[F.lit(1 << i) for i in reversed(range(29))]), lambda j: j <= F.size(spans))
    ends_before = lambda n: F.coalesce(F.get(spans, n - 1)["end"] <= m["start"], F.lit(False))
    passed = F.aggregate(jumps, F.lit(0), lambda n, j: F.when(ends_before(n + j), n + j).otherwise(n))
    return F.coalesce(F.get(spans, passed)["start"] < m["end"], F.lit(False))


def candidates(text: Column, base: Column) -> Column:
    """``kind``, ``start``, ``end``, ``traits`` and ``votes`` of the
    candidates that no base span overlaps. Candidates of different kinds may overlap
    each other. The time grows with the text and the logarithm of its base spans."""
    none = F.array().cast("array<struct<kind:int,start:int,end:int,traits:array<int>,votes:array<int>>>")

    def of(kind: str, pattern: str, by_kind: Column) -> Column:
        def judged(m: Column) -> Column:
            cast = F.array(*[v.cast("int") for v in votes(kind, m["value"], m["before"])])
            own = F.array(*[x.cast("int") for x in traits(kind, m["value"], m["before"])])
            return F.struct(F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), own.alias("traits"), cast.alias("votes"))

        free = F.filter(matches(text, pattern, context=True), lambda m: ~F.exists(by_kind, lambda spans: _overlaps(spans, m)))
        return F.when(text.rlike(pattern), F.transform(free, judged)).otherwise(none)

    by_kind = F.transform(F.array(*[F.lit(k) for k in range(len(BASE))]), lambda k: F.filter(base, lambda b: b["kind"] == k))
    return let(by_kind, lambda kinds: F.concat(*[of(kind, pattern, kinds) for kind, pattern in CANDIDATES.items()]))


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_doc`` (all columns but the text), ``_base`` and ``_candidates``: small rows, to be
    stored. A null text is an empty one; neither has a span. Each row is read alone, so repeated
    rows have equal spans; an empty table gives an empty one. Long texts are read whole."""
    own = F.coalesce(F.col(text), F.lit(""))
    read = docs.select(boxed(docs.drop(text)).alias("_doc"), own.alias("_own"))
    based = read.withColumn("_base", base_spans(F.col("_own")))
    return based.withColumn("_candidates", candidates(F.col("_own"), F.col("_base"))).drop("_own")


# ---- reliabilities and classifier -------------------------------------------


#: Votes, traits and how many candidates have them.
Pattern = tuple[tuple[int, ...], tuple[int, ...], int]


@dataclass
class Model:
    """``weights[kind]``: the intercept, then for each labeler the weight of the votes
    -1, 0, 1, then for each trait that of each value. ``reliability[kind][labeler]``:
    estimated share of right votes among those cast."""

    weights: dict[int, list[float]]
    reliability: dict[int, list[float]]


def _estimate(rows: list[Pattern]) -> tuple[dict[tuple[int, ...], float], list[float]]:
    """Expectation-maximisation over the counts of votes: posteriors by vote pattern
    and reliabilities, the share of a labeler's votes that are right; one that does not vote
    says nothing. No labeler is taken to err more often than not and both classes are as
    likely beforehand, so that they neither change names nor run dry. Starts from the sign of the summed votes."""
    patterns: dict[tuple[int, ...], float] = {}
    for cast, _, n in rows:
        patterns[cast] = patterns.get(cast, 0) + n
    post = {p: 0.9 if sum(p) > 0 else 0.1 if sum(p) < 0 else 0.5 for p in patterns}
    right: list[float] = []
    for _ in range(EM_ROUNDS):
        right = []
        for j in range(len(next(iter(patterns)))):
            good = sum(n * (post[p] if p[j] > 0 else 1 - post[p]) for p, n in patterns.items() if p[j])
            cast = sum(n for p, n in patterns.items() if p[j])
            # as if it had voted an eighth more often, three times in four rightly
            right.append(max((good + 0.75 * (cast / 8 + 1)) / (cast + cast / 8 + 1), 0.5))
        for p in patterns:
            odds = sum(v * math.log(r / (1 - r)) for v, r in zip(p, right))
            post[p] = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
    return post, right


#: Place of the first weight of each trait; the last one is the number of weights.
_FIRST = list(itertools.accumulate([1 + 3 * len(LABELERS), *TRAITS.values()]))


def _features(cast: tuple[int, ...], own: tuple[int, ...]) -> list[int]:
    """Places of a candidate's features in the list of weights."""
    return [0, *[1 + 3 * j + v + 1 for j, v in enumerate(cast)], *[first + v for first, v in zip(_FIRST, own)]]


def _train(rows: list[Pattern], post: dict[tuple[int, ...], float]) -> list[float]:
    """Logistic weights for the posteriors as soft targets, by gradient descent."""
    weights, total = [0.0] * _FIRST[-1], sum(n for *_, n in rows)
    each = [(_features(cast, own), post[cast], n / total) for cast, own, n in rows]
    for _ in range(FIT_ROUNDS):
        slope = [1e-4 * w for w in weights]
        for at, target, share in each:
            guess = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[i] for i in at)))))
            for i in at:
                slope[i] += share * (guess - target)
        # ten features at most: a longer step would swing
        weights = [w - s / 2 for w, s in zip(weights, slope)]
    return weights


def fit(found: DataFrame) -> Model:
    """Estimate from all candidates of a table made by :func:`find`. Patterns of votes and
    traits are counted in Spark; a kind has at most 243 x 96 of them."""
    each = found.select(F.explode("_candidates").alias("c")).select("c.*")
    rows = each.groupBy("kind", "votes", "traits").agg(F.count("*").alias("n")).orderBy("kind", "votes", "traits").collect()
    by_kind: dict[int, list] = {}
    for r in rows:
        by_kind.setdefault(r["kind"], []).append((tuple(r["votes"]), tuple(r["traits"]), r["n"]))
    model = Model({}, {})
    for kind, seen in by_kind.items():
        post, model.reliability[kind] = _estimate(seen)
        model.weights[kind] = _train(seen, post)
    return model


def probability(model: Model, kind: Column, cast: Column, own: Column) -> Column:
    """The classifier as an expression; a kind that was not seen has probability 0."""
    out = None
    for number, weights in model.weights.items():
        weigh = lambda some, at: F.element_at(F.array(*[F.lit(w) for w in some]), at)
        score = F.lit(weights[0])
        for j in range(len(LABELERS)):
            score = score + weigh(weights[1 + 3 * j : 4 + 3 * j], F.get(cast, F.lit(j)) + 2)
        for j, (first, until) in enumerate(itertools.pairwise(_FIRST)):
            score = score + weigh(weights[first:until], F.get(own, F.lit(j)) + 1)
        out = F.when(kind == number, score) if out is None else out.when(kind == number, score)
    return F.lit(0.0) if out is None else F.coalesce(1 / (1 + F.exp(-out)), F.lit(0.0))


def decide(found: DataFrame, model: Model) -> DataFrame:
    """The columns of the documents but the text, ``base`` and ``spans`` (``kind``, ``start``, ``end``; by kind, then start), the
    latter with the candidates that the classifier keeps."""
    kept = F.filter("_candidates", lambda c: probability(model, c["kind"], c["votes"], c["traits"]) >= KEEP)
    added = F.transform(kept, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    columns = found.schema["_doc"].dataType.names
    both = found.withColumns({"base": F.array_sort("_base"), "spans": F.array_sort(F.concat("_base", added))})
    return unboxed(both, columns, ["base", "spans"])


def names_of(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with ``<kind>`` in the place of each span; of overlapping ones the one
    that starts first."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(text, a["until"] + 1, s["start"] - a["until"])
        joined = F.struct(F.concat(a["out"], gap, F.lit("<"), F.get(kinds, s["kind"]), F.lit(">")).alias("out"), s["end"].alias("until"))
        return F.when(s["start"] >= a["until"], joined).otherwise(a)

    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("until"))
    return F.aggregate(ordered, begin, step, lambda a: F.concat(a["out"], F.substring(text, a["until"] + 1, F.length(text))))
