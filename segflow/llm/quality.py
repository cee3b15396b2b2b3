"""Quality rules: one table of thresholds, compiled into one projection.

Counts of a text (words, symbols, stop words, lines) are column expressions; ratios
are made of them; each rule bounds one ratio. No user function runs. The counts are
computed once in a first projection, ratios and verdicts in a second above it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.llm.common import SPACE, WORD, boxed, unboxed

#: The stop words looked for, most frequent ones of four languages.
STOP_WORDS = {
    "en": ["the", "be", "to", "of", "and", "that", "have", "with"],
    "fr": ["le", "la", "de", "des", "et", "un", "les", "que"],
    "de": ["der", "die", "und", "das", "den", "von", "mit", "zu"],
    "es": ["el", "los", "del", "y", "en", "por", "con", "una"],
}
#: Fixed value: characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A text passes when the ratio is within the bounds; a missing one is open."""

    ratio: str
    low: float | None = None
    high: float | None = None


#: The table of thresholds.
RULES = [
    Rule("words", low=50, high=100_000),
    Rule("word_length", low=2.0, high=15.0),
    Rule("symbol_ratio", high=0.1),
    Rule("stop_ratio", low=0.01),
    Rule("bullet_ratio", high=0.9),
    Rule("ellipsis_ratio", high=0.3),
    Rule("duplicate_line_ratio", high=0.5),
    Rule("letter_ratio", low=0.6),
]


def word_list(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three that occurs twice or more in the text.

    Windows are compared by a 64-bit hash. Most texts have no equal windows, which
    costs one pass; for the others the windows are sorted with their places, those
    with an equal neighbour kept, and the words they cover counted in order of place.
    """
    windows = F.size(words) - 2
    some = F.when(windows > 1, F.sequence(F.lit(0), windows - 1)).otherwise(F.array().cast("array<int>"))
    codes = F.transform(some, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    ordered = F.array_sort(F.transform(codes, lambda c, i: F.struct(c.alias("c"), i.alias("i"))))

    def covered(state: Column, place: Column) -> Column:
        # words of this window that the earlier ones do not cover
        new = F.least(F.lit(3), place + 3 - state["until"])
        return F.struct((state["n"] + new).alias("n"), (place + 3).alias("until"))

    def of(arranged: Column) -> Column:
        equal = F.filter(
            arranged,
            lambda x, k: (x["c"] == F.get(arranged, k - 1)["c"]) | (x["c"] == F.get(arranged, k + 1)["c"]),
        )
        places = F.array_sort(F.transform(equal, lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("until"))
        return F.aggregate(places, start, covered, lambda s: s["n"])

    # a list of one keeps what is computed once from being computed for each element
    found = F.element_at(F.transform(F.array(ordered), of), 1)
    distinct = F.size(F.array_distinct(codes)) < windows
    return F.when((windows > 1) & distinct, found).otherwise(0).cast("long")


def counts(text: Column, words: Column) -> dict[str, Column]:
    """The counts that ratios are made of, from a text that is not null and its words."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    stop = sorted({w for some in STOP_WORDS.values() for w in some})
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(text, SPACE, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated_words(words),
        "_stop": F.regexp_count(text, F.lit(rf"(?i)(?<!{WORD[:-1]})(?:{'|'.join(stop)})(?=[.,;:!?]*+(?:{SPACE[:-1]}|\z))")).cast("long"),
        "_letters": F.regexp_count(text, F.lit(rf"\p{{L}}{WORD[:-1]}*+")).cast("long"),
        "_lines": F.size(lines).cast("long"),
        "_bullets": F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•]"))).cast("long"),
        "_ellipses": F.size(F.filter(lines, lambda x: x.rlike(r"(?:\.\.\.|…)\s*$"))).cast("long"),
    }


def ratios() -> dict[str, Column]:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("_lines", F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbol_ratio": F.col("n_symbols") / words,
        "stop_ratio": F.col("_stop") / words,
        "letter_ratio": F.col("_letters") / words,
        "bullet_ratio": F.col("_bullets") / lines,
        "ellipsis_ratio": F.col("_ellipses") / lines,
        "duplicate_line_ratio": F.col("n_dup_lines") / lines,
    }


def verdict(rules: list[Rule]) -> Column:
    """Whether all rules hold."""
    of, good = ratios(), F.lit(True)
    for rule in rules:
        if rule.low is not None:
            good = good & (of[rule.ratio] >= rule.low)
        if rule.high is not None:
            good = good & (of[rule.ratio] <= rule.high)
    return good


def judge(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """Add ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed`` (fewer than 50 words, or more than half of them repeated) and
    ``kept`` (not failed, and all rules hold).

    Columns with these names are replaced, all others pass through. A null or empty
    text has no words and fails. Each row is judged alone: nothing is shuffled, and
    equal rows give equal results.
    """
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    own = F.coalesce(F.col(text), F.lit(""))
    read = docs.select(boxed(docs).alias("_doc"), own.alias("_text"), word_list(own).alias("_words"))
    counted = read.withColumns(counts(F.col("_text"), F.col("_words")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = counted.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(RULES if rules is None else rules))
    return unboxed(judged, docs.columns, new)
