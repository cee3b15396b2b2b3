"""Small tables for the tests: every awkward case that the operators define."""

from pyspark.sql import functions as F

LONG = "the river runs and the boats go by with their nets " * 4000
DOCS = [
    (1, "", "en", "a", 0),
    (2, None, None, None, None),
    (None, "a text without any id at all", "en", "a", 28),
    (3, LONG, "en", "b", len(LONG)),
    (4, "one text that comes again and again", "en", "a", 35),
    (4, "one text that comes again and again", "en", "a", 35),
    (5, "one text that comes again and again", "en", "", 35),
    (6, "one text that comes again and again", "fr", None, 35),
    (7, "12 34 | | ...", "de", "b", 13),
    (8, " \t\r\x0b\x0c", "de", "b", 5),
    (9, "Größe\nGröße\n\nkein Wort ÄÖÜ \U0001f600 x́", "de", "c", 30),
    (-10, "un mot\x1cet\xa0deux", "fr", "c", 15),
]
#: Names that the operators use for their results or inside.
CLASHES = ["_text", "_words", "_row", "_hash", "_code", "_bucket", "_doc", "block", "copy", "epoch", "SIZE", "Target", "n_words", "KEPT", "ids", "lang_pred", "n_lines", "spans", "_in0"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=None, clashes=True):
    docs = spark.createDataFrame(DOCS if rows is None else rows, SCHEMA).repartition(3)
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES}) if clashes else docs


def empty(spark):
    return documents(spark, [])


def multiset(rows):
    return sorted(map(repr, rows))
