"""Documents with the cases that every operator must stand."""

from __future__ import annotations

LONG = "lorem ipsum dolor " * 20000
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog.", "en", "a", 44),
    (2, None, "en", "a", None),
    (3, "", None, "b", 0),
    (4, "   \n\t ", "fr", None, 6),
    (5, "The quick brown fox jumps over the lazy dog.", "en", "b", 44),
    (5, "The quick brown fox jumps over the lazy dog.", "en", "b", 44),
    (6, "Écoutez: l'été où naïve 漢字 🙂 <|endoftext|> 12345  two  spaces ", "fr", "c", 60),
    (7, LONG, "de", "a", len(LONG)),
    (None, "a row without an id", None, None, None),
    (8, "mail me at ann.lee@example.com or +1 (415) 555-0100, card 4111 1111 1111 1111, host 10.0.0.1", "en", "a", 90),
    (9, "1234 5678", "en", "c", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=None):
    return spark.createDataFrame(DOCS if rows is None else rows, SCHEMA)


def by_row(df, *columns):
    return sorted(df.select(*columns).collect(), key=lambda r: tuple((x is not None, x) for x in r))
