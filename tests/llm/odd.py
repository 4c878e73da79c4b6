"""Rows that no operator may stumble over."""

LONG = "word and more " * 30_000
TEXTS = [None, "", "   ", "one", "Tie tie tie tie", "Tie tie tie tie", "é日本 \U0001f600 x▁y", LONG, "a b c d e f g h i j k l"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, row int, part int"


def odd_rows(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing columns."""
    rows = [(i, t, "en", f"s{i % 3}" if i else None, 1, "x", 7, 7) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[3], (None,) * 8, (None, "one", None, None, None, None, None, None)], SCHEMA)


def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)
