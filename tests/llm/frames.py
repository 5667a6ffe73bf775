"""Small document tables with the cases that operators must survive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, gone bigint, `gone_id` string, row string, member int"
LONG = " ".join(f"word{k % 977}" for k in range(40_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly brew a jug of very strong tea"


def texts() -> list[tuple[int | None, str | None]]:
    return [
        (1, PROSE),
        (2, PROSE),
        (2, PROSE),
        (3, PROSE.upper()),
        (4, f"{PROSE}\n{PROSE}\nshort line"),
        (5, None),
        (6, ""),
        (7, " \t\n "),
        (8, LONG),
        (9, LONG + " tail"),
        (None, PROSE),
        (None, None),
        (10, "mail me at ann.lee@example.org or call +44 (20) 7946-0958, host 10.0.0.300 or 10.0.0.30"),
        (11, "card 4111 1111 1111 1111 iban GB82 WEST 1234 5698 7654 32"),
        (12, "naïve café – 東京 🙂 \u0085   ß ǅ \x00 end"),
        (13, "user 17 logged in from the main office at noon today\nuser 23 logged in from the main office at noon today"),
        (14, "user 99 logged in from the main office at noon today"),
        (15, "ÀÉÎ " * 300),
        (2**62, "x"),
        (-5, "one two"),
    ]


def documents(spark: SparkSession, rows: list[tuple[int | None, str | None]] | None = None) -> DataFrame:
    """Documents with extra columns whose names clash with those that operators add."""
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 7, "g", "r", 1) for i, t in rows], DOCS)


def nothing(df: DataFrame) -> DataFrame:
    return df.limit(0)
