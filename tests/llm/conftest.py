import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]

PROSE = ("the river of the north is long and the people who live by it know that every spring the water rises "
         "and with it the boats come back to the town where the market opens for a week of songs and trade ").split()
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "kept", "_body", "n_words"]
SCHEMA = T.StructType([T.StructField(c, T.LongType() if c in ("doc_id", "n_chars") else T.StringType()) for c in COLUMNS])


def prose(seed: int, words: int = 120) -> str:
    """Different words for each seed, in lines."""
    out = [f"{PROSE[(seed * 7 + i * (seed + 3)) % len(PROSE)]}{'' if i % 3 else seed * 31 + i}" for i in range(words)]
    return "\n".join(" ".join(out[i : i + 15]) for i in range(0, words, 15))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, short, very long, equal and near texts, a repeated row, ids out of order."""
    long = " ".join(prose(s, 400) for s in range(50, 90))
    rows = [(9, prose(1)), (3, prose(1)), (4, prose(1).replace("market", "fair")), (5, None), (6, ""), (7, " \n\t "), (8, "one two three"),
            (10, "one two three"), (11, long), (12, prose(2) + " " + prose(3)), (12, prose(2) + " " + prose(3)), (13, "be " * 200), (None, prose(4)), (None, None)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """`odd_rows` with nulls in the other columns and columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, None, None, None, "x", "y", "z") for i, t in odd_rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
