import pytest
from pyspark.sql import Row

LETTERS = "abcdefghij"


@pytest.fixture
def frame(spark):
    """A frame from rows of values and a schema; an empty one without rows."""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


@pytest.fixture
def docs(frame):
    """Documents with columns whose names the operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, digest string, kept string, fp long, score string, row int, words string, line string"

    def make(*rows):
        filled = []
        for row in rows:
            doc_id, text, lang = (*row, None)[:3]
            filled.append((doc_id, text, lang, None, None, "x", "y", 1, "z", 2, "w", "l"))
        return frame(schema, *filled)

    return make


def words(seed, count):
    """Words that depend on the seed alone."""
    state, found = seed * 7919 + 17, []
    for _ in range(count):
        state = (state * 1103515245 + 12345) % 2**31
        found.append("".join(LETTERS[(state >> k) % 10] for k in (3, 7, 11, 15, 19)))
    return found


def by_id(df, column="doc_id"):
    return {row[column]: row for row in df.collect()}


__all__ = ["Row", "by_id", "words"]
