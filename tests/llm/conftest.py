import pytest

ROWS = [(1, None), (2, ""), (3, " \t\n"), (4, "One two three four five six seven eight nine ten a@b.example +1 (988) 555-2485"),
        (5, "one  TWO three four five six seven eight nine ten a@b.example +1 (988) 555-2485"), (6, "short"), (7, "short"),
        (7, "short"), (None, "no key here at all"), (8, "der die und nicht 4111 1111 1111 1111 10.0.0.1 é😀 x"),
        (9, "word " * 40_000 + "x" * 30_000), (10, "!!! 123"), (4, "the same key with other words in it")]


def frame(spark, rows):
    """Rows as documents with extra columns whose names the operators use inside."""
    wide = [(k, t, "en" if i % 2 else "de", None, 7, "x", i) for i, (k, t) in enumerate(rows)]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars long, key string, cid int")


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ROWS)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])
