import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from ``(doc_id, text)`` pairs or longer tuples, with an extra column."""
    def build(rows, extra="hashes"):
        full = [(*r, *[None] * (5 - len(r)), 7) for r in rows]
        return spark.createDataFrame(full, f"{COLUMNS}, {extra} int")
    return build


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
