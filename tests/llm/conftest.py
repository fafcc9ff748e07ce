import re

import pytest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture
def docs(spark):
    """``doc_id, text`` and whatever columns are named, all strings."""

    def make(rows, *extra):
        schema = "doc_id bigint, text string" + "".join(f", {c} string" for c in extra)
        return spark.createDataFrame([(*r, *["x"] * (2 + len(extra) - len(r))) for r in rows], schema)

    return make


@pytest.fixture
def rows():
    def collect(df, *columns):
        got = [tuple(r[c] for c in columns or df.columns) for r in df.collect()]
        return sorted(got, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))

    return collect


@pytest.fixture(scope="session")
def words():
    return lambda text: WORDS.findall(text or "")
