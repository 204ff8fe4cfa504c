from pathlib import Path

import pytest

SMALL = "/root/testdata/sf0.001"
#: Names that operators use within; a table may have them too.
CLASHING = (
    "row", "text_hash", "digest", "keep", "copies", "run", "fingerprint", "anchor", "words", "bucket", "domain", "id", "hash",
    "name", "document", "rank", "start", "email", "spans", "window", "items", "n_tokens", "high",
)
LONG = "lorem ipsum dolor " * 20_000


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text), with every clashing column."""

    def make(rows):
        extra = ", ".join(f"`{n}` string" for n in CLASHING)
        return spark.createDataFrame(
            [(i, t, "en" if t else None, "s", len(t or ""), *(["x"] * len(CLASHING))) for i, t in rows],
            f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}",
        )

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    return [
        (1, "The same text."), (2, "the SAME text."), (2, "the SAME text."), (3, None), (4, ""), (None, "no name"), (None, None),
        (5, LONG), (6, "12 34 !!"), (7, "Été İ 한국어"), (7, "another text with the same number"),
    ]


@pytest.fixture(scope="session")
def odd_docs(make_docs, odd_rows):
    return make_docs(odd_rows)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])


def rows(frame):
    return [r.asDict(recursive=True) for r in frame.collect()]


def by_id(frame):
    return {r["doc_id"]: r for r in rows(frame)}


assert Path(SMALL).exists()
