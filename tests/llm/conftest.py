import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

PROSE = "the cat sat on the mat and looked at the moon over the quiet river. " * 3


def _odd_texts():
    return [
        "",
        None,
        "   \n\t ",
        "one",
        "Short text of five words.",
        PROSE,
        PROSE,
        PROSE.upper(),
        PROSE + "A new end with some words that nobody else has written down before.",
        "A new start here. " + PROSE,
        "é漢字😀 " * 40,
        "line one\nline two\nline one\n\nline one\n" * 3,
        "a b c d e f g a b c d e f g",
        "### *** $$$ " * 30,
        "x" * 20_000,
        "word " * 30_000,
        "\u2581 \u2581\u2581 <s> </s>\n\n  end ",
    ]


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls, empty and very long texts, ties and copies."""
    texts = _odd_texts()
    rows = [
        (i, t, ["en", None, "de"][i % 3], [None, "s1", "s2", "s1"][i % 4], None if i % 5 == 0 else len(t or ""))
        for i, t in enumerate(texts)
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with columns that the operators use as names of their own."""
    names = ["fp", "key", "block", "bucket", "part", "start", "size", "digest", "number", "rank", "curve", "state", "words", "__text", "q"]
    out = odd
    for n in names:
        out = out.selectExpr("*", f"'x' as `{n}`")
    return out


def _sf(name):
    return f"/root/testdata/{name}"


@pytest.fixture(scope="session")
def sf_docs(spark):
    """All documents of the smallest scale factor, as a DataFrame and as rows."""
    df = spark.read.parquet(_sf("sf0.001") + "/documents.parquet")
    return df, [(r.doc_id, r.text) for r in df.collect()]
