import pytest

#: Clashing extra columns, nulls, empty and long texts, ties and repeated rows.
EDGE = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (4, "one two three four five six seven", "en", "a"),
    (4, "one two three four five six seven", "en", "a"), (5, "One two THREE four five six seven", "fr", None),
    (6, "wörd " * 3000 + "end", "de", "b"), (7, "x" * 50_000, None, "b"), (8, "日本語 😀 a\x1cb\x85c　d É", "es", "c"),
    (None, "no id here at all but several words", "en", "c"), (9, "<|endoftext|> <|ENDOFTEXT|> it's O'NEIL's 'll", "en", "c"),
    (10, "#### $$$$ %%%% 1234 5678", "en", "c"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, kept string, score string, row_id string"


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", "y", "z", "w") for r in EDGE], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def write(df, folder):
    """The rows as the ``documents`` table of a folder, as the queries read it."""
    df.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def edge_dir(edge, tmp_path_factory):
    return write(edge, tmp_path_factory.mktemp("edge"))


@pytest.fixture(scope="session")
def empty_dir(empty, tmp_path_factory):
    return write(empty, tmp_path_factory.mktemp("empty"))


@pytest.fixture(scope="session")
def texts(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").collect()
    return {r.doc_id: r.text or "" for r in rows}
