import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row_id string, block int, word string"
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma "


@pytest.fixture(scope="session")
def odd_docs(spark, tmp_path_factory):
    """NULLs in every column, empty and long texts, repeated rows, clashing column names."""
    texts = [
        (1, "The cat sat on the mat and the dog barked at it all day long."),
        (2, "The cat sat on the mat and the dog barked at it all day long."),
        (3, None),
        (4, ""),
        (None, "only a text"),
        (5, " \t\n"),
        (6, LONG * 2000),
        (7, LONG * 2000 + "tail"),
        (8, "x" * 20_000),
        (9, "one two"),
        (9, "one two"),
        (None, None),
        (10, "Été 12 ¡señor! <|endoftext|> don't   स्त \U0001f600 中文  ."),
        (11, "THE CAT SAT on the mat and the dog barked at it all day long."),
    ]
    rows = [(i, t, None if k % 3 else "en", None, None, "r", 1, "w") for k, (i, t) in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("odd") / "docs")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("doc_id = -5")
