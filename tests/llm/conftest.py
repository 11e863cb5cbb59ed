"""A small documents table with the awkward cases of every operator."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, key string"


def rows():
    prose = "The house of the old man and the sea is a tale that was told by many of the people in the town with great care and love for it"
    texts = [
        None,
        "",
        " \t\n ",
        prose,
        prose,
        prose + " for ever",
        "der Mann und die Frau sind in dem Haus mit der Katze und das ist gut für sie " * 5,
        "la maison de la rue est dans le village et les enfants sont avec une amie pour la nuit " * 400,
        "x",
        "é" * 5000,
        "$$$ ### *** | | | spam!!! 12345 <|endoftext|> 's 're\x1c\x85  İ ﬁ é",
        "a b\r\nc\0d",
    ]
    return [(i, t, "en" if i % 3 else None, None if i == 5 else f"src{i % 2}", len(t or ""), True, 0.5, "k") for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest driver table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
