import pytest

LONG = "lorem ipsum dolor sit amet consectetur adipiscing elit " * 4000
# doc_id, text, lang, and columns whose names the operators use inside
AWKWARD = [
    (0, None, "en", 7, "x"), (1, "", "en", 7, None), (2, "   \n\t ", None, None, "x"), (3, "one", "en", 7, "x"),
    (4, "one two", "fr", 7, "x"), (5, "The Cat sat on the mat, é日本 😀 and THE cat ran off again today.", "en", 7, "x"),
    (6, "The Cat sat on the mat, é日本 😀 and THE cat ran off again today.", "en", 7, "x"),
    (6, "The Cat sat on the mat, é日本 😀 and THE cat ran off again today.", "en", 7, "x"),
    (7, LONG, "la", 7, "x"), (8, LONG + "tail", "la", 7, "x"), (None, "no id here but some words", None, 7, "x"),
    (None, None, None, None, None), (9, "12345 !!! ...", "en", 7, "x"), (10, "a" * 5000, "en", 7, "x"),
    (11, "▁ <s> </s> <|endoftext|>\x00 end  \n", "en", 7, "x"),
]
SCHEMA = "doc_id bigint, text string, lang string, id int, _text string"


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
