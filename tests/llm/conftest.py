import pytest

from tidemark.llm.common import ship_package

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Null and empty texts, ties, repeated rows and a null id, in every operator's table.
AWKWARD = [
    (1, None, "en", "s", 0),
    (2, "", "en", "s", 0),
    (3, "   \n\t ", None, None, None),
    (4, "one", "en", "s", 3),
    (5, "the cat sat on the mat and the dog lay on the rug by the fire", "en", "s", 9),
    (5, "the cat sat on the mat and the dog lay on the rug by the fire", "en", "s", 9),
    (6, "The CAT sat on the mat and the dog lay on the rug by the fire", "en", "s", 9),
    (None, "the cat sat on the mat and the dog lay on the rug by the fire", "de", "s", 9),
    (None, None, None, None, None),
    (7, "naïve Ünïcode — 😀 x́ 12 <|endoftext|> don't\x00\x01 ﬁ", "fr", "s", 9),
    (8, "long " * 60_000, "en", "s", 9),
    (9, "a\x1cb c d\x85e\vf\fg\rh İstanbul ΣΑΣ", "el", "s", 9),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with the awkward cases, and extra columns whose names operators use inside."""
    ship_package(spark)
    from pyspark.sql import functions as F

    df = spark.createDataFrame(AWKWARD, DOCS)
    for name in ("fp", "root", "component_id", "body_hash", "kept", "pos", "ids", "shard", "block", "perplexity", "word hash"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)
