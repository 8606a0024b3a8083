import pytest

WORDS = "the house on a hill was old and no one had been there for years when we came by in spring to see what was left of its garden".split()


def prose(seed: int, n: int) -> str:
    import random

    rng = random.Random(seed)
    return " ".join("".join(rng.choice(("ta", "ri", "mo", "ne", "su", "lo", "ka", "vi")) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def text():
    return prose


#: Columns named as the operators' own, which must not disturb them.
CLASHES = ["rep", "bucket", "copy", "_gr_id", "_gr_n", "_gr_cdf", "key", "n", "digest", "elements", "quality", "toxic", "label", "ids", "tokens", "start", "end", "first", "media", "piece"]


@pytest.fixture(scope="session")
def odd_rows(text):
    """Nulls, empties, a very long text, ties and repeated rows."""
    long = text(1, 60_000)
    return [(None, text(2, 80), "en", "s1", 1), (1, None, "en", "s1", None), (2, "", None, "s1", 0), (3, long, "en", None, len(long)), (4, text(3, 70), "en", "s2", 5), (4, text(3, 70), "en", "s2", 5), (5, text(3, 70), "en", "s2", 5), (6, " \n\t ", "en", "s3", 4), (7, "\x00|▁é😀", "en", "s3", 5)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)]).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
