import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use inside.
        T.StructField("hash", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("rank", T.StringType()),
        T.StructField("times", T.StringType()),
        T.StructField("kept", T.StringType()),
    ]
)
NOUNS = "river stone cloud garden window letter market bridge forest candle mirror engine".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(NOUNS) + rng.choice(["", "s", "ly", "ing"]) for _ in range(n))


def messy_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, a hot group and a hot source."""
    rng = random.Random(3)
    long = prose(rng, 30_000)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(60)]
    passage = prose(rng, 60)
    rows = [(i, t, "en", f"s{i % 5}") for i, t in enumerate(texts)]
    rows += [(100 + i, texts[0], "en", "hot") for i in range(80)]  # a third of all rows
    rows += [(200 + i, f"{texts[i]} {passage} {texts[i + 1]}", "de", None) for i in range(10)]
    rows += [(220, texts[3].replace(" ", " \t\n"), "en", "s1"), (221, texts[3] + " ", "en", "s1")]
    rows += [(230, long, "en", "s2"), (231, long + " end", "en", "s2"), (232, "x" * 50_000, None, "s2")]
    rows += [(240, "", "en", "s1"), (241, None, "fr", "s1"), (242, " \n ", "en", None), (243, " ", "en", "")]
    rows += [(None, texts[5], "en", "s3"), (None, None, None, None), (None, "alone " + passage, "en", "s3")]
    rows += [(300, "same row", "en", "s4"), (300, "same row", "en", "s4"), (300, "other text", "en", "s4")]
    rows += [(301, "Ünïcode 文字 <|endoftext|> 🙂 text", "zh", "é"), (302, "a", "en", "z"), (-7, texts[6], "en", "s1")]
    return [(*r, len(r[1] or ""), "h", "sz", "rk", "tm", "kp") for r in rows]


def write(spark, folder, name, rows, schema):
    path = str(folder / f"{name}.parquet")
    spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def messy(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("messy"), "documents", messy_rows(), DOCS)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), "documents", [], DOCS)
