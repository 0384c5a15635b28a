import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # columns named like the operators' own
    T.StructField("size", T.StringType()), T.StructField("token", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("class", T.StringType()), T.StructField("range", T.IntegerType()), T.StructField("score", T.DoubleType())])


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def corpus():
    """Exact and near copies, a shared passage, nulls, empty and very long texts, repeated rows."""
    rng = random.Random(5)
    texts = [words(rng, rng.randint(1, 120)) for _ in range(30)]
    base, passage = words(rng, 90), words(rng, 60)
    near = [" ".join("x" if i == k else w for i, w in enumerate(base.split())) for k in (3, 40, 88)]
    texts += [base, base.upper(), *near, base, base]
    texts += [f"{words(rng, 20)} {passage} {words(rng, 15)}" for _ in range(4)]
    texts += [None, "", "  \n\t", "...", "one", "two words", "Ünïcode ñandú élan", "a" * 30000, words(rng, 20000), "12 34", "tab\tand\nline\r\nend"]
    rows = [(i * 3, t, ["en", "de", None][i % 3], ["s1", "s2", None, "s3"][i % 4], len(t or ""), "x", i, i, "c", 0, 0.5) for i, t in enumerate(texts)]
    rows += [rows[0], rows[-1]]
    rows.append((None, "no id here at all", "en", None, 3, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def corpus_rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, corpus_rows):
    return spark.createDataFrame(corpus_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
