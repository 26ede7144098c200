import random

import pytest

WORDS = ["alpha", "Beta", "gamma,", "delta", "éclair", "zeta", "ETA", "theta.", "iota", "kappa", "mu", "nu", "xi", "pi"]


@pytest.fixture
def make(spark):
    """A table with an extra column whose name clashes with those of results."""

    def table(rows, schema, extra=("score", "name", "rank")):
        df = spark.createDataFrame(rows, schema)
        from pyspark.sql import functions as F

        return df.select("*", *[F.lit("clash").alias(c) for c in extra if c not in df.columns])

    return table


@pytest.fixture
def prose():
    """A function that writes n random words."""
    rnd = random.Random(5)

    def text(n, sure=rnd):
        return " ".join(sure.choice(WORDS) + str(sure.randrange(400)) for _ in range(n))

    return text
