import random

import pytest
from pyspark.sql import types as T

from loglark.llm.common import prepare

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("source", T.StringType()), T.StructField("size", T.StringType()), T.StructField("row", T.StringType())])


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text, lang, source); ``size`` and ``row`` are extra columns with clashing names."""
    prepare(spark)

    def docs(rows):
        full = [(*r, *(None,) * (4 - len(r)), "x", "y") for r in rows]
        return spark.createDataFrame(full, DOC).repartition(3)
    return docs


@pytest.fixture(scope="session")
def prose():
    """Seeded texts of invented words."""
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4))) for _ in range(900)]
    return lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))


ODD = [(None, "null id"), (900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "twice here"), (904, "twice here")]
