"""Word count (A12): split on whitespace, count each token, whole texts.

Tokens are counted with a partial aggregate before the shuffle, so a word that
makes up a large share of all tokens is reduced map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLIT_PATTERN = "[ \\t\\n\\r]+"


def word_count(df: DataFrame, text_col: str = "text") -> DataFrame:
    words = df.select(F.explode(F.split(F.col(text_col), SPLIT_PATTERN, -1)).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
