"""Traffic counts over the cleaned access table.

Input rows are the deduplicated table (one row per row key with ``hits``), so
``visits`` counts distinct keys, as counting the stored table did in the
source system, and ``page_views`` sums the raw lines.  NULL group keys stay
groups (M17).  Orders always break ties completely.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def visits_by(table: DataFrame, *keys: str) -> DataFrame:
    """visits (stored rows) and page_views (raw lines) per key."""
    pv = F.sum("hits") if "hits" in table.columns else F.count(F.lit(1))
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("visits"), pv.cast("bigint").alias("page_views"))


def region_visits(table: DataFrame) -> DataFrame:
    """A1: visits by country, province."""
    return visits_by(table, "country", "province")


def city_visits(table: DataFrame) -> DataFrame:
    """Visits by country, province, city."""
    return visits_by(table, "country", "province", "city")


def top_k(counts: DataFrame, k: int, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """First ``k`` rows by ``order`` (A2, O6): per-partition top-k, then one
    merge of at most k rows per partition (TakeOrderedAndProject).  The rank
    is numbered over those k rows only."""
    top = counts.orderBy(*order).limit(k)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def region_top(table: DataFrame, k: int = 10) -> DataFrame:
    """A2: top k (country, province) by visits, ties by name."""
    order = [F.desc("visits"), F.asc_nulls_last("country"), F.asc_nulls_last("province")]
    return top_k(region_visits(table), k, order)


def browser_visits(table: DataFrame) -> DataFrame:
    """A3/A5: visits by browser name, highest first, ties by name (O1); ``rank``
    is the place in that order.  There is one row per browser name, so the
    window over all of them stays small."""
    order = [F.desc("visits"), F.asc_nulls_last("browsername")]
    ranked = visits_by(table, "browsername").withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    return ranked.orderBy("rank")


def browser_visits_sql(spark: SparkSession, table: DataFrame, view: str = "access_clean") -> DataFrame:
    """The same count written in SQL over a temp view."""
    table.createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT browsername, count(1) AS visits, CAST(sum(hits) AS BIGINT) AS page_views,
               CAST(row_number() OVER (ORDER BY count(1) DESC, browsername ASC NULLS LAST) AS BIGINT) AS rank
        FROM {view}
        GROUP BY browsername
        ORDER BY rank
    """)


def browser_stat(table: DataFrame) -> DataFrame:
    """The ``browser_stat(day, browser, cnt)`` rows for every day present."""
    browser = F.coalesce(F.col("browsername"), F.lit("Unknown")).alias("browser")
    return table.groupBy("day", browser).agg(F.count(F.lit(1)).cast("bigint").alias("cnt"))


def browser_version_visits(table: DataFrame) -> DataFrame:
    """Visits by browser name and version."""
    return visits_by(table, "browsername", "browserversion")


def agent_visits(table: DataFrame) -> DataFrame:
    """P5 check: visits by browser and OS name/version."""
    return visits_by(table, "browsername", "browserversion", "osname", "osversion")


def url_clicks(table: DataFrame) -> DataFrame:
    """Clicks by URL."""
    return visits_by(table, "url")


def query_keyword_counts(df: DataFrame, url_col: str, keys: Sequence[str]) -> DataFrame:
    """Counts of the values of query keys (``?page=2&ref=x``) per key.

    Every occurrence of a key counts, and values are decoded (``a+b`` and ``a%20b`` are one keyword;
    a value that cannot be decoded counts as it stands).  ``try_parse_url`` gives NULL for a malformed
    URL instead of failing; rows without the key are not counted.
    """
    pairs = F.split(F.try_parse_url(F.col(url_col), F.lit("QUERY")), "&")
    named = (df.select(F.explode(pairs).alias("_p")).where(F.instr("_p", "=") > 0)
               .select(F.substring_index("_p", "=", 1).alias("param"), F.expr("substring(_p, instr(_p, '=') + 1)").alias("raw"))
               .where(F.col("param").isin(*keys)))
    keyword = F.coalesce(F.try_url_decode("raw"), F.col("raw")).alias("keyword")
    return named.groupBy("param", keyword).agg(F.count(F.lit(1)).alias("cnt"))
