"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglark.session import ensure_checkpoint_dir, new_scratch

WORD = r"[^\x20\x09-\x0D]+"

#: Rows per Arrow batch: texts can be long, so a batch holds few of them.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Python workers find this package where the driver did, and get small batches."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage
    ends there and a lost executor re-reads files instead of recomputing."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    return saved_at(df, new_scratch(spark, tag))


def saved_at(df: DataFrame, path: str) -> DataFrame:
    """``saved`` under a name that the caller keeps, to give it to ``dropped``."""
    df.write.parquet(path)
    return table_files(df.sparkSession, path, df.schema)


def table_files(spark: SparkSession, path: str, schema) -> DataFrame:
    """A written table, read by the schema it was written with."""
    return spark.read.schema(schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that no later step reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """Each row as one struct ``doc`` beside the ``keys`` computed from it, so that no column of the
    table, whatever its name, meets a column of ours."""
    return docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("doc"), *[k.alias(n) for n, k in keys.items()])


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("doc").getField(c).alias(c) for c in columns])


def broadcast_if_few(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """Write a table of keys; broadcast it if it has at most ``rows`` rows
    (counted, not estimated), else leave the join to a shuffle."""
    keys = saved(df, "keys")
    return F.broadcast(keys) if keys.count() <= rows else keys


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
