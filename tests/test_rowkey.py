"""Row keys (FIXTURES §2, M1, M3, F9)."""

import zlib

from pyspark.sql import functions as F

from loglark.functions.rowkey import access_rowkey, crc32_key, key_info

INFO = "https://shop.example.com/cart" + "/checkout?step=2" + "203.0.113.77"
VECTOR = "The quick brown fox jumps over the lazy dog"  # CRC-32 test vector: 0x414FA339


def test_crc32_matches_zlib_and_known_vector(spark):
    df = spark.createDataFrame([("20190130", INFO), ("20190130", ""), ("20190130", VECTOR)], "day string, info string")
    got = [r["k"] for r in df.select(crc32_key(F.col("day"), F.col("info")).alias("k")).collect()]
    assert got[0] == f"20190130_{zlib.crc32(INFO.encode())}"
    assert got[1] == "20190130_0"
    assert got[2] == f"20190130_{0x414FA339}" == "20190130_1095738169"  # unsigned, not zero-padded


def test_null_part_hashes_as_text_null(spark):
    df = spark.createDataFrame([("r", "u", "1.2.3.4", None)], "referer string, url string, ip string, ua string")
    df = df.withColumn("day", F.lit("20190130"))
    k = df.select(access_rowkey(F.col("day")).alias("k")).first()["k"]
    assert k == f"20190130_{zlib.crc32(b'ru1.2.3.4null')}"
    k_md5 = df.select(access_rowkey(F.col("day"), "md5").alias("k")).first()["k"]
    import hashlib
    assert k_md5 == "20190130_" + hashlib.md5(b"ru1.2.3.4null").hexdigest()


def test_key_info_order(spark):
    df = spark.createDataFrame([("a", "b", "c", "d")], "referer string, url string, ip string, ua string")
    assert df.select(key_info("referer", "url", "ip", "ua").alias("i")).first()["i"] == "abcd"
