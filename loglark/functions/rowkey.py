"""Row keys (P6, F9, M1, M3).

``rowkey = day + "_" + crc32(referer + url + ip + ua)`` printed as an unsigned
decimal.  A NULL part is concatenated as the text ``null`` (string
concatenation semantics of the source system), and an empty text hashes to 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_PARTS = ("referer", "url", "ip", "ua")


def key_info(*cols: Column | str) -> Column:
    """Concatenation of the key parts, NULL parts rendered as 'null' (M3)."""
    parts = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("null")) for c in cols]
    return F.concat(*parts)


def crc32_key(day: Column, info: Column) -> Column:
    # crc32 of '' is 0, which is exactly the empty-info guard.
    return F.concat(day, F.lit("_"), F.coalesce(F.crc32(info), F.lit(0)).cast("string"))


def md5_key(day: Column, info: Column) -> Column:
    return F.concat(day, F.lit("_"), F.md5(info))


def rowkey(day: Column, info: Column, algo: str = "crc32") -> Column:
    if algo == "crc32":
        return crc32_key(day, info)
    if algo == "md5":
        return md5_key(day, info)
    raise ValueError(f"unknown rowkey algorithm {algo!r}")


def access_rowkey(day: Column, algo: str = "crc32") -> Column:
    """Row key of a parsed access row: referer+url+ip+ua."""
    return rowkey(day, key_info(*KEY_PARTS), algo)


def access_digest(algo: str = "crc32") -> Column:
    """The checksum part of ``access_rowkey`` in its shortest form, for rows that are shuffled by it:
    a bigint for crc32, 16 bytes for md5."""
    info = key_info(*KEY_PARTS)
    if algo == "crc32":
        return F.coalesce(F.crc32(info), F.lit(0).cast("bigint"))
    if algo == "md5":
        return F.unhex(F.md5(info))
    raise ValueError(f"unknown rowkey algorithm {algo!r}")


def digest_rowkey(day: Column, digest: Column, algo: str = "crc32") -> Column:
    """``access_rowkey`` from its day and ``access_digest``."""
    return F.concat(day, F.lit("_"), digest.cast("string") if algo == "crc32" else F.lower(F.hex(digest)))
