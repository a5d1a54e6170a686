"""IPv4 text -> number, with validation (J1 care: a malformed ip is NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_PATTERN = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 -> bigint; NULL for NULL, three octets, octet 256, etc."""
    parts = F.split(ip, r"\.")
    num = (parts.getItem(0).cast("bigint") * 16777216
           + parts.getItem(1).cast("bigint") * 65536
           + parts.getItem(2).cast("bigint") * 256
           + parts.getItem(3).cast("bigint"))
    return F.when(ip.rlike(IPV4_PATTERN), num)


def long_to_ip(n: Column) -> Column:
    return F.concat_ws(
        ".",
        F.shiftright(n, 24).bitwiseAND(255).cast("string"),
        F.shiftright(n, 16).bitwiseAND(255).cast("string"),
        F.shiftright(n, 8).bitwiseAND(255).cast("string"),
        n.bitwiseAND(255).cast("string"),
    )
