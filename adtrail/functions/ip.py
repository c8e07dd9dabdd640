"""IPv4 column expressions and the region-string split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_IPV4 = r"^([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ipv4_to_long(ip) -> Column:
    """Dotted IPv4 to its 32-bit value as bigint; NULL when malformed
    (wrong shape, or an octet above 255)."""
    ip = _col(ip)
    octets = [F.regexp_extract(ip, _IPV4, i).try_cast("bigint") for i in range(1, 5)]
    value = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    ok = ip.rlike(_IPV4)
    for o in octets:
        ok = ok & (o <= 255)
    return F.when(ok, value)


def long_to_ipv4(value) -> Column:
    v = _col(value)
    parts = [F.shiftright(v, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *parts)


def ip_bucket(value, prefix_bits: int = 16) -> Column:
    """Bucket of a 32-bit address: the top ``prefix_bits`` bits (/16 by default)."""
    return F.shiftright(_col(value), 32 - prefix_bits)


def region_split(region) -> Column:
    """``country|area|province|city|isp`` to a struct of five strings.
    Missing trailing parts give NULL."""
    parts = F.split(_col(region), r"\|")
    names = ("country", "area", "province", "city", "isp")
    return F.struct(*[F.get(parts, i).alias(n) for i, n in enumerate(names)])
