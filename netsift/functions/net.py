"""Address and location expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from netsift.constants import GEOHASH_ALPHABET, LOCAL_PREFIXES

LOCAL_IPV4 = r"^(10\.\d{1,3}|192\.168|172\.(1[6-9]|2\d|3[01]))\.\d{1,3}\.\d{1,3}$"
IPV4 = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ip_to_long(c: Column | str) -> Column:
    """Dotted IPv4 as a 32-bit number, null for anything else."""
    ip = _col(c)
    octets = [F.substring_index(F.substring_index(ip, ".", i), ".", -1).try_cast("long") for i in range(1, 5)]
    value = ((octets[0] * 256 + octets[1]) * 256 + octets[2]) * 256 + octets[3]
    return F.when(ip.rlike(IPV4), value)


def is_local_cidr(c: Column | str) -> Column:
    """10/8, 172.16/12 or 192.168/16; false for null or non-IPv4 text."""
    return F.coalesce(_col(c).rlike(LOCAL_IPV4), F.lit(False))


def is_local_prefix(c: Column | str, prefixes: list[str] = LOCAL_PREFIXES) -> Column:
    """Plain text-prefix test; unlike the CIDR form it knows only 172.16.x of 172.16/12."""
    test = F.lit(False)
    for p in prefixes:
        test = test | F.startswith(_col(c), F.lit(p))
    return F.coalesce(test, F.lit(False))


def is_local(c: Column | str, mode: str = "cidr") -> Column:
    return is_local_prefix(c) if mode == "prefix" else is_local_cidr(c)


def outbound(src: Column | str, dst: Column | str, mode: str = "cidr") -> Column:
    return is_local(src, mode) & ~is_local(dst, mode)


def geohash(lat: Column | str, lon: Column | str, precision: int = 3) -> Column:
    """Geohash cell by interleaving longitude and latitude bits."""
    bits = 5 * precision
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2

    def cell(value: Column, low: float, width: float, size: int) -> Column:
        raw = F.floor((value - F.lit(low)) / F.lit(width) * F.lit(float(1 << size))).cast("long")
        return F.greatest(F.least(raw, F.lit((1 << size) - 1).cast("long")), F.lit(0).cast("long"))

    x = cell(_col(lon).cast("double"), -180.0, 360.0, lon_bits)
    y = cell(_col(lat).cast("double"), -90.0, 180.0, lat_bits)
    chars = []
    for i in range(precision):
        index = F.lit(0).cast("long")
        for j in range(5):
            b = 5 * i + j
            axis, size = (x, lon_bits) if b % 2 == 0 else (y, lat_bits)
            bit = F.shiftright(axis, size - 1 - b // 2).bitwiseAND(F.lit(1).cast("long"))
            index = index * 2 + bit
        chars.append(F.substring(F.lit(GEOHASH_ALPHABET), (index + 1).cast("int"), F.lit(1)))
    known = _col(lat).isNotNull() & _col(lon).isNotNull()
    return F.when(known, F.concat(*chars))
