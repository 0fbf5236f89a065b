"""A hash any SQL engine can reproduce: the first eight hex digits of an MD5 digest as a number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(*columns: Column) -> Column:
    """MD5 of the tab-joined columns, 32 hex digits."""
    return F.md5(columns[0] if len(columns) == 1 else F.concat_ws("\t", *columns))


def number(hex_digest: Column, digits: int = 8) -> Column:
    """The leading hex digits of a digest as a bigint (at most 15 of them fit)."""
    return F.conv(F.substring(hex_digest, 1, digits), 16, 10).cast("bigint")


def modulo(hex_digest: Column, n: int) -> Column:
    return F.pmod(number(hex_digest), F.lit(n)).cast("int")
