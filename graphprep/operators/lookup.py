"""Joins against a lookup table when a few keys of the big side may be very frequent.

``lookup_join`` checks the size of a table that is usually small: at most ``SMALL_ROWS`` rows are fetched (never more than
one row above that) and broadcast, a larger table goes the way of ``unique_join``.

``unique_join`` is for large tables of unique keys. The lookup rows of the hot keys, of which there are at most
``HOT_LIMIT``, are broadcast; all other rows are shuffled by key as usual. The big side's hot rows stay in that shuffle,
but under made-up keys that spread them evenly, since they need nothing from the other side any more. The lookup table is
neither repeated nor re-keyed, so its shuffle can be shared by several joins.

``salted_join`` is for tables with several rows per key: the hot keys' rows of both sides are spread over ``SALTS``
reducers, the lookup side's once for each of them.

Salts come from the stored row number ``_row`` when the table carries it (see ``workspace.stage``): equal rows then part
company as well, and a retried task draws the same salt again. Otherwise they come from a hash of the row.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphprep.workspace import ROW, ROW_NUMBERS

SALTS = 64
HOT_LIMIT = 1000
#: Counters of a summary of frequent values, the error they leave, and summaries that are merged first.
TRACKED = 20_000
SUMMARY_ERROR = 3.5 / TRACKED
MERGES = 64
SMALL_ROWS = 50_000
SMALL_BYTES = 32 << 20  # as JSON text


def hot_keys(df: DataFrame, *keys: str, min_hits: int = 10_000) -> list:
    """The most frequent values over all ``keys`` columns: those with at least ``min_hits`` rows, at most ``HOT_LIMIT``.

    One read. Each task keeps a summary of ``TRACKED`` counters, from which rare values are dropped as it goes; summaries are
    merged task by task into ``MERGES`` and these into one. A count is wrong by at most ``SUMMARY_ERROR`` of all rows, so every
    value with a larger share than that and ``min_hits`` is found, wherever its rows lie. A value missing from the list cannot
    hold more than about a thousandth of the rows. The list is fetched because both sides of a salted join must see the very
    same keys.
    """
    values = df.select(F.explode(F.array(*keys)).alias("key")) if len(keys) > 1 else df.select(*keys).toDF("key")
    kept = values.where(F.col("key").isNotNull()).withColumn("_merge", F.spark_partition_id() % MERGES)
    summaries = kept.groupBy("_merge").agg(F.expr(f"approx_top_k_accumulate(key, {TRACKED})").alias("summary"))
    # Grouped, as no summaries at all cannot be merged.
    found = summaries.groupBy((F.col("_merge") * 0).alias("_all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(summary, {TRACKED}), {HOT_LIMIT})").alias("top")).first()
    frequent = [(-row["count"], row["item"]) for row in (found["top"] if found and found["top"] else []) if row["count"] >= min_hits]
    return [item for _, item in sorted(frequent)]


def small_copy(df: DataFrame, max_rows: int | None = None) -> DataFrame | None:
    """A driver-held copy of ``df`` if it has at most ``max_rows`` (by default ``SMALL_ROWS``) rows and ``SMALL_BYTES``, else None."""
    max_rows = SMALL_ROWS if max_rows is None else max_rows
    # Counted and measured where it lies: rows can be long.
    some = df.limit(max_rows + 1)
    size = F.sum(F.octet_length(F.to_json(F.struct(*[some[c] for c in some.columns]), {"ignoreNullFields": "false"})).cast("bigint"))
    n, bytes_ = some.agg(F.count(F.lit(1)), size).first()
    if n > max_rows or (bytes_ or 0) > SMALL_BYTES:
        return None
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, schema=df.schema)


def _salt(df: DataFrame, salts: int) -> Column:
    source = F.col(ROW) if ROW in df.columns else F.xxhash64(*df.columns)
    return F.pmod(source, F.lit(salts)).cast("int")


def salted_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot: Collection = (), salts: int = SALTS
) -> DataFrame:
    """Inner join with any number of ``right`` rows per key; ``right_key`` is dropped from the result."""
    if not hot:
        return left.join(right, left[left_key] == right[right_key]).drop(right[right_key])
    hot = list(hot)
    salt = F.when(F.col(left_key).isin(hot), _salt(left, salts)).otherwise(F.lit(0))
    last = F.when(F.col(right_key).isin(hot), F.lit(salts - 1)).otherwise(F.lit(0))
    salted_left = left.withColumn("_salt", salt)
    salted_right = right.withColumn("_right_salt", F.explode(F.sequence(F.lit(0), last)))
    same = (salted_left[left_key] == salted_right[right_key]) & (salted_left["_salt"] == salted_right["_right_salt"])
    return salted_left.join(salted_right, same).drop("_salt", "_right_salt").drop(salted_right[right_key])


def unique_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner", hot: Collection = ()
) -> DataFrame:
    """Join with the unique keys of ``right``; ``right_key`` is dropped from the result.

    ``how`` is inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unknown join {how!r}")
    keeps_left_only = how in ("left_semi", "left_anti")
    if not hot:
        joined = left.join(right, left[left_key] == right[right_key], how)
        return joined if keeps_left_only else joined.drop(right[right_key])
    hot = list(hot)
    values = [] if keeps_left_only else [c for c in right.columns if c != right_key]
    renamed = [right[c].alias(f"_hot_{c}") for c in values]
    few = right.where(right[right_key].isin(hot)).select(right[right_key].alias("_hot_key"), *renamed)
    is_hot = F.coalesce(left[left_key].isin(hot), F.lit(False))
    # Neither a key that starts with NUL nor a negative number is asked of the lookup table for its own sake: whatever
    # a hot row meets there is ignored below.
    salt = _salt(left, ROW_NUMBERS)
    if isinstance(left.schema[left_key].dataType, T.StringType):
        made_up = F.concat(F.lit("\0"), salt.cast("string"))
    else:
        made_up = (F.lit(-1) - salt).cast(left.schema[left_key].dataType)
    # One key travels: the made-up one, which leads a hot row on its way, has the real one beside it.
    marked = left.withColumn("_hot_row", is_hot).join(F.broadcast(few), left[left_key] == few["_hot_key"], "left")
    if how != "left":
        known = F.col("_hot_key").isNotNull()
        marked = marked.where(~F.col("_hot_row") | (~known if how == "left_anti" else known))
    spread = marked.select(
        *[c for c in left.columns if c != left_key],
        F.when(F.col("_hot_row"), F.col(left_key)).alias("_kept_key"),
        F.when(F.col("_hot_row"), made_up).otherwise(F.col(left_key)).alias("_spread_key"),
        *[f"_hot_{c}" for c in values],
    )
    found = right.select(right[right_key].alias("_cold_key"), *[right[c].alias(f"_cold_{c}") for c in values])
    joined = spread.join(found, spread["_spread_key"] == found["_cold_key"], "left")
    hot_row = F.col("_kept_key").isNotNull()
    if how != "left":
        met = F.col("_cold_key").isNotNull()
        joined = joined.where(hot_row | (~met if how == "left_anti" else met))
    key = F.coalesce("_kept_key", "_spread_key").alias(left_key)
    chosen = [F.when(hot_row, F.col(f"_hot_{c}")).otherwise(F.col(f"_cold_{c}")).alias(c) for c in values]
    return joined.select(*[key if c == left_key else F.col(c) for c in left.columns], *chosen)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    max_rows: int | None = None,
) -> DataFrame:
    """``unique_join`` with a table that is broadcast if a check finds it small."""
    copy = small_copy(right, max_rows)
    if copy is None:
        return unique_join(left, right, left_key, right_key, how, hot_keys(left, left_key))
    joined = left.join(F.broadcast(copy), left[left_key] == copy[right_key], how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(copy[right_key])
