"""URL filters by a cascade of Bloom filters.

The keys of the corpus (host and path of all pages) are known, and some of them are listed. Level 0 is a Bloom filter of
the listed keys; level 1 holds the other keys that pass level 0, level 2 the listed ones that pass level 1, and so on
until nothing passes wrongly. Every key of the corpus is then answered exactly, by asking one level after the other, and
the answer needs no join with the list.

Keys are dealt into shards by hash and each shard has a cascade of its own, so a level is built by grouping bits by
shard and word and no filter grows beyond ``SHARD_BITS``. If all cascades together are within ``BROADCAST_BYTES`` they
are sent to all tasks; else the urls go to the shards, hot keys spread over copies of their shard's cascade.

Explicit rules come first: a rule names a host and the beginning of a path, holds for the host's subdomains too, and the
longest fitting one decides.

Defined results: a null url and one without ``://`` have an empty host and path, which is a key like any other; null keys
in the list are left out; repeated rows are answered row by row; an empty list blocks nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphprep.llm.common import columns_of, extended
from graphprep.workspace import stage

HASHES = 4
BITS_PER_KEY = 8  # about 2.4 % pass wrongly
LEAST_BITS = 64
SHARD_BITS = 1 << 24
BROADCAST_BYTES = 64 << 20
MAX_LEVELS = 64
SPREAD = 32


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``struct(rule, verdict)`` of the longest fitting rule (ties: the first by text), else null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def level_hashes(key: Column) -> tuple[Column, Column]:
    """Two independent hashes of a key. The bits of a level follow from both and the level's number."""
    return F.xxhash64(key), F.xxhash64(F.concat(F.lit("\1"), key))


def bit_places(h1: Column, h2: Column, level: int, bits: Column) -> Column:
    """The places of a key's bits on a level, the same as ``passes`` looks at."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(level * HASHES + i), h1, h2), bits) for i in range(HASHES)])


def build(keys: DataFrame, shards: int) -> DataFrame:
    """``shard, level, bits, words`` for distinct ``key, listed``; ``words`` is an array of (word number, 64 bits).

    Each round is one level of all shards: the keys it has to tell apart, the filter of one kind, and the wrong
    passes of the other, which the next level has to hold. Rounds end when none is left, and each leaves only a small share.
    """
    h1, h2 = level_hashes(F.col("key"))
    shard = F.pmod(F.xxhash64(F.concat(F.lit("\2"), F.col("key"))), F.lit(shards)).cast("int")
    open_ = stage(keys.select("listed", h1.alias("h1"), h2.alias("h2"), shard.alias("shard")), "cascade-keys")
    levels = None
    for level in range(MAX_LEVELS):
        inside = F.col("listed") == (level % 2 == 0)
        sizes = open_.where(inside).groupBy("shard").agg(F.greatest(F.lit(LEAST_BITS), F.ceil(F.count("*") * BITS_PER_KEY / 64) * 64).cast("bigint").alias("bits"))
        sizes = stage(sizes.withColumnRenamed("shard", "_shard"), "cascade-sizes")
        sized = open_.join(sizes, F.col("shard") == F.col("_shard"), "left").drop("_shard")
        sized = sized.withColumn("places", bit_places(F.col("h1"), F.col("h2"), level, F.coalesce("bits", F.lit(LEAST_BITS).cast("bigint"))))
        placed = sized.where(inside).select("shard", "bits", F.explode("places").alias("place"))
        word = F.floor(F.col("place") / 64)
        filled = placed.groupBy("shard", "bits", word.alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("value"))
        words = stage(filled, "cascade-words")
        # Those of the other kind whose bits are all set pass wrongly and make the next level; with them goes this kind.
        other = sized.where(~inside & F.col("bits").isNotNull()).select("listed", "h1", "h2", "shard", F.posexplode("places").alias("i", "place"))
        asked = other.withColumns({"word": F.floor(F.col("place") / 64), "bit": (F.col("place") % 64).cast("int")})
        held = words.select(F.col("shard").alias("_shard"), F.col("word").alias("_word"), "value")
        hits = asked.join(held, (F.col("shard") == F.col("_shard")) & (F.col("word") == F.col("_word")))
        hits = hits.where(F.expr("(shiftright(value, bit) & 1) = 1"))
        wrong = hits.groupBy("listed", "h1", "h2", "shard").agg(F.count("*").alias("n")).where(F.col("n") == HASHES)
        wrong = stage(wrong.drop("n"), "cascade-wrong")
        made = words.withColumn("level", F.lit(level))
        levels = made if levels is None else levels.unionByName(made)
        if not wrong.limit(1).count():
            break
        shards_left = wrong.select("shard").distinct().withColumnRenamed("shard", "_left")
        rest = open_.where(inside).join(shards_left, F.col("shard") == F.col("_left"), "left_semi").select("listed", "h1", "h2", "shard")
        open_ = stage(wrong.select("listed", "h1", "h2", "shard").unionByName(rest), "cascade-open")
    else:
        raise RuntimeError("the cascade does not end: the list and the universe hold keys of equal hashes")
    return levels.groupBy("shard", "level", "bits").agg(F.collect_list(F.struct("word", "value")).alias("words"))


Cascades = dict[int, list[np.ndarray]]


def as_cascades(rows: list) -> Cascades:
    """Levels by shard, each an array of 64-bit words."""
    found: dict[int, dict[int, np.ndarray]] = {}
    for row in rows:
        words = np.zeros(row["bits"] // 64, np.uint64)
        for w in row["words"]:
            words[w["word"]] = w["value"] & 0xFFFFFFFFFFFFFFFF
        found.setdefault(row["shard"], {})[row["level"]] = words
    return {shard: [levels[i] for i in sorted(levels)] for shard, levels in found.items()}


def listed_by(cascade: list[np.ndarray], places: list[np.ndarray]) -> np.ndarray:
    """Membership of keys: ``places[level]`` has raw hashes, one row per key. The first level not passed decides."""
    n = len(places[0]) if places else 0
    result, open_ = np.zeros(n, bool), np.arange(n)
    for level, words in enumerate(cascade):
        place = places[level][open_] % np.int64(len(words) * 64)  # a modulus of numpy has the divisor's sign, as pmod
        passed = ((words[place // 64] >> (place % 64).astype(np.uint64)) & np.uint64(1)).all(axis=1)
        # Level by level the kinds alternate: not passing an even level means not listed, an odd one listed.
        result[open_[~passed]] = level % 2 == 1
        open_ = open_[passed]
    # Passing all levels means the kind of the last one.
    result[open_] = len(cascade) % 2 == 1
    return result


def _raw_places(levels: int) -> Column:
    h1, h2 = level_hashes(F.col("key"))
    return F.array(*[F.xxhash64(F.lit(level * HASHES + i), h1, h2) for level in range(levels) for i in range(HASHES)])


def judge_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Adds ``listed`` to ``rows`` with a column ``key``, exactly for all keys of ``keys`` (distinct ``key, listed``)."""
    spark = rows.sparkSession
    keys = stage(keys.where(F.col("key").isNotNull()).select("key", F.coalesce("listed", F.lit(False)).alias("listed")), "cascade-universe")
    n_listed = keys.where("listed").count()
    shards = max(1, -(-n_listed * BITS_PER_KEY // SHARD_BITS))
    table = stage(build(keys, shards), "cascade")
    totals = table.agg(F.sum("bits").alias("bits"), F.max("level").alias("level")).first()
    levels = (totals["level"] if totals["level"] is not None else -1) + 1
    if not levels:
        return rows.withColumn("listed", F.lit(False))
    shard = F.pmod(F.xxhash64(F.concat(F.lit("\2"), F.col("key"))), F.lit(shards)).cast("int")
    asked = rows.withColumns({"_shard": shard, "_places": _raw_places(levels)})
    names = [*rows.columns, "listed"]
    schema = extended(rows, "listed boolean")

    def answers(places: list, shard_of: list[int], cascades: Cascades) -> np.ndarray:
        raw = np.array(places, np.int64).reshape(len(places), levels, HASHES)
        owner = np.array(shard_of)
        result = np.zeros(len(places), bool)
        for s in set(shard_of):
            own = np.flatnonzero(owner == s)
            result[own] = listed_by(cascades.get(s, []), [raw[own, level] for level in range(levels)])
        return result

    if totals["bits"] // 8 <= BROADCAST_BYTES:
        shared = spark.sparkContext.broadcast(as_cascades(table.collect()))

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                owner, places = columns_of(batch, "_shard", "_places")
                listed = answers(places, owner, shared.value) if places else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names) - 1], pa.array(listed)], names=names)

        return asked.mapInArrow(judge, schema)

    part = F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD))
    spread = asked.withColumn("_part", part.cast("int"))
    copied = table.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))

    def judge_shard(mine: pd.DataFrame, cascade: pd.DataFrame) -> pd.DataFrame:
        if mine.empty:
            return pd.DataFrame(columns=names)
        found = answers([list(p) for p in mine["_places"]], mine["_shard"].tolist(), as_cascades(cascade.to_dict("records")))
        return mine[names[:-1]].assign(listed=found)

    return spread.groupBy("_shard", "_part").cogroup(copied.groupBy("shard", "_part")).applyInPandas(judge_shard, schema)


def judge_urls(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` for every row of ``page_id, url``; ``listed`` has keys as ``key``."""
    rows = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rows = rows.withColumn("key", F.concat("host", "path"))
    universe = rows.select("key").distinct()
    on_list = listed.select(F.col("key").alias("_listed")).distinct()
    keys = universe.join(on_list, universe["key"] == on_list["_listed"], "left").select("key", F.col("_listed").isNotNull().alias("listed"))
    judged = judge_keys(rows, keys)
    ruled = judged.withColumn("_rule", best_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", F.col("_rule")["rule"].alias("rule"), F.coalesce(F.col("_rule")["verdict"], own).alias("verdict"), "listed")
