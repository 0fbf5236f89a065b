"""Raw triples as tab-separated text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_triples(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    """``lines(value)`` to ``(subj, rel, obj)``: the first three tab-separated fields; later fields are ignored.

    Trailing empty fields do not count as fields. A line with fewer than three is an error, or is skipped with
    ``dropmalformed``. The CSV reader would not do: literals hold quotes.
    """
    fields = lines.select(F.split(F.rtrim("value", F.lit("\t")), "\t", -1).alias("fields"), "value")
    complete = F.size("fields") >= 3
    if mode == "dropmalformed":
        fields = fields.where(complete)
    elif mode == "failfast":
        error = F.raise_error(F.concat(F.lit("malformed triple: "), F.col("value")))
        fields = fields.withColumn("fields", F.when(complete, F.col("fields")).otherwise(error))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return fields.select(*[F.get("fields", i).alias(name) for i, name in enumerate(("subj", "rel", "obj"))])


def read_triple_text(spark: SparkSession, path: str, mode: str = "failfast") -> DataFrame:
    return parse_triples(spark.read.text(path), mode)
