"""Registered queries of the operators, each over its whole table, and their DuckDB twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphprep.llm import collocations, conversation_repair, fingerprints, host_rules, jaccard_join, license_scan, lm_scoring, mixing, packing, resharding, secret_scan, token_counts, url_cascade
from graphprep.llm.url_cascade import Rule
from graphprep.workspace import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
#: A page is junk with so many runs of asterisks; its host and path are then listed.
JUNK_RUNS = 5
OLD_SHARDS, SHARDS = 16, 24


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_lm_scoring(spark, sf_dir):
    found = lm_scoring.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    losses = ("target_loss", "background_loss", "difference")
    return found.select("doc_id", "n_words", *[F.round(c, 4).alias(c) for c in losses])


@query
def op2_host_rules(spark, sf_dir):
    rows = host_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    m = F.col("measures")
    digest = [m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return rows.select(F.col("doc")["doc_id"].alias("doc_id"), *digest, "base_failed", "host_rejected", "kept")


@query
def op3_mixture_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


@query
def op4_ngram_jaccard_join(spark, sf_dir):
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_secret_scan(spark, sf_dir):
    rows = secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    kinds = F.array(*map(F.lit, secret_scan.KINDS))
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint,key:string,live:boolean>>"))
    named = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("all", lambda s: s["kind"] < 3)
    of_kind = lambda i: F.size(F.filter("all", lambda s: s["kind"] == i)).cast("bigint")
    counts = [of_kind(i).alias(f"n_{kind}") for i, kind in enumerate(secret_scan.KINDS[:3])]
    live = F.size(F.filter("all", lambda s: s["live"])).cast("bigint")
    return rows.select("doc", spans.alias("all")).select(
        F.col("doc")["doc_id"].alias("doc_id"),
        *counts,
        F.sha2(F.encode(F.array_join(F.transform(base, named), ","), "UTF-8"), 256).alias("base_sha256"),
        F.array_join(F.transform("all", named), ",").alias("spans"),
        live.alias("n_live"),
    )


@query
def op6_license_scan(spark, sf_dir):
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "license", F.round("dice", 6).alias("dice"), "common", "part_bigrams", F.col("start").alias("part_start"), F.col("end").alias("part_end"))


@query
def op7_source_mixing(spark, sf_dir):
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "source", "size", "source_size", F.round("target", 6).alias("target"), "copies", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op8_url_cascade(spark, sf_dir):
    """The list is what is found at hosts and paths of junk pages."""
    pages = table(spark, sf_dir, "pages")
    runs = (F.length("html") - F.length(F.replace("html", F.lit("***"), F.lit("")))) / 3
    key = F.concat(url_cascade.url_host(F.col("url")), url_cascade.url_path(F.col("url")))
    listed = stage(pages.where(runs >= JUNK_RUNS).select(key.alias("key")).distinct(), "listed-keys")
    return url_cascade.judge_urls(pages, RULES, listed)


@query
def op9_document_fingerprints(spark, sf_dir):
    return fingerprints.compare_edits(table(spark, sf_dir, "documents"))


@query
def op10_flow_resharding(spark, sf_dir):
    """From 16 shards by source, as uneven as the sources, to 24 of equal bytes."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    old = F.pmod(F.crc32(F.encode(F.coalesce("source", F.lit("")), "UTF-8")), F.lit(OLD_SHARDS)).cast("int")
    crc = F.crc32(F.encode(text, "UTF-8"))
    rows = docs.select("doc_id", resharding.text_size(F.col("text")).alias("size"), crc.alias("text_crc32"), old.alias("old"), F.monotonically_increasing_id().alias("id"))
    placed = resharding.assign(stage(rows, "shard-rows"), SHARDS, ["doc_id", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("old").alias("old_shard"))


@query
def op11_conversation_repair(spark, sf_dir):
    return conversation_repair.repair_report(table(spark, sf_dir, "conversations"))


@query
def op12_phrase_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op13_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))
