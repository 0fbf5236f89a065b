"""A knowledge graph, labels, vectors and requests derived from the TPC-H-like test tables.

Every row of the source tables takes part, so the work of each query grows with them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphprep.functions.text import RDFS_LABEL
from graphprep.functions.vectors import COMPLEX, TRANSLATION

PARTITIONS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _uri(kind: str, key: str) -> Column:
    return F.concat(F.lit(f"/{kind}/"), F.col(key).cast("string"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A multigraph with hubs, self-loops, rare entities and one rare relation."""

    def edges(rows: DataFrame, subj: Column, rel: Column, obj: Column) -> DataFrame:
        return rows.select(subj.alias("subj"), rel.alias("rel"), obj.alias("obj"))

    lines, orders, customers, nations = (
        table(spark, sf_dir, name) for name in ("lineitem", "orders", "customer", "nation")
    )
    nation, region = _uri("nation", "n_nationkey"), _uri("region", "n_regionkey")
    return _union(
        [
            edges(lines, _uri("order", "l_orderkey"), _uri("contains", "l_returnflag"), _uri("part", "l_partkey")),
            edges(orders, _uri("order", "o_orderkey"), F.lit("/placed_by"), _uri("customer", "o_custkey")),
            edges(customers, _uri("customer", "c_custkey"), F.lit("/in_nation"), _uri("nation", "c_nationkey")),
            edges(nations, nation, F.lit("/in_region"), region),
            edges(nations, nation, F.lit("/self"), nation),
            edges(nations.where(F.col("n_nationkey") < 3), nation, F.lit("/hub"), region),
        ]
    )


def _literal(text: Column, tag: Column | str) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"@'), F.lit(tag) if isinstance(tag, str) else tag)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label triples: two for each part, one for each document in its language, one for each relation but one."""
    parts = table(spark, sf_dir, "part")
    texts = table(spark, sf_dir, "documents")
    relations = triples(spark, sf_dir).select("rel").distinct().where(F.col("rel") != "/hub")

    def labelled(df: DataFrame, subj: Column, obj: Column) -> DataFrame:
        return df.select(subj.alias("subj"), F.lit(RDFS_LABEL).alias("rel"), obj.alias("obj"))

    return _union(
        [
            labelled(parts, _uri("part", "p_partkey"), _literal(F.col("p_name"), "en")),
            labelled(parts, _uri("part", "p_partkey"), _literal(F.col("p_type"), "en-GB")),
            labelled(texts, _uri("doc", "doc_id"), _literal(F.col("text"), F.col("lang"))),
            labelled(relations, F.col("rel"), _literal(F.translate("rel", "/_", "  "), "en")),
        ]
    )


def raw_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(spark, sf_dir).unionByName(labels(spark, sf_dir))


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph as tab-separated lines with a closing dot, and as many lines cut short after the second field."""
    graph = triples(spark, sf_dir)
    whole = graph.select(F.concat_ws("\t", "subj", "rel", "obj", F.lit(".")).alias("value"))
    return whole.unionByName(graph.select(F.concat_ws("\t", "subj", "rel", F.lit("\t")).alias("value")))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") % PARTITIONS).cast("int").alias("partition"),
        F.expr(f"cast(vec_id div {PARTITIONS} as int)").alias("index"),
        "embedding",
    )


def single_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.lit(0).alias("partition"), F.col("vec_id").cast("int").alias("index"), "embedding"
    )


def operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relation for each vector label: the label's first vector as complex and as translation operator."""
    first = table(spark, sf_dir, "embeddings").groupBy("label").agg(F.min_by("embedding", "vec_id").alias("v"))
    half = (F.size("v") / 2).cast("int")
    absent = F.lit(None).cast("array<float>")
    real, imag = F.slice("v", 1, half), F.slice("v", half + 1, half)
    conjugate = F.transform(imag, lambda x: -x)

    def row(side: str, kind: str, a: Column, b: Column, t: Column) -> Column:
        return F.struct(
            F.lit(side).alias("side"), F.lit(kind).alias("kind"), a.alias("real"), b.alias("imag"), t.alias("translation")
        )

    rows = [
        row("lhs", COMPLEX, real, imag, absent),
        row("rhs", COMPLEX, real, conjugate, absent),
        row("lhs", TRANSLATION, absent, absent, F.col("v")),
        row("rhs", TRANSLATION, absent, absent, F.transform("v", lambda x: -x)),
    ]
    return first.select(F.col("label").alias("rel"), F.inline(F.array(*rows)))


def complex_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators(spark, sf_dir).where(F.col("kind") == COMPLEX)


def vector_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the vectors that have a judged document of the same number; the others stay unnamed."""
    judged = table(spark, sf_dir, "labels")
    vectors = table(spark, sf_dir, "embeddings").select("vec_id")
    return vectors.join(judged, F.col("vec_id") == F.col("doc_id")).select(
        F.concat_ws(" ", F.lit("quality"), "quality", F.lit("toxic"), "toxic").alias("name"),
        _uri("vec", "vec_id").alias("ent"),
        F.lit(1).cast("long").alias("count"),
        F.expr(f"cast(vec_id div {PARTITIONS} as int)").alias("index"),
        (F.col("vec_id") % PARTITIONS).cast("int").alias("partition"),
    )


def vector_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "embeddings").groupBy("label").count()
    return counted.select(
        _uri("label", "label").alias("name"),
        _uri("label", "label").alias("ent"),
        "count",
        F.col("label").alias("index"),
        F.lit(0).alias("partition"),
    )


def knn_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector asks its own label's relation, once in each direction, for 3 to 12 neighbours."""
    asked = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.posexplode(F.array(F.lit("left"), F.lit("right"))).alias("pos", "direction")
    )
    return asked.select(
        (F.col("vec_id") * 2 + F.col("pos")).alias("query_id"),
        _uri("vec", "vec_id").alias("entity"),
        _uri("label", "label").alias("relation"),
        (F.col("label") + 3).alias("k"),
        "direction",
    )


def document_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document asks as if it were a vector, about twelve relations of which two do not exist."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("query_id"),
        _uri("vec", "doc_id").alias("entity"),
        F.concat(F.lit("/label/"), (F.col("doc_id") % 12).cast("string")).alias("relation"),
        F.lit(5).alias("k"),
        F.lit("left").alias("direction"),
    )


def vector_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded triples from each vector to the first one of its label: ten hubs hold all the right ends."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    first = vectors.groupBy("label").agg(F.min("vec_id").alias("first"))
    pairs = vectors.join(first, "label")
    return pairs.select(
        F.expr(f"cast(vec_id div {PARTITIONS} as int)").alias("subj"),
        F.expr(f"cast(first div {PARTITIONS} as int)").alias("obj"),
        F.col("label").alias("rel"),
        (F.col("vec_id") % PARTITIONS).cast("int").alias("part_left"),
        (F.col("first") % PARTITIONS).cast("int").alias("part_right"),
    )


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the parts with the number of their line items."""
    sold = table(spark, sf_dir, "lineitem").groupBy("l_partkey").count()
    parts = table(spark, sf_dir, "part").join(sold, F.col("p_partkey") == F.col("l_partkey"), "left")
    return parts.select(
        F.col("p_name").alias("name"),
        _uri("part", "p_partkey").alias("ent"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
        F.col("p_partkey").cast("int").alias("index"),
        F.lit(0).alias("partition"),
    )


# Requests for the edge cases (query_id, query, limit, offset).
EDGE_REQUESTS = [
    (-1, "", 7, 3),
    (-2, "red red", 10, 0),
    (-3, "RED Widget", 10, 0),
    (-4, "widge", 10, 2),
    (-5, "red", 10, 1_000_000_000),
    (-6, "in", 25, 0),
    (-7, "red ", 10, 0),
]


def search_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct part name and each distinct word of one as a request, and the edge cases."""
    parts = table(spark, sf_dir, "part")
    whole = parts.groupBy("p_name").agg(F.min("p_partkey").alias("query_id")).select(
        "query_id", F.upper("p_name").alias("query"), F.lit(10).alias("limit"), F.lit(0).alias("offset")
    )
    words = parts.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "query"))
    single = words.groupBy("pos", "query").agg(F.min("p_partkey").alias("first")).select(
        (F.col("first") + (F.col("pos") + 1) * 1_000_000_000_000).alias("query_id"),
        "query",
        F.lit(20).alias("limit"),
        F.lit(95).alias("offset"),
    )
    edge = spark.createDataFrame(EDGE_REQUESTS, "query_id long, query string, limit int, offset int")
    return _union([whole, single, edge])
