"""Counting and filtering of raw triples."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphprep.functions.text import is_english_label
from graphprep.operators.lookup import HOT_LIMIT, lookup_join, unique_join
from graphprep.workspace import stage

MIN_COUNT = 5
#: Triples from which on an entity's rows are spread.
HOT_ROWS = 10_000
#: Entities from which on slots are marked, slots an entity, and the most slots: two bits each go to every task.
MANY_ENTITIES = 100_000
SLOTS_PER_ENTITY = 8
MAX_SLOTS = 1 << 28
#: Slots of one bitmap of ``bitmap_construct_agg``.
BLOCK = 1 << 15


def endpoints(triples: DataFrame) -> DataFrame:
    """Both ends of each triple; a self-loop gives two rows."""
    return triples.select(F.explode(F.array("subj", "obj")).alias("ent"))


def triples_per_entity(triples: DataFrame) -> DataFrame:
    """Number of triples each entity takes part in; a self-loop counts once."""
    ends = F.when(F.col("subj") == F.col("obj"), F.array("subj")).otherwise(F.array("subj", "obj"))
    return triples.select(F.explode(ends).alias("ent")).groupBy("ent").count()


def triples_per_relation(triples: DataFrame) -> DataFrame:
    return triples.groupBy("rel").count()


def frequent_entities(triples: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    return triples_per_entity(triples).where(F.col("count") >= min_count)


def frequent_relations(triples: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    return triples_per_relation(triples).where(F.col("count") >= min_count)


def keep_relations(triples: DataFrame, relations: DataFrame) -> DataFrame:
    """Triples whose relation is in ``relations(rel)``."""
    members = relations.select(F.col("rel").alias("kept_rel"))
    return lookup_join(triples, members, "rel", "kept_rel", "left_semi")


def _slot(entity: str, slots: int) -> Column:
    return F.pmod(F.xxhash64(entity), F.lit(slots))


def _block(slot: Column) -> Column:
    return F.shiftright(slot, 15).cast("int")


def marked_slots(counts: DataFrame, slots: int) -> DataFrame:
    """``(block, often, seldom)``: for each slot a hash deals entities to, whether it has frequent ones, and rare ones.

    Slots come in blocks of ``BLOCK``, the bits of one as 512 words of 64.
    """
    slot = _slot("ent", slots)
    dealt = counts.where(F.col("ent").isNotNull()).select(
        _block(slot).alias("block"), slot.bitwiseAND(BLOCK - 1).alias("place"), "frequent"
    )
    built = dealt.repartition("block").groupBy("block").agg(
        F.bitmap_construct_agg(F.when(F.col("frequent") == 1, F.col("place"))).alias("often"),
        F.bitmap_construct_agg(F.when(F.col("frequent") == 0, F.col("place"))).alias("seldom"),
    )

    def words(bits: str) -> Column:
        word = lambda i: F.conv(F.hex(F.substring(F.col(bits), i * 8 + 1, F.lit(8))), 16, -10).cast("bigint")
        return F.transform(F.sequence(F.lit(0), F.lit(BLOCK // 64 - 1)), word).alias(bits)

    return built.select("block", words("often"), words("seldom"))


def _look_up(triples: DataFrame, end: str, marks: DataFrame, slots: int) -> DataFrame:
    """``triples`` with ``_<end>_often`` and ``_<end>_seldom``, what the slot of an end has."""
    slot = _slot(end, slots)
    place = slot.bitwiseAND(BLOCK - 1).cast("int")
    # The first byte of a bitmap is the first of a word, but its lowest bit is the first of the byte.
    word, bit = F.shiftright(place, 6) + 1, place.bitwiseAND(63).bitwiseXOR(F.lit(56))
    named = marks.select(F.col("block").alias("_block"), F.col("often").alias("_often"), F.col("seldom").alias("_seldom"))
    found = triples.join(F.broadcast(named), _block(slot) == F.col("_block"))
    has = lambda bits: F.getbit(F.element_at(bits, word), bit) == 1
    return found.select(*triples.columns, has("_often").alias(f"_{end}_often"), has("_seldom").alias(f"_{end}_seldom"))


def filter_min_count(triples: DataFrame, min_count: int = MIN_COUNT, hot: Collection[str] | None = None) -> DataFrame:
    """Triples whose two entities and relation each occur in at least ``min_count`` triples.

    One pass over counts taken before any filtering, so a survivor may end with fewer triples. The relation filter
    comes first: it needs no shuffle of the triples and thins them for the two that do.

    The triples are read for either count, and for the result. The counts of entities are stored; both semi joins and
    (unless given) the very frequent entities, whose rows are spread, come from there.

    Of many entities, slots that a hash deals them to are marked (``marked_slots``) and sent to the tasks. An entity whose slot
    has no rare one is frequent, one whose slot has no frequent one is rare. Only triples that this leaves open, as an end
    shares a slot with entities of both kinds, are shuffled for the semi joins.
    """
    counted = triples_per_entity(triples).withColumn("frequent", (F.col("count") >= min_count).cast("int"))
    every = stage(counted, "entity-counts", partition_by=("frequent",))
    counts = every.where("frequent = 1")
    if hot is None:
        frequent = counts.where(F.col("count") >= HOT_ROWS).orderBy(F.desc("count"), "ent").limit(HOT_LIMIT)
        hot = [row["ent"] for row in frequent.collect()]
    kept = keep_relations(triples, frequent_relations(triples, min_count))

    def met(some: DataFrame, how: str = "left_semi") -> DataFrame:
        for end in ("subj", "obj"):
            some = unique_join(some, counts.select(F.col("ent").alias(f"kept_{end}")), end, f"kept_{end}", how, hot)
        return some

    n = every.count()
    # Beyond two entities a slot, hardly any slot would decide.
    if not MANY_ENTITIES <= n <= 2 * MAX_SLOTS:
        return met(kept)
    slots = min(MAX_SLOTS, max(BLOCK, 1 << (SLOTS_PER_ENTITY * n - 1).bit_length()))
    marks = stage(marked_slots(every, slots), "entity-slots", packed=True)
    looked = kept.where(F.col("subj").isNotNull() & F.col("obj").isNotNull())
    looked = _look_up(_look_up(looked, "subj", marks, slots), "obj", marks, slots)
    likely = looked.where(F.col("_subj_often") & F.col("_obj_often"))
    open_ = F.col("_subj_seldom") | F.col("_obj_seldom")
    # Inner joins, of unique keys: semi joins would be pushed down, before the look-ups, and shuffle every triple.
    return likely.where(~open_).select(kept.columns).unionByName(met(likely.where(open_).select(kept.columns), "inner"))


def english_labels(triples: DataFrame, strict: bool = False) -> DataFrame:
    return triples.where(is_english_label(F.col("rel"), F.col("obj"), strict))
