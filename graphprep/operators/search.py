"""Name search for a table of requests ``(query_id, query, limit, offset)``.

Names are searched in a stored index (``name_index``), or in one that is made for the occasion when a table of names is given.
Equal questions are answered once. Their matches are ids in the order of the answers, in lists for each range of ids, stored once
for the sizes and the pages: a rank is a place in these lists, so nothing is sorted, the matches of one question are never
gathered in one task, and a page far back costs no more than the first. Labels are fetched for the rows of the pages alone.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphprep.functions.text import tokens
from graphprep.operators import name_index
from graphprep.operators.lookup import hot_keys, salted_join, small_copy, unique_join
from graphprep.operators.name_index import GRAMS, WORD, NameIndex
from graphprep.workspace import stage

PAGE_BLOCK = 100
#: Rows of pages that are taken to the names.
BROADCAST_PAGES = 200_000


def word_index(names: DataFrame) -> DataFrame:
    """``(word, uri)`` for each distinct token of each name."""
    return names.select(F.explode(tokens(F.col("name"))).alias("word"), F.col("ent").alias("uri")).distinct()


class _Requests(NamedTuple):
    """Requests with ``question`` and ``_end``; ``few`` if their number was checked to be small."""

    rows: DataFrame
    few: bool

    @property
    def questions(self) -> DataFrame:
        """Distinct questions with the last rank asked for."""
        return self.rows.groupBy("question").agg(F.max("_end").alias("depth"))


def _ask(requests: DataFrame, question: Column) -> _Requests:
    copy = small_copy(requests)
    rows = requests if copy is None else copy
    valid = (F.col("limit") >= 0) & (F.col("offset") >= 0)
    end = F.when(valid, F.col("offset").cast("long") + F.col("limit")).otherwise(
        F.raise_error(F.lit("limit and offset must not be negative"))
    )
    return _Requests(rows.withColumns({"question": question, "_end": end}), copy is not None)


def _pages(asked: _Requests, index: NameIndex) -> DataFrame:
    """The pages that the requests ask for: ``(query_id, rank, value, label, size)``.

    Requests meet the ranks in blocks as wide as their own page, rounded up to ``PAGE_BLOCK`` times a power of two: a
    request reaches two blocks at most, whatever other requests ask for. A rank is given once for each width that is
    asked of its question.
    """
    matches = name_index.matches(asked.questions, index)
    width = F.greatest(F.lit(0), F.ceil(F.log2((F.col("_end") - F.col("offset")) / PAGE_BLOCK))).cast("int")

    def page(rank: Column) -> Column:
        return F.floor(rank / (F.pow(F.lit(2), F.col("_width")) * PAGE_BLOCK))

    wanted = asked.rows.where(F.col("_end") > F.col("offset")).withColumn("_width", width)
    widths = wanted.select(F.col("question").alias("_question"), "_width").distinct()
    # One row for each range of ids that a question has matches in.
    before = Window.partitionBy("question").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = matches.select("question", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"), F.sum("n").over(Window.partitionBy("question")).alias("size"))
    depths = asked.questions.withColumnRenamed("question", "_asked")
    lists = matches.join(starts, ["question", "range"]).join(depths, F.col("question") == F.col("_asked"))
    ids = F.slice("ids", F.lit(1), F.greatest(F.lit(0), F.least(F.col("n").cast("long"), F.col("depth") - F.col("_start"))).cast("int"))
    ranked = lists.select("question", "_start", "size", F.shiftleft(F.col("range").cast("long"), name_index.RANGE_BITS).alias("_base"), F.posexplode(ids).alias("_pos", "_low"))
    ranked = ranked.select("question", (F.col("_start") + F.col("_pos") + 1).cast("int").alias("rank"), (F.col("_base") + F.col("_low")).alias("id"), "size")
    ranked = ranked.join(widths, ranked["question"] == widths["_question"]).select(
        F.concat_ws(" ", "_width", page(F.col("rank") - 1), "question").alias("_ranked_page"), "rank", "id", "size"
    )
    pages = F.sequence(page(F.col("offset")), page(F.col("_end") - 1))
    turned = wanted.withColumn("_block", F.explode(pages))
    turned = turned.select("query_id", "offset", "_end", F.concat_ws(" ", "_width", "_block", "question").alias("_page"))
    hot = [] if asked.few else hot_keys(turned, "_page")
    found = salted_join(turned, ranked, "_page", "_ranked_page", hot)
    on_page = (F.col("rank") > F.col("offset")) & (F.col("rank") <= F.col("_end"))
    rows = stage(found.where(on_page).select("query_id", "rank", "id", "size"), "pages")
    named = index.entries.withColumnRenamed("id", "_named")
    if rows.count() <= BROADCAST_PAGES:
        shown = named.join(F.broadcast(rows), F.col("_named") == F.col("id"))
    else:
        shown = unique_join(rows, named, "id", "_named", hot=hot_keys(rows, "id"))
    return shown.select("query_id", "rank", "value", "label", "size")


def word_search(requests: DataFrame, names: DataFrame | NameIndex) -> DataFrame:
    """Names whose tokens include all tokens of the query, most frequent first: ``(query_id, rank, value, label, size)``.

    ``names`` are ``(name, ent, count)`` or their index (see ``name_index.write_word_index``).
    """
    question = F.concat_ws(" ", F.array_sort(F.array_distinct(tokens(F.col("query")))))
    index = names if isinstance(names, NameIndex) else name_index.scratch_index(names, WORD)
    return _pages(_ask(requests, question), index)


def substring_search(requests: DataFrame, labels: DataFrame | NameIndex) -> DataFrame:
    """``labels(uri, label)`` whose label holds the query, case folded, in ``uri`` order; an empty query matches all.

    ``labels`` may be their index (see ``name_index.write_label_index``).
    """
    index = labels if isinstance(labels, NameIndex) else name_index.scratch_index(labels, GRAMS)
    return _pages(_ask(requests, F.lower("query")), index)
