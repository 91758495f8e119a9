"""Exact deduplication with a heavy-hitter split.

A Misra-Gries summary (Spark's ``freqItems``) names every digest that may hold more than one in
``counters`` rows. Those candidates are counted exactly; the winners, at most ``counters`` rows, are
broadcast and their copies are resolved where they lie. The other digests are shuffled; none of them
can hold more than one in ``counters`` rows, so no task gets a hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.common import SPACES, id_text, retain, stored, whole_text

COUNTERS = 1000


def digest(text: str = "text") -> Column:
    """SHA-256 of the text with each run of white space as one space; null counts as empty."""
    return F.sha2(F.regexp_replace(whole_text(text), SPACES, " "), 256)


def heavy_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digests that hold more than one in ``counters`` rows, with exact size and first row.

    The summary has at most ``counters`` candidates and misses none; the exact count drops the rest.
    """
    candidates = digests.stat.freqItems(["text_sha256"], 1 / counters)
    candidates = candidates.select(F.explode("text_sha256_freqItems").alias("text_sha256")).distinct()
    counted = digests.join(F.broadcast(candidates), "text_sha256").groupBy("text_sha256")
    verified = counted.agg(F.count("*").alias("size"), F.min("place").alias("first"))
    return stored(verified.where("size > 1"), "heavy")


def duplicate_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest doc_id stays; null ids come last, and of repeated rows
    exactly one stays. Null texts count as empty. An empty table gives an empty result. Other columns of
    ``docs`` are not read. Texts of any length are only digested; no text is shuffled.
    """
    rows = docs.select("doc_id", digest().alias("text_sha256"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    digests = stored(rows.select("text_sha256", place.alias("place")), "digests")
    heavy = heavy_digests(digests, counters)

    split = digests.join(F.broadcast(heavy), "text_sha256", "left")
    hot = split.where("size is not null")
    group = Window.partitionBy("text_sha256")
    rest = split.where("size is null").select("text_sha256", "place")
    rest = rest.withColumns({"size": F.count("*").over(group), "first": F.min("place").over(group)})
    return hot.select(*rest.columns).unionByName(rest).select(
        F.col("place.doc_id").alias("doc_id"),
        F.col("first.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("place.row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs``, all columns, with one row for each distinct text.

    Null and empty texts are one text. Of repeated rows one stays, also where ids are null. An empty table stays empty.
    """
    kept = duplicate_groups(docs, counters).where("kept")
    chosen = kept.select(id_text().alias("id_key"), F.col("text_sha256").alias("mark_key"))
    return retain(docs, chosen, digest())
