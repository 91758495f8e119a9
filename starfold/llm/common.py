"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.session import prepare, scratch_dir

# Runs of white space as every contract here understands it.
SPACES = r"[ \t-\r]+"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written once to the shared folder and read back.

    Cuts the lineage with files that outlive a lost executor, so that later steps read the same rows.
    """
    path = scratch_dir(frame.sparkSession, f"llm-{label}")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(name), F.lit(""))


def id_text(name: str = "doc_id") -> Column:
    """An id as a text that is never null: an empty one stands for null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``frame`` has no such column, whatever its case."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _keyed(docs: DataFrame, chosen: DataFrame, mark: Column) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the key (doc_id, mark) under names that ``docs`` does not have."""
    names = [free_name(docs, "id_key"), free_name(docs, "mark_key")]
    keyed = docs.withColumns({names[0]: id_text(), names[1]: mark})
    return keyed, chosen.select(F.col("id_key").alias(names[0]), F.col("mark_key").alias(names[1])), names


def retain(docs: DataFrame, chosen: DataFrame, mark: Column) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, mark) is in ``chosen`` (``id_key``, ``mark_key``), each once.

    ``mark`` tells rows of one id apart, so a repeated row stays once and a repeated id keeps its other texts.
    """
    keyed, chosen, names = _keyed(docs, chosen, mark)
    return keyed.join(chosen, names, "left_semi").dropDuplicates(names).select(*docs.columns)


def without(docs: DataFrame, refused: DataFrame, mark: Column) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, mark) is not in ``refused`` (``id_key``, ``mark_key``)."""
    keyed, refused, names = _keyed(docs, refused, mark)
    return keyed.join(refused, names, "left_anti").select(*docs.columns)


def drawn(share: Column, *by: str) -> Column:
    """Whether a row is in a draw of about ``share`` (0 to 1) of all rows, decided by a 62-bit hash of ``by``.

    The same rows are drawn wherever they lie, and no share above 1e-18 is taken for zero.
    """
    return F.pmod(F.xxhash64(*by, F.lit("draw")), F.lit(1 << 62)) < (share * F.lit(float(1 << 62))).cast("long")


__all__ = ["SPACES", "drawn", "free_name", "id_text", "prepare", "retain", "stored", "whole_text", "without"]
