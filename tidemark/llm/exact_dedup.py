"""Exact duplicates: group by a 128-bit content hash, keep one id, compare bytes inside groups.

The hash groups come from one aggregation on (hash, text): its map side leaves one row per distinct
text and task, however many copies there are, and its grouping compares the bytes. A second, narrow
aggregation on the hash alone counts the different texts behind each hash. Only where that count
is above one (a collision) does the verdict of a row need its text again; all other rows find
their group by the hash, so no text travels to them.

Null texts count as empty. Null ids never become the kept id unless all ids of a group are null.
Rows that repeat both id and text are the same document listed twice and share its verdict. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import fresh, text_of
from tidemark.session import checkpoint_root


def content_hash(text: Column) -> Column:
    """128 bits of content hash."""
    return F.unhex(F.md5(text))


def duplicate_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    digest: Callable[[Column], Column] = content_hash,
    carry: dict[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, then ``carry``.

    ``keep`` is ``min`` or ``max``: which id of a group of equal texts stays. ``carry`` maps the
    name of a further output column to an expression of the (null-free) text.
    """
    if keep not in ("min", "max"):
        raise ValueError(f"keep is min or max, not {keep!r}")
    checkpoint_root(docs.sparkSession)
    pick = F.min if keep == "min" else F.max
    carry = carry or {}
    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text")).withColumn("_h", digest(F.col("text")))

    def by_text(part: DataFrame) -> DataFrame:
        return part.groupBy("_h", "text").agg(pick("id").alias("keep_id"), F.count("*").alias("group_size"))

    groups = (
        by_text(rows).groupBy("_h")
        .agg(F.count("*").alias("texts"), pick("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        .checkpoint()
    )
    extra = [make(F.col("text")).alias(name) for name, make in carry.items()]
    result = ["id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), *carry]
    # The groups were read from a checkpoint, so both sides get an exchange and AQE can split a hot hash.
    found = rows.select("id", "_h", *extra).join(groups.filter("texts = 1"), "_h").select(*result)
    collided = groups.filter("texts > 1").select("_h")
    if not collided.isEmpty():
        apart = rows.join(collided, "_h", "left_semi")
        found = found.unionByName(apart.select("id", "_h", "text", *extra).join(by_text(apart).checkpoint(), ["_h", "text"]).select(*result))
    return found.withColumnRenamed("id", id_col)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of ``docs`` whose text no kept row has already; all columns of ``docs`` stay.

    Rows are picked by (id, hash), not by id alone: an id that several different texts carry
    keeps each of them that stays. Of rows that repeat both id and text, and of equal texts that all lack
    an id, the one whose columns hash lowest stays.
    """
    key, h, row = fresh(docs, "kept_id", "kept_hash", "kept_row")
    verdicts = duplicate_groups(docs, id_col, text_col, keep, carry={"h": content_hash})
    losers = verdicts.filter(~F.col("kept")).select(F.col(id_col).alias(key), F.col("h").alias(h)).distinct()
    hashed = docs.withColumn(h, content_hash(text_of(docs, text_col)))
    kept = hashed.join(losers, hashed[id_col].eqNullSafe(losers[key]) & (hashed[h] == losers[h]), "left_anti")
    repeated = verdicts.filter("kept").groupBy(F.col(id_col).alias(key), F.col("h").alias(h)).count().filter("count > 1").drop("count").checkpoint()
    if repeated.isEmpty():
        return kept.drop(h)
    again = kept[id_col].eqNullSafe(repeated[key]) & (kept[h] == repeated[h])
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # The rows are reduced on the map side, so a row that repeats without end meets as one row a task.
    one = kept.join(repeated, again, "left_semi").withColumn(row, whole).groupBy(F.col(f"`{id_col}`").alias(key), h).agg(
        F.min_by(row, F.xxhash64(F.to_json(row))).alias(row)
    )
    return kept.join(repeated, again, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(one.select(f"{row}.*"))
