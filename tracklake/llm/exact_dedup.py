"""Exact duplicates by distributed most-significant-digit radix partitioning.

A digit is a run of the text's next bytes. Each round splits every open group by its members' next
digit; a group that is a single row, or whose members all ended within the digit, is closed. Digits
grow eightfold from round to round, so a text of any length takes a few rounds, and after the first
round only texts that share their first bytes with another still travel. Texts are compared byte for
byte: no digest decides equality.

Counting a group is a partial and a final aggregation, so a group of any size meets as one row a task;
going back from groups to rows is a sort-merge join, whose large partitions Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard, external_id, has_columns, internal_id, keyed

FIRST_DIGIT, GROWTH = 256, 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text):
    """Lower-cases A-Z only; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def _split(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Adds each row's group of this round: its best row, its size, and whether it is closed."""
    rows = rows.withColumn("digit", F.expr(f"substring(rest, 1, {width})"))
    best = F.max(F.struct("id", "row"))
    groups = rows.groupBy(*keys, "digit").agg(best.alias("best"), F.count(F.lit(1)).alias("size"), F.min("row").alias("group_row"))
    closed = (F.col("size") == 1) | (F.octet_length("digit") < width)
    return rows.join(groups.withColumn("closed", closed), [*keys, "digit"])


def duplicates(docs: DataFrame, first_digit: int = FIRST_DIGIT, growth: int = GROWTH, key: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256; and `key`, if a column is named.

    Texts are equal when identical after lower-casing A-Z; null text equals empty text. The row with
    the largest doc_id stays, and of rows that repeat that doc_id in one group just one. A null doc_id
    counts as smaller than any other, so keep_id is null only if the whole group has no ids. An empty
    table gives no rows; other columns are ignored, whatever their names. A text of any length is compared whole. A key
    is a value that tells a row wherever docs is read again, and can be put in order.
    """
    has_columns(docs, "doc_id", "text")
    rows = docs.select(internal_id().alias("id"), F.col(key).alias("row"), "text") if key else keyed(docs.select(internal_id().alias("id"), "text"))
    rows = rows.select("id", "row", normalised(F.col("text")).alias("norm"))
    rows = rows.select("id", "row", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), F.col("norm").cast("binary").alias("rest"))
    done, keys, width, before = [], [], first_digit, None
    answer = ["id", "row", "best", "size", "text_sha256"]
    while True:
        split = _split(rows, keys, width)
        open_rest = F.when(~F.col("closed"), F.expr(f"substring(rest, {width + 1})"))
        # After the first round a group is told by its smallest row number, before it by its first digit.
        told = F.when(~F.col("closed"), F.col("digit")) if not keys else F.col("group_row")
        level = cut(split.select(*answer, "closed", told.alias("group"), open_rest.alias("rest")), "closed")
        if before is not None:
            discard(before, "closed=false")
        done.append(level.where("closed").select(*answer))
        rows = level.where("not closed").select("id", "row", "text_sha256", "group", "rest")
        if rows.isEmpty():
            break
        keys, width, before = ["group"], width * growth, level
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    keep = F.col("best.id")
    return out.select(
        external_id(F.col("id")).alias("doc_id"),
        external_id(keep).alias("keep_id"),
        F.col("size").alias("group_size"),
        ((F.col("id") == keep) & (F.col("row") == F.col("best.row"))).alias("kept"),
        "text_sha256",
        *([F.col("row").alias(key)] if key else []),
    )


ORACLE = f"""
with n as (select doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as norm from documents),
g as (select norm, max(doc_id) as keep_id, count(*) as group_size from n group by norm)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256
from n join g using (norm)
"""
