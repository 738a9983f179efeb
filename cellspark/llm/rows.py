"""Rows that pass through Python tasks with their texts, and rows that meet a table of their keys."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Taken only if the text is not one of the columns kept.
TEXT = "text_beside_row"

#: A key with more than this part of all rows is broadcast; there are fewer such keys.
HEAVY = 1024


def meet(rows: DataFrame, counted: DataFrame, keys: list[str], count: str, apart: list[str], counts: DataFrame | None = None) -> DataFrame:
    """``rows`` whose key is in ``counted``, with its other columns as a struct ``met``.

    ``counted`` has one row a key, never null; its column ``count`` says how many of ``rows`` have it (``counts``
    is a stored table of the same counts where ``counted`` is not one). Rows of keys with more than 1 / HEAVY of
    the total, fewer than HEAVY keys whatever the size, take their struct from a broadcast and are dealt by the
    columns ``apart``; the others meet their key in a shuffle. So no task gets more than that part of the rows
    through one key.
    """
    total = (counted if counts is None else counts).agg(F.sum(count)).first()[0] or 0
    small = counted.select(*keys, F.struct(*[c for c in counted.columns if c not in keys]).alias("met"))
    heavy = small.where(F.col("met")[count] * HEAVY > total).withColumnRenamed("met", "heavy")
    # the rows of a heavy key go on under other hashes and find no second partner
    spread = F.when(F.col("heavy").isNull(), F.xxhash64(*keys)).otherwise(F.xxhash64(*keys, *apart))
    dealt = rows.join(F.broadcast(heavy), keys, "left").withColumn("spread", spread)
    met = dealt.join(small.withColumn("spread", F.xxhash64(*keys)), [*keys, "spread"], "left")
    return met.withColumn("met", F.coalesce("heavy", "met")).where(F.col("met").isNotNull()).select(*rows.columns, "met")


def packed(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """(row: struct of the columns ``keep``) and, if it is not a string among them, the text."""
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).cast("string").alias(TEXT))
    return rows.drop(TEXT) if text in keep and docs.schema[text].dataType.simpleString() == "string" else rows


def texts(batch: pa.RecordBatch, text: str) -> list[bytes | None]:
    """The texts of a batch of packed rows, in UTF-8."""
    column = batch.column(TEXT) if TEXT in batch.schema.names else batch.column("row").field(text)
    return column.cast(pa.binary()).to_pylist()
