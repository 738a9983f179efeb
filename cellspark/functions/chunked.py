"""Ordered operators over groups of any size.

A plain window over one cell sorts that whole cell in one task. When a single cell holds a large
share of the lake this is the task the job waits for. The functions here compute the same ordered
results in two levels instead: a window inside (key, bucket), where a bucket is a bounded slice of
the order, and a window over one summary row per bucket, whose carry is joined back. No task ever
holds more than one bucket of rows, or one key's bucket summaries.

``bucket`` must be monotone in ``order``: every row of a lower bucket sorts before every row of a
higher one. Key columns must be neither null nor floating-point (see ``operators.segment.with_keys``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspark.functions.lineage import store

STEP_BUCKET = 4096
#: Bits of a value's order key that one round of the median's selection tells apart.
DIGIT_BITS = 16


def step_bucket(col: str) -> Column:
    """Bucket of a step ordinal: at most ``STEP_BUCKET`` distinct ordinals each."""
    return F.coalesce(F.floor(F.col(col) / STEP_BUCKET), F.lit(0))


def _local(keys: list[str], bucket: str, order: list) -> Window:
    return Window.partitionBy(*keys, bucket).orderBy(*order)


def _all_equal(pairs) -> Column:
    return reduce(lambda a, b: a & b, [left.eqNullSafe(right) for left, right in pairs])


def _numbered_runs(df: DataFrame, local: Window, on: list[str]) -> DataFrame:
    """Add ``_rn``, the row's position in the window, and ``_li``, the number of its run of equal ``on`` values there."""
    same = _all_equal((F.col(c), F.lag(c).over(local)) for c in on)
    return (
        df.withColumn("_rn", F.row_number().over(local))
        .withColumn("_new", F.when(F.col("_rn") == 1, 1).when(same, 0).otherwise(1))
        .withColumn("_li", F.sum("_new").over(local.rowsBetween(Window.unboundedPreceding, 0)))
    )


def whole_islands(df: DataFrame, keys: list[str], order: list[str], on: list[str]) -> DataFrame:
    """``islands`` of keys that have few rows each: one window over a key, and nothing to join back."""
    rows = _numbered_runs(df, Window.partitionBy(*keys).orderBy(*order), on)
    return rows.withColumns({"_idx": F.col("_rn").cast("bigint"), "_block": F.col("_li")}).drop("_rn", "_new", "_li")


def islands(df: DataFrame, keys: list[str], bucket: str, order: list[str], on: list[str]) -> DataFrame:
    """Number the runs of equal ``on`` values along ``order``.

    Adds ``_idx``, the 1-based position of the row within its key, and ``_block``, the 1-based run
    number. Null compares equal to null.
    """
    local = _local(keys, bucket, order)
    rows = _numbered_runs(df, local, on)

    along = Window.partitionBy(*keys).orderBy(bucket)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.withColumn("_next", F.lead(F.lit(1)).over(local)).where((F.col("_rn") == 1) | F.col("_next").isNull())
    carry = (
        ends.groupBy(*keys, bucket)
        .agg(
            F.max("_rn").alias("_rows"),
            F.max("_li").alias("_runs"),
            F.min_by(F.struct(*on), "_rn").alias("_first"),
            F.max_by(F.struct(*on), "_rn").alias("_last"),
        )
        .withColumn("_joined", F.col("_first").eqNullSafe(F.lag("_last").over(along)).cast("long"))
        .select(
            *keys,
            bucket,
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row_base"),
            (F.coalesce(F.sum(F.col("_runs") - F.col("_joined")).over(before), F.lit(0)) - F.col("_joined")).alias(
                "_run_base"
            ),
        )
    )
    return (
        rows.join(carry, [*keys, bucket])
        .withColumn("_idx", F.col("_row_base") + F.col("_rn"))
        .withColumn("_block", F.col("_run_base") + F.col("_li"))
        .drop("_rn", "_new", "_li", "_row_base", "_run_base")
    )


def neighbours(
    df: DataFrame, keys: list[str], order: str, cols: list[str], before: str | None = None, after: str | None = None
) -> DataFrame:
    """Attach the previous (``before``) and / or next (``after``) row along ``order`` as a struct of ``cols``.

    ``order`` is an integer column, unique within the keys, gaps allowed. The struct is null at the ends.
    """
    rows = df.withColumn("_bucket", step_bucket(order))
    local = _local(keys, "_bucket", [order])
    along = Window.partitionBy(*keys).orderBy("_bucket")
    payload = F.struct(*cols)

    carry = rows.groupBy(*keys, "_bucket").agg(
        F.min_by(payload, order).alias("_first"), F.max_by(payload, order).alias("_last")
    )
    wanted = []
    if before:
        rows = rows.withColumn(before, F.lag(payload).over(local))
        wanted.append(F.lag("_last").over(along).alias("_before"))
    if after:
        rows = rows.withColumn(after, F.lead(payload).over(local))
        wanted.append(F.lead("_first").over(along).alias("_after"))
    rows = rows.join(carry.select(*keys, "_bucket", *wanted), [*keys, "_bucket"])
    if before:
        rows = rows.withColumn(before, F.coalesce(before, "_before"))
    if after:
        rows = rows.withColumn(after, F.coalesce(after, "_after"))
    return rows.drop("_bucket", "_before", "_after")


def ordinal(df: DataFrame, keys: list[str], bucket: str, order: list[str], out: str) -> DataFrame:
    """Number the rows 1..n along ``order`` within the keys; ``bucket`` is the leading order column."""
    rows = df.withColumn("_bucket", step_bucket(bucket))
    along = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        rows.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, "_bucket", F.coalesce(F.sum("_rows").over(along), F.lit(0)).alias("_base"))
    )
    return (
        rows.withColumn("_rn", F.row_number().over(_local(keys, "_bucket", order)))
        .join(carry, [*keys, "_bucket"])
        .withColumn(out, (F.col("_base") + F.col("_rn")).cast("int"))
        .drop("_bucket", "_base", "_rn")
    )


def order_key(value: Column) -> Column:
    """The 64-bit whole number that orders doubles: exponent and fraction bits, negated below zero; both zeros are 0.

    NaN comes last, null stays null. Every step is exact: powers of two, a division by one, and differences of neighbours in size.
    """
    two, least = F.lit(2.0), F.lit(-1022.0)
    size = F.when(F.abs(value) < float("inf"), F.abs(value)).otherwise(1.0)
    guess = F.greatest(least, F.floor(F.log2(size)).cast("double"))
    # the logarithm is rounded, so next to a power of two it may be off by one
    exponent = F.greatest(least, guess + F.when(F.pow(two, guess) > size, -1.0).when(F.pow(two, guess + 1) <= size, 1.0).otherwise(0.0))
    fraction = size / F.pow(two, exponent)  # from 1 up to 2; below 1 for the smallest numbers
    bits = (exponent + 1022).cast("bigint") * (1 << 52) + (fraction * float(1 << 52)).cast("bigint")
    whole = F.when(F.abs(value) == float("inf"), F.lit(2047 << 52)).when(size == 0, F.lit(0)).otherwise(bits)
    return F.when(value.isNull(), None).when(F.isnan(value), F.lit((2047 << 52) + 1)).when(value < 0, -whole).otherwise(whole)


def order_value(key: Column) -> Column:
    """The double of an ``order_key``; exact, as every step of it is."""
    size, two = F.abs(key), F.lit(2.0)
    exponent, fraction = F.shiftright(size, 52), size.bitwiseAND(F.lit((1 << 52) - 1))
    whole = F.when(exponent == 0, fraction).otherwise(fraction + F.lit(1 << 52)).cast("double")
    finite = whole * F.pow(two, F.greatest(exponent, F.lit(1)).cast("double") - 1075.0)
    value = F.when(exponent < 2047, finite).when(fraction == 0, float("inf")).otherwise(float("nan"))
    return F.when(key < 0, -value).otherwise(value)


def exact_median(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Exact median of ``value`` per key by radix selection, without holding a key's values in one task.

    Equal values are counted first, before they move, and stored, since every round starts from these counts. They are
    added up by the leading 48, 32 and 16 bits of the values' order keys. From the coarsest table on, the digits that hold the middle ranks are looked up, and only what
    lies below them in the next table: a window or a join key never has more than 2^16 rows, however close the values
    are. Null values are ignored.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, order_key(F.col(value)).alias("_key")).agg(F.count(F.lit(1)).alias("_cnt"))
    finest = store(counts)
    levels = [finest.withColumn("_above", F.shiftright("_key", DIGIT_BITS))]
    for _ in range(64 // DIGIT_BITS - 1):
        up = levels[-1].groupBy(*keys, F.col("_above").alias("_key")).agg(F.sum("_cnt").alias("_cnt"))
        levels.append(up.withColumn("_above", F.shiftright("_key", DIGIT_BITS)))

    whole = Window.partitionBy(*keys)
    upto = F.sum("_cnt").over(whole.orderBy("_key").rowsBetween(Window.unboundedPreceding, 0))
    ranked = levels.pop().withColumns({"_upto": upto, "_n": F.sum("_cnt").over(whole)}).withColumns(
        {"_low": F.floor((F.col("_n") + 1) / 2), "_high": F.floor((F.col("_n") + 2) / 2)}
    )
    holds = (F.col("_upto") - F.col("_cnt") < F.col("_high")) & (F.col("_upto") >= F.col("_low"))
    while levels:
        held = ranked.where(holds).select(*keys, F.col("_key").alias("_above"), (F.col("_upto") - F.col("_cnt")).alias("_before"), "_low", "_high")
        inside = Window.partitionBy(*keys, "_above").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
        ranked = levels.pop().join(held, [*keys, "_above"]).withColumn("_upto", F.col("_before") + F.sum("_cnt").over(inside))
    return ranked.where(holds).groupBy(*keys).agg(((order_value(F.min("_key")) + order_value(F.max("_key"))) / 2).alias(out))
