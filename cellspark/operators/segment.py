"""Steps: how a cell's samples are cut into steps, and what a step is summarised to.

Two segmentations exist. *Islands* are runs of equal ``(cycle_no, step_name)`` in time order.
*Numbered steps* collect all rows of one ``cycler_step_no``; a cell that carries no step numbers
falls back to runs of equal ``step_name``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.functions import chunked
from cellspark.functions.chunked import islands, step_bucket, whole_islands
from cellspark.functions.lineage import store
from cellspark.functions.scalar import MICROS, seconds_between

# Total time order: ties in time are settled by the measured values, so results never depend on row order.
TIME_ORDER = ["absolute_time", "cycler_step_no", "capacity_ah", "volt_v", "current_a"]
CHUNK_SECONDS = 3600


# Cell key inside the operators. The capacity is text here: Spark normalises floating-point keys in windows
# and joins but not in aggregates, so a double key would be shuffled again at every change between them.
KEYS = ["cell_no", "make", "batch", "cap"]
SAMPLE_COLS = ["cycle_no", "step_name", *TIME_ORDER]


# A missing text key; values that begin with it get one more, so it is never a value.
MISSING = "\x00"
TEXT_KEYS = ["cell_no", "make", "batch"]


def _marked(name: str) -> Column:
    value = F.col(name)
    return F.when(value.isNull(), MISSING).when(value.startswith(MISSING), F.concat(F.lit(MISSING), value)).otherwise(value).alias(name)


def _unmarked(name: str) -> Column:
    value = F.col(name)
    return F.when(value == MISSING, None).when(value.startswith(MISSING), F.substring(value, F.lit(2), F.length(value))).otherwise(value)


def with_keys(raw: DataFrame, *more: str) -> DataFrame:
    """Samples under non-null keys, without the columns no operator reads; ``more`` are kept too.

    A missing text key becomes a mark that no value can be, a missing capacity ``'NaN'``; ``restore_keys`` turns
    both back into null.
    """
    return raw.select(
        *[_marked(name) for name in TEXT_KEYS],
        F.coalesce((F.col("max_cap") + 0.0).cast("string"), F.lit("NaN")).alias("cap"),
        *SAMPLE_COLS,
        *more,
    )


def select_test(raw: DataFrame, *tests: str, any_case: bool = False) -> DataFrame:
    """Keyed samples of the given protocols."""
    name = F.upper("test") if any_case else F.col("test")
    return with_keys(raw.where(name.isin(*tests)))


def nominal() -> Column:
    """The nominal capacity as a number; exact, since a double's text form reads back as the same double."""
    return F.col("cap").cast("double")


def usable_capacity() -> Column:
    """True where the nominal capacity can be divided by: finite and positive."""
    return ~F.isnan(nominal()) & (nominal() > 0) & (nominal() < float("inf"))


def restore_keys(df: DataFrame) -> DataFrame:
    """The cell's own keys again, null where they were missing."""
    return df.withColumns({**{name: _unmarked(name) for name in TEXT_KEYS}, "max_cap": F.nanvl(nominal(), F.lit(None).cast("double"))}).drop("cap")


def chunk_of(time: str, chunk_seconds: int) -> Column:
    return F.coalesce(F.floor(F.unix_micros(time) / F.lit(chunk_seconds * MICROS)), F.lit(0))


def with_chunk(raw: DataFrame, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Add ``_chunk``, the time slice that bounds every row-level window.

    It is never null, which spares the joins on it a null filter that would keep equal shuffles apart.
    """
    return raw.withColumn("_chunk", chunk_of("absolute_time", chunk_seconds))


def cell_sizes(raw: DataFrame, keys: list[str], **more: Column) -> DataFrame:
    """One row per cell: ``_long``, whether it has more than ``STEP_BUCKET`` samples, and other aggregates."""
    return raw.groupBy(*keys).agg((F.count(F.lit(1)) > chunked.STEP_BUCKET).alias("_long"), *[agg.alias(name) for name, agg in more.items()])


def cell_islands(raw: DataFrame, keys: list[str], long: DataFrame, on: list[str], chunk_seconds: int) -> DataFrame:
    """``islands`` of each cell in time order, with ``_chunk``.

    A cell of few samples is one slice, whatever time it covers; those in ``long``, a stored table of keys, are cut by time.
    """
    if long.isEmpty():
        return whole_islands(raw, keys, TIME_ORDER, on).withColumn("_chunk", F.lit(0).cast("bigint"))
    few = whole_islands(raw.join(long, keys, "left_anti"), keys, TIME_ORDER, on).withColumn("_chunk", F.lit(0).cast("bigint"))
    many = islands(with_chunk(raw.join(long, keys, "left_semi"), chunk_seconds), keys, "_chunk", TIME_ORDER, on)
    return few.unionByName(many)


def over_chunks(steps: DataFrame, chunk_seconds: int) -> DataFrame:
    """Each step once per time slice from its start to its end, for steps that are short by definition."""
    first, last = (chunk_of(c, chunk_seconds) for c in ("start_time", "end_time"))
    return steps.withColumn("_chunk", F.explode(F.sequence(first, last)))


def with_part(rows: DataFrame) -> DataFrame:
    """Add ``_part``, the slice of a cell's samples by position that ``over_parts`` spreads steps over."""
    return rows.withColumn("_part", step_bucket("_idx"))


def over_parts(steps: DataFrame) -> DataFrame:
    """Each island once per ``_part`` that holds samples of it, however long the time between them."""
    last = F.floor((F.col("first_idx") + F.col("n_rows") - 1) / chunked.STEP_BUCKET)
    return steps.withColumn("_part", F.explode(F.sequence(step_bucket("first_idx"), last)))


def label_islands(
    raw: DataFrame,
    keys: list[str] = KEYS,
    on: tuple[str, ...] = ("cycle_no", "step_name"),
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Rows with ``_block`` (step number in time order) and ``_idx`` (row number in time order).

    Only long cells are stored and joined, so that the join can choose by their number.
    """
    long = store(cell_sizes(raw, keys).where("_long").drop("_long"))
    return cell_islands(raw, keys, long, list(on), chunk_seconds)


def first_by(value: str, order: Column) -> Column:
    """First non-null value along ``order``."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), order))


def last_by(value: str, order: Column) -> Column:
    return F.max_by(value, F.when(F.col(value).isNotNull(), order))


def island_steps(rows: DataFrame, keys: list[str] = KEYS, **extra: Column) -> DataFrame:
    """One row per island of ``label_islands`` output.

    Equal-length order keys (``_idx``) keep this a hash aggregate whose map side runs where the rows
    already are, so only step-sized rows are shuffled.
    """
    idx = F.col("_idx")
    steps = rows.groupBy(*keys, "_block", "cycle_no", "step_name").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("absolute_time").alias("start_time"),
        F.max("absolute_time").alias("end_time"),
        first_by("volt_v", idx).alias("start_volt_v"),
        last_by("volt_v", idx).alias("end_volt_v"),
        F.avg("current_a").alias("current_mean_a"),
        first_by("capacity_ah", idx).alias("_cap_start"),
        last_by("capacity_ah", idx).alias("_cap_end"),
        *[agg.alias(name) for name, agg in extra.items()],
    )
    return steps.withColumns(
        {
            "duration_s": seconds_between(F.col("start_time"), F.col("end_time")),
            "step_capacity_ah": F.abs(F.col("_cap_end") - F.col("_cap_start")),
        }
    ).drop("_cap_start", "_cap_end")


def number_rows(raw: DataFrame, keys: list[str] = KEYS, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Rows with ``_step_no``: the native step number, or the name-run number in cells that have none.

    Cells with native numbers need no ordering at all, so only the others go through the windows. Rows
    without a number in a cell that has some are dropped. The cells without numbers are stored, one row each,
    so that the join of their samples can choose by their number.
    """
    numbered = F.col("cycler_step_no").isNotNull()
    plain = store(cell_sizes(raw, keys, _native=F.max(numbered)).where(~F.col("_native")).drop("_native"))
    unnumbered = raw.where(~numbered).join(plain.drop("_long"), keys, "left_semi")
    by_name = cell_islands(unnumbered, keys, plain.where("_long").drop("_long"), ["step_name"], chunk_seconds)
    return raw.where(numbered).withColumn("_step_no", F.col("cycler_step_no").cast("long")).unionByName(
        by_name.withColumn("_step_no", F.col("_block").cast("long")).drop("_block", "_idx", "_chunk")
    )


def numbered_steps(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """One row per numbered step of ``number_rows`` output.

    Samples are sorted by step on both sides of the exchange; a leading hash of the step decides most comparisons.
    """
    order = F.struct(*TIME_ORDER)
    return (
        rows.groupBy(F.xxhash64(*keys, "_step_no").alias("_hash"), *keys, "_step_no")
        .agg(
            first_by("step_name", order).alias("step_name"),
            first_by("cycle_no", order).alias("cycle_no"),
            F.count("volt_v").alias("n_samples"),
            F.min("absolute_time").alias("t_start"),
            F.max("absolute_time").alias("t_end"),
            first_by("volt_v", order).alias("v_first"),
            last_by("volt_v", order).alias("v_last"),
            F.avg(F.abs("current_a")).alias("i_abs_mean"),
            F.avg("current_a").alias("i_mean"),
            F.max(F.abs("capacity_ah")).alias("q_max"),
        )
        .drop("_hash")
        .withColumn("duration_s", seconds_between(F.col("t_start"), F.col("t_end")))
    )
