"""Energy and voltage range of a cycle.

A step's energy is the integral of its power over time, by trapezoids between neighbouring samples however far apart
they are. The integral is taken in slices of time: a slice's summary is its own trapezoids, its first and its last
sample, and two neighbouring summaries are joined by the trapezoid between them. So a step may be as long as a cell's
whole history without a task holding more than a slice of its samples, and the width of a slice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspark.functions.scalar import MICROS
from cellspark.operators.cycles import aggregate_per_cycle, moves_of, step_of
from cellspark.operators.segment import CHUNK_SECONDS, TIME_ORDER, with_chunk
from cellspark.schemas import CELL_KEYS, CYCLE, CYCLE_ENERGY, shape

SECONDS_PER_HOUR = 3600.0


def trapezoid(since: Column, power_then: Column, now: Column, power_now: Column) -> Column:
    """Watt seconds between two samples; times in microseconds."""
    return (now - since) / F.lit(float(MICROS)) * (power_then + power_now) / 2


def power_integrals(rows: DataFrame, keys: list[str], chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """(keys, ``energy_ws``, ``top``, ``bottom``): integral of volt times absolute current, and the voltage range.

    Samples without a voltage or a current are no corners of the integral; a group without any such sample has a null
    energy, one with a single sample 0.
    """
    power = F.col("volt_v") * F.abs("current_a")
    rows = with_chunk(rows, chunk_seconds).withColumns({"_p": power, "_t": F.unix_micros("absolute_time")})
    rows = rows.withColumn("_corner", F.col("_p").isNotNull() & F.col("_t").isNotNull())
    along = Window.partitionBy(*keys, "_chunk", "_corner").orderBy(*TIME_ORDER)
    inside = rows.withColumns(
        {"_rn": F.row_number().over(along), "_area": trapezoid(F.lag("_t").over(along), F.lag("_p").over(along), F.col("_t"), F.col("_p"))}
    )
    order = F.when(F.col("_corner"), F.col("_rn"))
    slices = inside.groupBy(*keys, "_chunk").agg(
        F.sum(F.when(F.col("_corner"), F.coalesce("_area", F.lit(0.0)))).alias("_area"),
        *[F.min_by(c, order).alias(f"{c}_first") for c in ("_t", "_p")],
        *[F.max_by(c, order).alias(f"{c}_last") for c in ("_t", "_p")],
        F.max("volt_v").alias("_top"),
        F.min("volt_v").alias("_bottom"),
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    since, then = (F.last(c, ignorenulls=True).over(before) for c in ("_t_last", "_p_last"))
    bridged = slices.withColumn("_bridge", trapezoid(since, then, F.col("_t_first"), F.col("_p_first")))
    return bridged.groupBy(*keys).agg(
        F.sum(F.col("_area") + F.coalesce("_bridge", F.lit(0.0))).alias("energy_ws"), F.max("_top").alias("top"), F.min("_bottom").alias("bottom")
    )


def cycle_energy(raw: DataFrame, by_test: bool = False, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """One row per (cell, cycle): energy charged and discharged in watt hours, and the voltage range while moving.

    Steps are told apart as in ``aggregate_per_cycle``, so time between two steps is in no integral.
    """
    keys = (["test"] if by_test else []) + CELL_KEYS
    moving = raw.select(*keys, "cycle_no", *TIME_ORDER, moves_of().alias("moves"), step_of().alias("step")).where("moves is not null")
    steps = power_integrals(moving, [*keys, "cycle_no", "moves", "step"], chunk_seconds)

    def taken(moves: str) -> Column:
        return F.sum(F.when(F.col("moves") == moves, F.col("energy_ws"))) / SECONDS_PER_HOUR

    cycles = steps.groupBy(*keys, "cycle_no").agg(
        taken("in").alias("chg_energy_wh"), taken("out").alias("dchg_energy_wh"), F.max("top").alias("v_max"), F.min("bottom").alias("v_min")
    )
    return cycles if by_test else shape(cycles, CYCLE_ENERGY)


def cycles_with_energy(raw: DataFrame, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """``aggregate_per_cycle`` and ``cycle_energy`` in one row a cycle; null keys meet like others."""
    keys = [*CELL_KEYS, "cycle_no"]
    both = aggregate_per_cycle(raw).unionByName(cycle_energy(raw, chunk_seconds=chunk_seconds), allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.any_value(c, True).alias(c) for c in both.columns if c not in keys])
