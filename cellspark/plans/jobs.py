"""One job per protocol: raw rows in, a partitioned result table out; and the merge of those tables."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark import schemas
from cellspark.operators.cycles import aggregate_per_cycle
from cellspark.operators.dcir import extract_dcir_anchors
from cellspark.operators.gitt import extract_gitt_pulses
from cellspark.operators.hppc import detect_hppc_pulses
from cellspark.operators.ocv import extract_ocv_curves
from cellspark.operators.power import extract_constant_power, extract_peak_power
from cellspark.operators.rate import extract_rate_capability
from cellspark.operators.self_discharge import extract_self_discharge
from cellspark.plans import wide
from cellspark.sources.tables import read_test_table, write_test_table


class Job(NamedTuple):
    table: str
    compute: Callable[[DataFrame], DataFrame]
    schema: T.StructType


def _cycles_of(test: str) -> Callable[[DataFrame], DataFrame]:
    return lambda raw: aggregate_per_cycle(raw.where(F.col("test") == test))


# Job names and output tables.
JOBS = {
    "hppc": Job("HPPC", detect_hppc_pulses, schemas.PULSE),
    "ocv": Job("OCV", extract_ocv_curves, schemas.OCV),
    "dcir": Job("DCIR", extract_dcir_anchors, schemas.DCIR),
    "gitt": Job("GITT", extract_gitt_pulses, schemas.GITT),
    "rate_cap": Job("RATE_CAP", extract_rate_capability, schemas.RATE),
    "self_discharge": Job("SELF_DISCHARGE", extract_self_discharge, schemas.SELF_DISCHARGE),
    "peak_power": Job("PEAK_POWER", extract_peak_power, schemas.PEAK_POWER),
    "constant_power": Job("CONSTANT_POWER", extract_constant_power, schemas.CONSTANT_POWER),
    "cycles_long": Job("CYCLES_LONG", _cycles_of("Longterm"), schemas.CYCLE),
    "cycles_rpt": Job("CYCLES_RPT", _cycles_of("RPT"), schemas.CYCLE),
}


def run_job(raw: DataFrame, name: str, output: str) -> None:
    """Compute one protocol and write its table below ``output``."""
    job = JOBS[name]
    write_test_table(job.compute(raw), f"{output}/{job.table}")


def run_all(raw: DataFrame, output: str) -> None:
    for name in JOBS:
        run_job(raw, name, output)


def consolidate(spark: SparkSession, output: str, chemistry: str = wide.CHEMISTRY) -> DataFrame:
    """One wide row per cell from the tables below ``output``; columns only raw data can give stay null."""

    def table(name: str) -> DataFrame:
        job = JOBS[name]
        try:
            return read_test_table(spark, f"{output}/{job.table}", job.schema)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return spark.createDataFrame([], job.schema)

    capacity = (
        table("cycles_rpt")
        .groupBy(*schemas.CELL_KEYS)
        .agg(F.max("dchg_cap_ah").alias("q_rpt_ah"), F.max("chg_cap_ah").alias("q_rpt_chg_ah"))
    )
    parts = [
        wide.hppc_curves(table("hppc")),
        wide.ocv_arrays(table("ocv")),
        wide.dcir_arrays(table("dcir")),
        wide.gitt_arrays(table("gitt")),
        wide.rate_arrays(table("rate_cap")),
        wide.power_arrays(table("constant_power")),
        wide.peak_arrays(table("peak_power")),
        wide.self_discharge_columns(table("self_discharge")),
        capacity,
    ]
    keys = [part.select(*schemas.CELL_KEYS) for part in parts] + [table("cycles_long").select(*schemas.CELL_KEYS)]
    cells = keys[0]
    for more in keys[1:]:
        cells = cells.unionByName(more)
    return wide.assemble(cells.distinct(), parts, chemistry)
