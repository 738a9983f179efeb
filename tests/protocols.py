"""Test protocols as literal step programs, and the telemetry a fleet running them would produce.

A fleet is any table with one row per cell (an integer id, a group number and a small per-cell
figure); every cell runs every program. Samples come from a closed form, so another engine can
produce the same rows from the same programs.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPOCH_MS = 1_704_067_200_000  # 2024-01-01T00:00:00Z
DAY_MS = 86_400_000


@dataclass(frozen=True)
class Segment:
    """``n + 1`` samples, ``dt_ms`` apart, of one step (or of a part of one)."""

    test: str
    cycle_no: int
    step_no: int
    step_name: str
    start_ms: int
    n: int
    dt_ms: int
    i_c: float  # current as a multiple of max_cap
    c0: float  # capacity at the first sample, as a fraction of max_cap
    v0: float
    a: float
    tau: float
    noise: float
    crate: str | None
    drate: str | None
    null_at: int  # index of a sample with no voltage, or -1


class Program:
    """Builds the segments of one protocol, keeping time, step and capacity counters."""

    def __init__(self, test: str, first_day: int):
        self.test, self.ms, self.step, self.cycle = test, EPOCH_MS + first_day * DAY_MS, 0, 1
        self.cap, self.segments = 0.0, []

    def add(
        self, name, n, dt, i=0.0, v0=3.3, a=0.0, tau=100.0, more=False, noise=0.0, crate=None, drate=None, null_at=-1
    ):
        """A step of ``n`` intervals of ``dt`` seconds; ``more`` continues the previous step."""
        if not more:
            self.step, self.cap = self.step + 1, 0.0
        dt_ms = round(dt * 1000)
        self.segments.append(
            Segment(
                self.test, self.cycle, self.step, name, self.ms, n, dt_ms, i, self.cap, v0, a, tau, noise, crate,
                drate, null_at,
            )
        )
        self.ms += n * dt_ms + 1000
        self.cap += i * n * dt / 3600
        return self

    def burst(self, name, n, dt, i, v0):
        """A part of the running step that follows its last sample after exactly ``dt``."""
        self.ms += round(dt * 1000) - 1000
        return self.add(name, n, dt, i, v0, more=True)


def _hppc() -> Program:
    p = Program("HPPC", 0)
    for k, tau in enumerate([1.5, 2.0, 3.0, 20.0, 1.0, 2.5, 40.0, 0.8, 5.0]):
        p.cycle = 1 + k // 3
        p.add("Rest", 60, 60, v0=3.40 - 0.01 * k, a=0.004, tau=500)
        p.add("CC_DChg", 30, 1, -1.0, 3.30 - 0.01 * k, -0.05, tau, null_at=29 if k == 8 else -1)
        p.add("Rest", 5, 10, v0=3.35)
        p.add("CC_DChg", 20, 30, -0.5, 3.25, -0.02, 300)
    p.add("Rest", 10, 59.9, v0=3.2).add("CC_DChg", 30, 1, -1.0, 3.1, -0.05, 2)  # rest too short
    for n, dt, i in [(7, 0.7, -1.0), (5, 1.0, -1.0), (100, 0.6, -1.0), (100, 0.601, -1.0), (30, 1.0, -0.009)]:
        p.add("Rest_1", 10, 60, v0=3.2).add("CC_DChg", n, dt, i, 3.1, -0.04, 2)
    p.add("Rest", 10, 60).add("CC_Chg", 30, 1, 1.0)
    return p


def _ocv() -> Program:
    p = Program("OCVSOC", 5)
    p.add("Rest", 10, 30)
    p.add("CC_Chg", 24, 60, 0.2, 3.0, 0.1, 900)  # shorter than the slow pass
    p.add("CCCV_Chg", 100, 360, 0.1, 3.0, 0.6, 9000).add("CCCV_Chg", 10, 60, 0.0, 3.59, more=True)
    p.add("Rest", 10, 60, v0=3.5)
    p.add("CC_DChg", 100, 360, -0.1, 3.5, -0.7, 12000, noise=1e-5)
    return p


def _dcir() -> Program:
    p = Program("DCIR", 10)
    p.add("CC_Chg", 20, 60, 0.5)
    for v in (3.30, 3.25):
        p.add("Rest", 10, 60, v0=3.4)
        p.add("CC_DChg", 120, 0.5, -0.2, v)
        p.burst("CC_DChg", 20, 0.5, -1.0, v - 0.05).burst("CC_DChg", 60, 0.5, -0.2, v)
        p.burst("CC_DChg", 8, 0.5, -1.0, v - 0.06).burst("CC_DChg", 1, 0.5, -0.2, v - 0.01)  # 1.5 s gap: merged
        p.burst("CC_DChg", 8, 0.5, -1.0, v - 0.07).burst("CC_DChg", 60, 0.5, -0.2, v)
        p.burst("CC_DChg", 8, 0.5, -1.0, v - 0.06).burst("CC_DChg", 2, 0.5, -0.2, v - 0.01)  # 2.0 s gap: kept apart
        p.burst("CC_DChg", 8, 0.5, -1.0, v - 0.07).burst("CC_DChg", 60, 0.5, -0.2, v)
        p.burst("CC_DChg", 50, 0.5, -1.0, v - 0.08).burst("CC_DChg", 60, 0.5, -0.2, v)  # 25 s: two pulses
        p.burst("CC_DChg", 70, 0.5, -0.9, v - 0.08).burst("CC_DChg", 60, 0.5, -0.2, v)  # 35 s: four pulses
        p.burst("CC_DChg", 3, 0.3, -1.0, v - 0.08).burst("CC_DChg", 60, 0.5, -0.2, v)  # 0.9 s: dropped
    p.add("Rest", 10, 60).add("CC_DChg", 60, 1, -0.2)  # no peak over the baseline
    return p


def _gitt() -> Program:
    p = Program("GITT", 15)
    for k, tau in enumerate([300.0, 450.0, 120.0, 900.0, 37.0, 2500.0]):
        p.add("CC_DChg", 20, 30, -0.3, 3.4 - 0.02 * k, -0.04, 200)
        p.add("Rest", 60, 60, v0=3.32 - 0.02 * k, a=0.02 + 0.003 * k, tau=tau, noise=1e-5 if k % 2 else 0.0)
    for n, dt in [(1, 59), (2, 30), (30, 60), (1, 1801)]:  # 59, 60, 1800 and 1801 seconds
        p.add("CC_DChg", n, dt, -0.3, 3.2, -0.01).add("REST", 40, 60, v0=3.2, a=0.01, tau=200)
    p.add("CC_DChg", 20, 30, -0.3, 3.2).add("Rest", 10, 59.9, v0=3.2)  # rest too short
    p.add("CC_DChg", 20, 30, -0.3, 3.2, -0.02).add("Rest", 28, 60, v0=3.2, a=0.01)  # too few samples to fit
    p.add("CC_DChg", 20, 30, -0.3, 3.2, -0.02).add("Rest", 40, 60, v0=3.2, a=0.01, null_at=7)  # gap: not fitted
    p.add("CC_DChg", 20, 30, -0.3, 3.2, -0.02).add("Rest", 40, 60, v0=3.2, a=-0.01, tau=300)  # against the bounds
    p.add("CC_DChg", 20, 30, -0.3, 3.1)  # nothing follows
    return p


def _rate() -> Program:
    p = Program("RateCapability", 20)
    for rate, hours in [(0.33, 3.0), (0.5, 1.9), (1.0, 0.9), (0.33, 2.9), (0.5, 1.8), (1.0, 0.8), (1.0, 0.85)]:
        p.add("CC_Chg", 20, hours * 180, rate, 3.2, 0.3, 3000).add("Rest", 5, 60)
        p.add("CC_DChg", 20, hours * 175, -rate, 3.4, -0.4, 3000).add("Rest", 5, 60)
        p.cycle += 1
    p.add("CC_DChg", 20, 176.4, -0.5).add("Rest", 5, 60)  # 49 % of nominal
    p.add("CC_DChg", 20, 180, -0.5).add("Rest", 5, 60)  # exactly 50 %
    p.add("CP_DChg", 20, 180, -0.9)
    return p


def _self_discharge() -> Program:
    p = Program("SelfDischarge", 30)
    p.add("Rest", 10, 359.9, v0=3.3)  # 3599 s
    p.add("CC_Chg", 20, 300, 0.5, 3.2, 0.3, 2000)
    p.add("Rest", 60, 14400, v0=3.42, a=-0.03, tau=400000)
    p.add("CC_DChg", 20, 290, -0.5, 3.4, -0.4, 2000)
    p.add("Rest", 10, 400, v0=3.2)
    p.add("Rest_1", 100, 14400, v0=3.2)
    return p


def _peak_power() -> Program:
    p = Program("PeakPower", 70)
    for bulk, n, dt in [(900, 10, 1.0), (900, 11, 0.9), (900, 30, 1.0), (900, 43, 0.7), (600, 7, 1.7)]:
        p.add("CC_DChg", n, dt, -2.0, 3.3, -0.1, 8).add("Rest", 5, 10, v0=3.3)
        p.add("CC_Chg", n, dt, 1.5, 3.4, 0.1, 8).add("Rest", 5, 10, v0=3.3)
        p.add("CC_DChg", 20, bulk / 20, -0.8, 3.3).add("Rest", 5, 10, v0=3.3)
    p.add("CC_DChg", 10, 1, -0.01, 3.3).add("Rest", 5, 10, v0=3.3)
    p.add("CC_DChg", 10, 1, -0.02, 3.3).add("Rest", 5, 10, v0=3.3)
    p.add("CC_DChg", 7, 1.4, -0.02, 3.3).add("Rest", 5, 10, v0=3.3)  # same rounded SoC, too short: last wins
    p.add("CC_DChg", 20, 180, -1.0, 3.0).add("Rest", 5, 10).add("CC_DChg", 10, 1.5, -1.0, 3.0)  # clamps at zero
    return p


def _constant_power() -> Program:
    p = Program("ConstantPower", 80)
    for i, hours in [(-0.5, 1.5), (-0.25, 3.0), (-1.0, 0.7), (-0.25, 2.9)]:
        p.add("CC_Chg", 10, hours * 360, 0.5).add("Rest", 5, 60)
        p.add("CP_DChg", 20, hours * 180, i, 3.3, -0.3, 2000, null_at=5).add("Rest", 5, 60)
    return p


def _cycling(test: str, day: int, cycles: int) -> Program:
    p = Program(test, day)
    for k in range(cycles):
        p.cycle = k + 1
        p.add("CC_Chg", 10, 300 - 3 * k, 0.333, 3.2, 0.2, 900, crate="abc" if k == 0 else "0.333C", null_at=3)
        p.add("CCCV_Chg", 10, 600, 0.5 - 0.01 * k, 3.4, 0.1, 900, drate="0.5D")
        p.add("Rest", 5, 60, v0=3.5)
        p.add("CC_DChg", 10, 900 - 5 * k, -0.333, 3.4, -0.4, 2000, drate="0.333D").add("Rest", 5, 60, v0=3.2)
    return p


def segments() -> list[Segment]:
    """Every step of every program, in time order inside each test."""
    programs = [
        _hppc(), _ocv(), _dcir(), _gitt(), _rate(), _self_discharge(), _peak_power(), _constant_power(),
        _cycling("RPT", 90, 3), _cycling("Longterm", 100, 4),
    ]
    return [s for p in programs for s in p.segments]


def run_fleet(cells: DataFrame, id_col: str, group_col: str, figure_col: str, tests: list[str] | None = None) -> DataFrame:
    """Telemetry (RAW columns) of every cell of ``cells`` running the programs of ``tests`` (default all).

    Two nested ``explode`` calls over literals, so no join is needed. The cells are spread over all
    cores first, since one small file of cells would otherwise be expanded by one task.
    """
    wanted = [s for s in segments() if tests is None or s.test in tests]
    program = _literal_program(wanted)
    cell, group, figure = F.col(id_col), F.col(group_col), F.col(figure_col)
    t = F.col("k") * F.col("s.dt_ms") / F.lit(1000.0)
    volt = (
        F.col("s.v0")
        + F.col("s.a") * (F.lit(1.0) - F.exp(-t / F.col("s.tau")))
        + figure * F.lit(1.2345678e-6)
        + F.col("s.noise") * F.sin(F.col("k") * F.lit(1.7) + cell)
    )
    cap = F.lit(100.0) + cell % 5
    return (
        cells.select(id_col, group_col, figure_col)
        .repartition(cells.sparkSession.sparkContext.defaultParallelism, id_col)
        .select("*", F.explode(program).alias("s"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("s.n"))).alias("k"))
        .select(
            F.lpad(cell.cast("string"), 8, "0").alias("cell_no"),
            F.col("s.cycle_no").alias("cycle_no"),
            F.when(cell % 4 != 0, F.col("s.step_no")).cast("int").alias("cycler_step_no"),
            F.col("s.step_name").alias("step_name"),
            F.timestamp_micros((F.col("s.start_ms") + F.col("k") * F.col("s.dt_ms") + cell * 10) * 1000).alias(
                "absolute_time"
            ),
            F.when(F.col("k") != F.col("s.null_at"), F.round(volt, 6)).alias("volt_v"),
            (F.col("s.i_c") * cap * (F.lit(1.0) + group * F.lit(0.001))).alias("current_a"),
            (cap * (F.col("s.c0") + F.col("s.i_c") * t / F.lit(3600.0))).alias("capacity_ah"),
            F.col("s.crate").alias("crate"),
            F.col("s.drate").alias("drate"),
            F.lit(None).cast("string").alias("dod"),
            F.when(cell % 50 != 49, cap).alias("max_cap"),
            F.col("s.test").alias("test"),
            F.concat(F.lit("MAKE"), (group % 3).cast("string")).alias("make"),
            (cell % 2).cast("string").alias("batch"),
        )
    )


PROGRAM_TYPE = (
    "array<struct<test:string,cycle_no:int,step_no:int,step_name:string,start_ms:bigint,n:int,dt_ms:bigint,"
    "i_c:double,c0:double,v0:double,a:double,tau:double,noise:double,crate:string,drate:string,null_at:int>>"
)


def _literal_program(wanted: list[Segment]):
    """The segments as one literal, folded to a constant by the optimizer."""
    return F.from_json(F.lit(json.dumps([vars(s) for s in wanted])), PROGRAM_TYPE)


def values_sql(tests: list[str] | None = None) -> str:
    """The same segments as a SQL ``VALUES`` list named ``seg``."""

    def lit(v) -> str:
        if v is None:
            return "cast(null as varchar)"
        if isinstance(v, str):
            return f"'{v}'"
        if isinstance(v, float):
            return f"cast({v!r} as double)"
        return f"cast({v} as bigint)"

    wanted = [s for s in segments() if tests is None or s.test in tests]
    rows = ",\n".join("(" + ", ".join(lit(v) for v in vars(s).values()) + ")" for s in wanted)
    return f"(values {rows}) seg({', '.join(vars(wanted[0]))})"
