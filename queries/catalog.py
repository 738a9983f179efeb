"""The queries over the given tables, by name.

Three telemetry sources are derived from the tables. Orders are steps of the cells of fifteen customers and
their lines are samples; order keys are the time of cells that are pulsed and rest in turn; and every user of
``events`` is a cell and every event a sample.
Doubles are rounded for comparison here, and only here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.functions.chunked import exact_median, neighbours
from cellspark.functions.lineage import cut, table_path
from cellspark.operators import cycles, energy, segment
from cellspark.operators.dcir import extract_dcir_anchors
from cellspark.operators.gitt import extract_gitt_pulses
from cellspark.operators.hppc import detect_hppc_pulses
from cellspark.operators.ocv import extract_ocv_curves
from cellspark.operators.power import extract_constant_power, extract_peak_power
from cellspark.operators.rate import extract_rate_capability
from cellspark.operators.self_discharge import extract_self_discharge
from cellspark.operators.soc import soc_at_step_start
from cellspark.plans import select, upsert, wide
from cellspark.schemas import CELL_KEYS
from cellspark.sources import ingest, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Event types read as step names.
EVENT_STEPS = {"click": "CC_Chg", "view": "CC_DChg", "purchase": "Rest", "signup": "CP_DChg", "error": "CCCV_Chg"}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(name, digits).alias(name) if dtype == "double" and name != "max_cap" else F.col(name)
            for name, dtype in df.dtypes
        ]
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, user, value = F.col("event_type"), F.col("user_id"), F.col("value")
    step = F.coalesce(*[F.when(kind == k, v) for k, v in EVENT_STEPS.items()])
    sign = F.when(kind == "purchase", 0.0).when(kind.isin("view", "signup"), -1.0).otherwise(1.0)
    none = F.lit(None).cast("string")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.lpad(user.cast("string"), 8, "0").alias("cell_no"),
        F.dayofmonth("ts").alias("cycle_no"),
        F.lit(None).cast("int").alias("cycler_step_no"),
        step.alias("step_name"),
        F.col("ts").cast("timestamp").alias("absolute_time"),
        (F.lit(3.2) + value / 1000).alias("volt_v"),
        (sign * value / 10).alias("current_a"),
        (sign * value / 100).alias("capacity_ah"),
        none.alias("crate"),
        none.alias("drate"),
        none.alias("dod"),
        F.lit(5.0).alias("max_cap"),
        F.when(user % 3 == 0, "RPT").otherwise("Longterm").alias("test"),
        F.concat(F.lit("MAKE"), (user % 4).cast("string")).alias("make"),
        (user % 2).cast("string").alias("batch"),
    )


#: Milliseconds between two samples whose quantities differ by one, in steps that are no rest.
LINE_MS = {"HPPC": 1_000, "DCIR": 400, "PeakPower": 600, "GITT": 30_000}
OTHER_LINE_MS, REST_LINE_MS, ORDER_MS = 60_000, 300_000, 16_000_000
OTHER_TESTS = ("HPPC", "OCVSOC", "DCIR", "RateCapability", "SelfDischarge", "PeakPower", "ConstantPower", "RPT", "Longterm")
ORDER_STEPS = ("CC_DChg", "Rest", "CC_Chg", "CP_DChg")


def lineitem(spark: SparkSession, sf_dir: str, *tests: str) -> DataFrame:
    """Samples of some protocols: an order is a step, and a line a sample of it in each of them.

    Quantity gives time, voltage and charge, the discount gives current. A quarter of the cells has no step
    numbers and a tenth no capacity. Open-circuit steps are twelfths of a cell's orders, which are long enough.
    """
    key, cell, test, flag = F.col("o_orderkey"), F.floor(F.col("o_custkey") / 15), F.col("test"), F.col("l_returnflag")
    step = F.when(test == "OCVSOC", key % 12).otherwise(key)
    name = F.element_at(F.array(*map(F.lit, ORDER_STEPS)), (key % 4 + 1).cast("int"))
    sign = F.when(name == "Rest", 0.0).when(name == "CC_Chg", 1.0).otherwise(-1.0)
    width = F.when(name == "Rest", REST_LINE_MS)
    for t in tests:
        width = width.when(test == t, LINE_MS.get(t, OTHER_LINE_MS))
    number = F.col("l_linenumber").cast("string")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    held = spark.read.parquet(f"{sf_dir}/orders.parquet").join(lines, key == F.col("l_orderkey"))
    if len(tests) > 1:
        held = held.repartition("l_orderkey", "l_linenumber")  # a split of the file grows by as many samples
    return held.withColumn("test", F.explode(F.array(*map(F.lit, tests)))).select(
        F.lpad(cell.cast("string"), 8, "0").alias("cell_no"),
        (key % 5).cast("int").alias("cycle_no"),
        F.when(cell % 4 != 0, step.cast("int")).alias("cycler_step_no"),
        name.alias("step_name"),
        F.timestamp_millis(key * ORDER_MS + F.col("l_quantity").cast("bigint") * width + F.col("l_linenumber")).alias("absolute_time"),
        (F.lit(3.0) + F.col("l_quantity") / 100 + F.col("l_extendedprice") * 1.2345678e-7).alias("volt_v"),
        (sign * (F.lit(1.0) + F.rint(F.col("l_discount") * 100))).alias("current_a"),
        (sign * F.col("l_quantity") / 50 * 4.5).alias("capacity_ah"),
        F.when(flag == "R", F.concat(number, F.lit(".25C"))).when(flag == "A", "C/n").alias("crate"),
        F.when(flag != "A", F.concat(F.lit("0."), number, F.lit("D"))).alias("drate"),
        F.lit(None).cast("string").alias("dod"),
        F.when(cell % 10 != 9, 5.0).alias("max_cap"),
        test,
        F.concat(F.lit("MAKE"), (cell % 4).cast("string")).alias("make"),
        (cell % 2).cast("string").alias("batch"),
    )


def relaxing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of GITT: order keys are time; blocks of 256 keys are pulses and rests in turn, sixteen a cell.

    A line is a sample. A rest's voltage relaxes, with an amplitude of the cell and a time constant of the block, and
    the discount is its noise.
    """
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    cell, block = F.floor(key / 4096), F.floor(key / 256)
    pulse = block % 2 == 0
    place = key % 256 * 8 + line
    ms = F.when(pulse, key % 256 * 4000 + line * 500).otherwise(place * place * 3)
    current = F.when(pulse, -(F.lit(2.0) + cell % 3)).otherwise(0.0)
    rest = F.lit(3.2) + (F.lit(0.05) + F.lit(0.01) * (cell % 10)) * (1 - F.exp(-(ms / 1000.0) / (F.lit(150.0) + block % 8 * 250)))
    none = F.lit(None).cast("string")
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.concat(F.lit("R"), F.lpad(cell.cast("string"), 7, "0")).alias("cell_no"),
        (block % 16).cast("int").alias("cycle_no"),
        F.lit(None).cast("int").alias("cycler_step_no"),
        F.when(pulse, "CC_DChg").otherwise("Rest").alias("step_name"),
        F.timestamp_millis(block * 20_000_000 + ms).alias("absolute_time"),
        F.round(F.when(pulse, F.lit(3.1) - ms * 5e-8).otherwise(rest) + F.col("l_discount") * 1e-4, 6).alias("volt_v"),
        current.alias("current_a"),
        (current * ms / 3600000.0).alias("capacity_ah"),
        none.alias("crate"), none.alias("drate"), none.alias("dod"),
        F.lit(5.0).alias("max_cap"),
        F.lit("GITT").alias("test"),
        F.lit("MAKE9").alias("make"),
        F.lit("0").alias("batch"),
    )


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.with_keys(events(spark, sf_dir))


@query
def cycle_agg_events(spark, sf_dir):
    return rounded(cycles.aggregate_per_cycle(events(spark, sf_dir)), 9)


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the comparison engine has them."""
    return df.select(
        *[F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(n) for n, t in df.dtypes]
    )


@query
def conform_raw(spark, sf_dir):
    """Lake-style names, untrimmed text and unreadable numbers in, RAW out."""
    untidy = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").alias("Cell"),
        F.lower(F.concat(F.lit("make"), (F.col("user_id") % 4).cast("string"))).alias("Make"),
        (F.col("user_id") % 2).alias("Batch"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("  "), "event_type", F.lit(" "))).alias("Step name"),
        F.dayofmonth("ts").cast("string").alias("Cycle No"),
        F.when(F.col("value") < 300, F.col("event_id").cast("string")).otherwise("n/a").alias("Sequence number of step"),
        F.col("ts").alias("Absolute time"),
        F.when(F.col("value") < 200, F.col("value")).otherwise(float("nan")).alias("volt(V)"),
        F.when(F.col("value") < 100, F.col("value").cast("string")).otherwise("").alias("Current(A)"),
        F.lit("RPT").alias("Test"),
    )
    return rounded(naive(ingest.conform(untidy)))


@query
def islands_events(spark, sf_dir):
    rows = segment.restore_keys(segment.label_islands(keyed_events(spark, sf_dir)))
    return naive(rows.select(*CELL_KEYS, "absolute_time", "step_name", F.col("_idx").alias("idx"), F.col("_block").alias("block")))


@query
def steps_events(spark, sf_dir):
    steps = segment.island_steps(segment.label_islands(keyed_events(spark, sf_dir)))
    return naive(rounded(segment.restore_keys(steps).withColumnRenamed("_block", "block"), 9))


@query
def step_neighbours_events(spark, sf_dir):
    steps = segment.island_steps(segment.label_islands(keyed_events(spark, sf_dir)))
    near = neighbours(steps, segment.KEYS, "_block", ["step_name", "duration_s"], before="p", after="n")
    return rounded(
        segment.restore_keys(near).select(
            *CELL_KEYS,
            F.col("_block").alias("block"),
            F.col("p.step_name").alias("prev_step"),
            F.col("p.duration_s").alias("prev_s"),
            F.col("n.step_name").alias("next_step"),
            F.col("n.duration_s").alias("next_s"),
        )
    )


@query
def soc_at_step_start_events(spark, sf_dir):
    steps = segment.island_steps(segment.label_islands(keyed_events(spark, sf_dir)))
    return rounded(segment.restore_keys(soc_at_step_start(cut(steps))).withColumnRenamed("_block", "block"))


@query
def rate_medians_events(spark, sf_dir):
    """Median capacity per cell and step kind, over all events."""
    rows = keyed_events(spark, sf_dir)
    medians = exact_median(rows, [*segment.KEYS, "step_name"], "volt_v", "median_v")
    return rounded(segment.restore_keys(medians), 9)


def event_files(spark, sf_dir) -> DataFrame:
    """One lake path per (test, cell, day) that has events."""
    user, ts = F.col("user_id"), F.col("ts")
    test = F.when(user % 3 == 0, "SelfDischarge").when(user % 3 == 1, "GITT").otherwise("Longterm")
    both = F.when(
        F.col("event_type") == "click", F.array(test, F.lit("OCVSOC"))
    ).otherwise(F.array(test))
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .select(F.explode(both).alias("test"), user, ts)
        .select(
            F.format_string(
                "lake/Test=%s/Make=M%s/Batch=%s/Cell=%s/YYYY=%s/MM=%s/DD=%s/part-0.parquet",
                "test", user % 4, user % 2, user, F.year(ts), F.month(ts), F.dayofmonth(ts),
            ).alias("path")
        )
        .distinct()
    )


@query
def file_inventory(spark, sf_dir):
    return ingest.inventory_of(event_files(spark, sf_dir))


@query
def file_inventory_lake(spark, sf_dir):
    """A lake written from the events, a folder for each test, cell and week, and listed again by tasks."""
    user, ts = F.col("user_id"), F.col("ts")
    test = F.when(user % 3 == 0, "SelfDischarge").when(user % 3 == 1, "GITT").otherwise("Longterm")
    week = F.lpad((F.floor((F.dayofmonth(ts) - 1) / 7) * 7 + 1).cast("string"), 2, "0")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        test.alias("Test"), F.concat(F.lit("M"), user % 4).alias("Make"), (user % 2).cast("string").alias("Batch"), F.concat(F.lit("c:"), user % 50).alias("Cell"),
        F.year(ts).cast("string").alias("YYYY"), F.date_format(ts, "MM").alias("MM"), week.alias("DD"), F.col("value").alias("volt(V)"),
    )
    lake = table_path(spark, "lake")
    rows.repartition(*ingest.LAKE_PARTITIONS).write.partitionBy(*ingest.LAKE_PARTITIONS).parquet(lake)
    return ingest.inventory(spark, lake).groupBy(*ingest.GROUP_PARTITIONS, "date").agg(F.count("*").alias("n_files"))


@query
def changed_group_selection(spark, sf_dir):
    return select.changed_groups(ingest.inventory_of(event_files(spark, sf_dir)), "2024-01-28")


@query
def changed_with_dependencies(spark, sf_dir):
    files = ingest.inventory_of(event_files(spark, sf_dir))
    return select.with_dependencies(select.changed_groups(files, "2024-01-29", ["M0", "M1"]), files, ["M0", "M1"])


@query
def null_safe_upsert(spark, sf_dir):
    """Early and late state of every user: blanks of the late one must not erase the early one."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")

    def state(rows, prefix, shown):
        return rows.groupBy("user_id").agg(
            F.max(F.when((F.col("event_type") == "click") & shown, F.col("value"))).alias("best"),
            F.when(F.max("value") > 150, float("nan")).otherwise(F.max("value")).alias("top"),
            F.when(F.max("value") > 120, F.lit("  ")).otherwise(F.concat(F.lit(prefix), F.min("event_type"))).alias("tag"),
            F.min("ts").alias("first_seen"),
            F.sort_array(F.collect_list(F.when((F.col("event_type") == "error") & shown, F.col("value")))).alias("errors"),
        )

    types = {"best": "double", "top": "double", "tag": "string", "first_seen": "timestamp_ntz", "errors": "array<double>"}
    merged = upsert.merge_rows(
        state(ev.where(~early), "new-", F.col("value") > 20), state(ev.where(early), "old-", F.lit(True)), ["user_id"], types,
        earliest=("first_seen",),
    )
    return merged.withColumn("errors", text_of("errors"))


def text_of(array: str, scale: float = 1e6):
    """An array of doubles as text that any engine can reproduce: scaled integers, comma separated, null as n."""
    return F.array_join(
        F.transform(array, lambda v: F.coalesce(F.round(v * scale).cast("bigint").cast("string"), F.lit("n"))), ","
    )


# Arrays of large values, compared to fewer digits.
COARSE_ARRAYS = ("c1_dchg_curve", "c2_dchg_curve", "tau_diff_curve")


def wide_rows(raw: DataFrame) -> DataFrame:
    """The wide row of every cell, with its cross-test columns, in a form that any engine can reproduce."""
    full = wide.with_dsoc_per_day(wide.build_wide(ingest.only_tests(raw)))
    texts = {n: text_of(n, 1e1 if n in COARSE_ARRAYS else 1e6) for n, t in full.dtypes if t.startswith("array")}
    return naive(rounded(full.withColumns(texts)))


@query
def wide_cells_lineitem(spark, sf_dir):
    """The wide row of every cell, over all protocols."""
    return wide_rows(lineitem(spark, sf_dir, *OTHER_TESTS).unionByName(relaxing(spark, sf_dir)))


@query
def rpt_c_rate_lineitem(spark, sf_dir):
    return rounded(cycles.rpt_c_rate(lineitem(spark, sf_dir, "RPT")))


@query
def gitt_relaxation_lineitem(spark, sf_dir):
    fitted = extract_gitt_pulses(relaxing(spark, sf_dir))
    return fitted.select(
        *CELL_KEYS, "pulse_idx", F.round("tau_diff_s", 2).alias("tau_diff_s"), F.round("v_inf_v", 6).alias("v_inf_v")
    )


@query
def dsoc_per_day_lineitem(spark, sf_dir):
    raw = lineitem(spark, sf_dir, "OCVSOC", "SelfDischarge")
    row = wide.assemble(
        wide.sessions(raw),
        [wide.ocv_arrays(extract_ocv_curves(raw)), wide.self_discharge_columns(extract_self_discharge(raw))],
    )
    return rounded(wide.with_dsoc_per_day(row).select(*CELL_KEYS, "self_disch_dsoc_per_day"))


@query
def cycle_agg_lineitem(spark, sf_dir):
    return rounded(cycles.aggregate_per_cycle(lineitem(spark, sf_dir, "RPT")), 9)


@query
def cycle_energy_lineitem(spark, sf_dir):
    return rounded(energy.cycle_energy(lineitem(spark, sf_dir, "RPT")))


@query
def cycle_energy_events(spark, sf_dir):
    return rounded(energy.cycle_energy(events(spark, sf_dir)))


@query
def cycles_with_energy_lineitem(spark, sf_dir):
    return rounded(energy.cycles_with_energy(lineitem(spark, sf_dir, "Longterm")).withColumn("coulombic_eff", F.round("coulombic_eff", 3)))


@query
def rate_capability_strict_lineitem(spark, sf_dir):
    return rounded(extract_rate_capability(lineitem(spark, sf_dir, "RateCapability"), strict_direction=True))


@query
def state_of_health_lineitem(spark, sf_dir):
    return rounded(cycles.state_of_health(cycles.rpt_capacity(lineitem(spark, sf_dir, "RPT"))))


@query
def rate_capability_lineitem(spark, sf_dir):
    return rounded(extract_rate_capability(lineitem(spark, sf_dir, "RateCapability")))


@query
def self_discharge_lineitem(spark, sf_dir):
    return rounded(extract_self_discharge(lineitem(spark, sf_dir, "SelfDischarge")))


@query
def constant_power_lineitem(spark, sf_dir):
    return rounded(extract_constant_power(lineitem(spark, sf_dir, "ConstantPower")))


@query
def ocv_curves_lineitem(spark, sf_dir):
    return rounded(extract_ocv_curves(lineitem(spark, sf_dir, "OCVSOC")))


@query
def peak_power_lineitem(spark, sf_dir):
    return rounded(extract_peak_power(lineitem(spark, sf_dir, "PeakPower")))


@query
def hppc_pulses_lineitem(spark, sf_dir):
    pulses = rounded(detect_hppc_pulses(lineitem(spark, sf_dir, "HPPC")))
    return pulses.withColumns({c: F.round(c, 2) for c in ("C1_F", "C2_F")})


@query
def dcir_anchors_lineitem(spark, sf_dir):
    return rounded(extract_dcir_anchors(lineitem(spark, sf_dir, "DCIR")))


@query
def gitt_pulses_lineitem(spark, sf_dir):
    return rounded(extract_gitt_pulses(lineitem(spark, sf_dir, "GITT"), fit=False))


@query
def steps_by_number_lineitem(spark, sf_dir):
    rows = segment.number_rows(segment.select_test(lineitem(spark, sf_dir, "HPPC"), "HPPC"))
    return naive(rounded(segment.restore_keys(segment.numbered_steps(rows)).withColumnRenamed("_step_no", "step_no")))


def capacity_results(raw: DataFrame) -> DataFrame:
    """Result rows with sessions, capacities and health only."""
    return tables.result_rows(wide.assemble(wide.sessions(raw), [cycles.rpt_capacity(raw)]))


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Result rows of the later and of the earlier cycles of every cell."""
    raw = lineitem(spark, sf_dir, "RPT")
    return capacity_results(raw.where("cycle_no >= 3")), capacity_results(raw.where("cycle_no < 3"))


@query
def result_upsert_all_lineitem(spark, sf_dir):
    """Later cycles of every cell merged into the result rows of the earlier cycles."""
    merged = upsert.merge_results(*halves(spark, sf_dir))
    return naive(rounded(merged.select("make", "max_cap", "cell", "batch", "Soh", "q_rpt_ah", "q_rpt_chg_ah", "test_session_start", "test_session_end")))


@query
def existing_results_all_lineitem(spark, sf_dir):
    """The stored rows of every cell that has later cycles."""
    new, old = halves(spark, sf_dir)
    return naive(rounded(upsert.existing_rows(old, new).select("make", "max_cap", "cell", "batch", "q_rpt_ah", "test_session_end")))


@query
def latest_states_events(spark, sf_dir):
    """Every event as a saved state of its user: the state that counts."""
    states = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("last_run_date"), F.col("event_type").alias("table"), F.col("ts").alias("saved_at")
    )
    return tables.latest_states(states, ["user_id"])
