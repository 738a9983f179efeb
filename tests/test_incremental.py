"""Lake in, result table out: ingest, selection, upsert, state, catalog, stream."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellspark.operators.ocv import extract_ocv_curves
from cellspark.operators.self_discharge import extract_self_discharge
from cellspark.plans import incremental, jobs, wide
from cellspark.plans.incremental import run_incremental
from cellspark.plans.ledger import Ledger
from cellspark.plans.upsert import merge_results
from cellspark.schemas import DATA_COLS, PULSE, RESULT
from cellspark.sources import details, folders, ingest, tables
from cellspark.streaming import incremental as stream
from cellspark.streaming.incremental import stream_incremental
from tests.builders import START, Cell, collect, raw

INVERSE = {v: k for k, v in ingest.SOURCE_NAMES.items()}


def _land(spark, lake, cell, date, make="eve", batch="1"):
    """Write one cell's samples as a file of the lake, under the source's column names."""
    folders = {"Test": cell.key["test"], "Make": make, "Batch": batch, "Cell": cell.key["cell_no"]}
    y, m, d = date.split("-")
    path = "/".join(f"{k}={v}" for k, v in folders.items()) + f"/YYYY={y}/MM={m}/DD={d}"
    df = raw(spark, cell).drop("test", "make", "batch", "cell_no")
    df.withColumnsRenamed({k: v for k, v in INVERSE.items() if k in df.columns}).coalesce(1).write.mode("append").parquet(
        f"{lake}/{path}"
    )


def _ocv(cell="1"):
    return Cell("OCVSOC", cell=cell).step("CC_DChg", 3600, 30, -10.0, lambda t: 3.6 - t / 7200, cap=lambda t: -t / 360)


def _rest(cell="1", drop=0.05, start_s=1e6):
    return Cell("SelfDischarge", cell=cell, start_s=start_s).step("Rest", 86400, 10, 0.0, lambda t: 3.5 - drop * t / 86400)


def _rpt(cell="1", cap=90.0):
    return Cell("RPT", cell=cell, start_s=2e6).step("CC_Chg", 3600, 5, 90.0, crate="0.5C").step(
        "CC_DChg", 3600, 5, -90.0, cap=lambda t: -cap * t / 3600
    )


@pytest.fixture
def few_tests(monkeypatch):
    """Only the protocols these lakes hold, to keep runs short."""
    monkeypatch.setattr(
        wide,
        "per_test_parts",
        lambda r: [
            wide.ocv_arrays(extract_ocv_curves(r)),
            wide.self_discharge_columns(extract_self_discharge(r)),
            wide.cycles.rpt_capacity(r),
            wide.cycles.rpt_c_rate(r),
        ],
    )


def test_incremental_runs(spark, tmp_path, few_tests):
    lake, out, state = (str(tmp_path / n) for n in ("lake", "out", "state"))
    for cell in (_ocv(), _rest(), _rpt(), _rpt("2")):
        _land(spark, lake, cell, "2024-01-05")
    _land(spark, lake, Cell("Longterm", cell="9").step("CC_Chg", 60, 3, 1.0), "2024-01-09")

    dry = run_incremental(spark, lake, out, state, dry_run=True)
    assert dry.rows.count() == 2 and tables.read_results(spark, out).count() == 0 and tables.load_state(spark, state) == {}

    first = run_incremental(spark, lake, out, state, table="cells")
    assert (first.advanced_to, first.registered) == ("2024-01-05", 2)
    one = tables.read_results(spark, out).where("cell = '0001' and make = 'EVE'").first()
    assert (one["max_cap"], one["q_rpt_ah"], one["Soh"], one["rpt_protocol_c_rate"]) == ("100.0", 90.0, 90.0, 0.5)
    assert one["self_disch_dsoc_per_day"] == pytest.approx(0.1) and len(one["v_oc_curve"]) == 11
    assert one["test_session_start"].replace(tzinfo=None) == START.replace(tzinfo=None)
    assert spark.table("cells").where("cell = '0002'").count() == 1

    assert run_incremental(spark, lake, out, state).rows is None  # nothing new

    # a changed rest loads the curve too, keeps what it did not see, and cannot shrink the session
    _land(spark, lake, _rest(drop=0.1, start_s=3e6), "2024-01-07")
    second = run_incremental(spark, lake, out, state, makes=["eve"])
    assert second.advanced_to is None and tables.load_state(spark, state)["last_run_date"] == "2024-01-05"
    rows = {r["cell"]: r for r in tables.read_results(spark, out).collect()}
    assert set(rows) == {"0001", "0002"} and rows["0001"]["q_rpt_ah"] == 90.0
    assert rows["0001"]["test_session_end"] > one["test_session_end"]
    assert rows["0001"]["test_session_start"] == one["test_session_start"]

    only = run_incremental(spark, lake, out, state, full=True, cells=["eve:1:2"])
    assert only.rows.count() == 1 and only.advanced_to is None
    assert run_incremental(spark, lake, out, state, since="2024-01-06").advanced_to == "2024-01-07"


def test_columns_and_cells_of_any_file_count(spark, tmp_path):
    """A file without C-rate labels does not hide those of others, nor does an escaped cell id hide its cell."""
    lake, out, state = (str(tmp_path / n) for n in ("lake", "out", "state"))
    _land(spark, lake, _rpt("A"), "2024-01-05")
    for path in (tmp_path / "lake").rglob("part-*.parquet"):
        bare = spark.read.parquet(str(path)).drop("crate").collect()
        schema = spark.read.parquet(str(path)).drop("crate").schema
        spark.createDataFrame(bare, schema).coalesce(1).write.mode("overwrite").parquet(str(path.parent).replace("Cell=A", "Cell=0"))
    _land(spark, lake, _rpt("B"), "2024-01-05")
    spark.read.parquet(f"{lake}/Test=RPT/Make=eve/Batch=1/Cell=B/YYYY=2024/MM=01/DD=05").withColumns(
        {"Test": F.lit("RPT"), "Make": F.lit("eve"), "Batch": F.lit("1"), "Cell": F.lit("C:3+%"), "YYYY": F.lit("2024"), "MM": F.lit("01"), "DD": F.lit("05")}
    ).write.mode("append").partitionBy(*ingest.LAKE_PARTITIONS).parquet(lake)
    raw_rows = ingest.conform(ingest.read_lake(spark, lake))
    rates = {r["cell_no"]: r["rpt_protocol_c_rate"] for r in wide.cycles.rpt_c_rate(raw_rows).collect()}
    assert rates == {"000A": 0.5, "000B": 0.5, "C:3+%": 0.5} and raw_rows.where("cell_no = '0000'").count() > 0
    files = ingest.inventory(spark, lake)
    assert sorted(r["Cell"] for r in files.select("Cell").distinct().collect()) == ["0", "A", "B", "C:3+%"]
    from cellspark.plans.select import changed_groups, rows_of

    assert rows_of(ingest.read_lake(spark, lake), changed_groups(files, "2024-01-01")).select("Cell").distinct().count() == 4


def test_stream_sees_late_files(spark, tmp_path, few_tests):
    lake, out, mark = (str(tmp_path / n) for n in ("lake", "out", "mark"))
    _land(spark, lake, _rpt(), "2024-01-05")
    stream_incremental(spark, lake, out, mark).awaitTermination()
    _land(spark, lake, _rpt("2", cap=80.0), "2024-01-02")  # late: an older date
    stream_incremental(spark, lake, out, mark).awaitTermination()
    got = {r["cell"]: r["q_rpt_ah"] for r in tables.read_results(spark, out).collect()}
    assert got == {"0001": 90.0, "0002": 80.0}


def test_a_batch_of_the_stream_reads_its_own_folders(spark, tmp_path, few_tests, monkeypatch):
    lake, out, mark = (str(tmp_path / n) for n in ("lake", "out", "mark"))
    read, asked = stream.read_lake, []
    monkeypatch.setattr(stream, "read_lake", lambda s, base, schema=None, folders=None: (asked.append(folders), read(s, base, schema, folders))[1])
    for cell in (_ocv(), _rest(), _rpt("2")):
        _land(spark, lake, cell, "2024-01-05")
    stream_incremental(spark, lake, out, mark, table="streamed").awaitTermination()
    _land(spark, lake, _rest(drop=0.1, start_s=3e6), "2024-01-02")  # late, and its partner is not in the batch
    rows = spark.read.parquet(f"{lake}/Test=RPT/Make=eve/Batch=1/Cell=2/YYYY=2024/MM=01/DD=05").withColumns(
        {"Test": F.lit("RPT"), "Make": F.lit("eve"), "Batch": F.lit("1"), "Cell": F.lit("C:3+% x"), "YYYY": F.lit("2024"), "MM": F.lit("01"), "DD": F.lit("06")}
    )
    rows.write.mode("append").partitionBy(*ingest.LAKE_PARTITIONS).parquet(lake)
    asked.clear()
    stream_incremental(spark, lake, out, mark, table="streamed").awaitTermination()
    own = [f for f in asked if f is not None]
    assert len(own) == 1 and sorted(f.split("/Test=")[1].split("/")[0] for f in own[0]) == ["OCVSOC", "RPT", "SelfDischarge"]
    got = {r["cell"]: r for r in tables.read_results(spark, out).collect()}
    # 0.1 V on the partner's curve, over both rests of the one step number
    assert got["0001"]["self_disch_dsoc_per_day"] == pytest.approx(0.2 / 24.148, rel=1e-3) and got["C:3+% x"]["q_rpt_ah"] == 90.0 and len(got) == 3
    assert spark.table("streamed").count() == 3  # registered by the stream
    states = {(r["Test"], r["Cell"]): r["newest"] for r in stream.group_states(spark, f"{mark}_state").collect()}
    assert states == {("OCVSOC", "1"): "2024-01-05", ("SelfDischarge", "1"): "2024-01-05", ("RPT", "2"): "2024-01-05", ("RPT", "C:3+% x"): "2024-01-06"}


class Died(Exception):
    pass


@pytest.mark.parametrize("phase", ["rows", "merged", "details", "rows_written", "written", "registered"])
def test_a_run_that_died_goes_on(spark, tmp_path, monkeypatch, phase):
    """Stopped after each phase, and between the details and the rows that point at them."""
    out, state, name = str(tmp_path / "out"), str(tmp_path / "state"), f"cells_{phase}"
    tables.write_results(_result_row(spark, cell="c", Soh=1.0, q_rpt_ah=5.0), out)
    new = _result_row(spark, cell="c", Soh=2.0, ocv_soc_grid=[0.0, 1.0], v_oc_curve=[3.0, 3.5], ocv_details_path="details/cohort=M/cell_id=c/batch=b/ocv.parquet")
    new = new.unionByName(_result_row(spark, cell="d", Soh=3.0, ocv_details_path="details/cohort=M/cell_id=d/batch=b/ocv.parquet"))
    computed = []

    def compute():
        computed.append(1)
        return new

    def go():
        ledger = Ledger(spark, state, "run")
        merged, registered = incremental.upsert(spark, ledger, compute, out, name)
        ledger.record("done")
        return merged, registered

    with monkeypatch.context() as patch:
        if phase in ("details", "rows_written"):
            write = incremental.write_results

            def dies(rows, path):
                if phase == "rows_written":
                    write(rows, path)
                raise Died

            patch.setattr(incremental, "write_results", dies)
        else:
            record = Ledger.record

            def dies(self, at, detail=""):
                record(self, at, detail)
                if at == phase:
                    raise Died

            patch.setattr(Ledger, "record", dies)
        with pytest.raises(Died):
            go()
    pointed = tables.read_results(spark, out).where("ocv_details_path is not null")
    details.read_details(pointed, incremental.output_details(out)).count()  # every pointer opens, whenever it died
    merged, registered = go()
    rows = {r["cell"]: r for r in tables.read_results(spark, out).collect()}
    assert len(computed) == 1 and registered == 2 and spark.table(name).count() == 2
    assert (rows["c"]["Soh"], rows["c"]["q_rpt_ah"], rows["d"]["Soh"]) == (2.0, 5.0, 3.0)
    found = sorted(map(tuple, details.read_details(tables.read_results(spark, out), incremental.output_details(out)).collect()))
    assert [f[1:] for f in found] == [("dchg", 0.0, 3.0), ("dchg", 1.0, 3.5)]
    go()  # asked for again after it was done: computed anew
    assert len(computed) == 2


def test_all_protocols_in_one_incremental_run(spark, tmp_path):
    lake, out, state = (str(tmp_path / n) for n in ("lake", "out", "state"))
    fade = lambda t: 3.4 + 0.05 * (1 - np.exp(-t / 200))
    cells = [
        _ocv(), _rest(), _rpt(),
        Cell("HPPC", cell="1").step("Rest", 600, 5, volts=3.4).step("CC_DChg", 30, 31, -50.0, lambda t: 3.3 - 0.001 * t),
        Cell("DCIR", cell="1").step("CC_DChg", 100, 101, lambda t: -60.0 if 40 <= t < 50 else -20.0, lambda t: 3.3 - 0.001 * t),
        Cell("GITT", cell="1").step("CC_DChg", 300, 31, -10.0, 3.3).step("Rest", 900, 46, 0.0, fade),
        Cell("RateCapability", cell="1").step("CC_DChg", 3600, 5, -90.0, cap=lambda t: -90 * t / 3600),
        Cell("PeakPower", cell="1").step("CC_DChg", 20, 21, -100.0, 3.2),
        Cell("ConstantPower", cell="1").step("CP_DChg", 600, 11, -10.0, 3.0),
    ]
    for cell in cells:
        _land(spark, lake, cell, "2024-01-05")
    run = run_incremental(spark, lake, out, state, table="all_protocols")
    row = spark.table("all_protocols").first()
    assert run.registered == 1 and (row["Soh"], row["rpt_protocol_c_rate"], row["hppc_n_pulses_dchg"], row["dcir_n_pulses"]) == (90.0, 0.5, 1.0, 1.0)
    assert row["tau_diff_curve"] == [pytest.approx(200, rel=1e-3)] and len(row["v_oc_curve"]) == 11 and row["const_power_levels_w"] == [pytest.approx(30.0)]
    assert row["rate_cap_q_curve"] == [pytest.approx(90.0)] and row["p_peak_10s_dchg_curve"] == [pytest.approx(320.0)]
    assert row["self_disch_dsoc_per_day"] == pytest.approx(0.1) and row["r0_dchg_curve"][0] is not None
    assert details.read_details(tables.read_results(spark, out), incremental.output_details(out)).count() == 11


def test_a_lake_is_listed_by_tasks(spark, tmp_path):
    lake = tmp_path / "lake"
    for test in ("A", "B=x"):
        for make in ("m", "n%20o", "_hidden"):
            folder = lake / f"Test={test}" / (f"Make={make}" if make[0] != "_" else make) / "Batch=1"
            folder.mkdir(parents=True)
            for name in ("a.parquet", "b.parquet", "_SUCCESS", ".c.parquet", "d.csv"):
                (folder / name).write_text("x")
    (lake / "top.parquet").write_text("x")
    (lake / "Test=A" / "in.parquet").write_text("x")
    files = folders.list_files(spark, str(lake))
    assert files.rdd.getNumPartitions() == 1 + 2 + 4  # the root, each test, each test and make
    got = sorted(r["path"].split("/lake/")[1] for r in files.collect())
    want = sorted(r["path"].split("/lake/")[1] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(str(lake)).select("path").collect())
    assert got == want and len(got) == 10
    assert folders.list_files(spark, str(tmp_path / "none")).count() == 0
    assert folders.can_open("s3a://b/k") and not folders.can_open("viewfs://c/d")
    with pytest.raises(ValueError, match="cannot open"):
        folders.opened("wasbs://x/y")


def _result_row(spark, **values):
    row = {**dict.fromkeys(DATA_COLS), **dict(make="M", max_cap="1.0", cell="c", batch="b"), **values}
    return spark.createDataFrame([tuple(row[c] for c in tables.RESULT_TABLE_SCHEMA.names)], tables.RESULT_TABLE_SCHEMA)


def test_blank_values_never_erase(spark):
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 9)
    old = _result_row(spark, Soh=90.0, q_rpt_ah=1.0, r_dc_curve=[1.0], chemistry="LFP", test_session_start=early, test_session_end=late)
    new = _result_row(
        spark, Soh=None, q_rpt_ah=float("nan"), r_dc_curve=[], chemistry=" \t", qc_flag="", q_rpt_chg_ah=2.0,
        test_session_start=dt.datetime(2024, 1, 5), test_session_end=dt.datetime(2024, 1, 6),
    )
    merged = merge_results(new, old)
    row = merged.first()
    assert (row["Soh"], row["q_rpt_ah"], row["r_dc_curve"], row["chemistry"], row["q_rpt_chg_ah"]) == (90.0, 1.0, [1.0], "LFP", 2.0)
    assert row["qc_flag"] is None and (row["test_session_start"], row["test_session_end"]) == (early, late)
    assert merge_results(merged, merged).first() == row  # a second time changes nothing
    replaced = merge_results(new, old, widen_session=False).first()
    assert replaced["test_session_start"] == dt.datetime(2024, 1, 5)


def test_conform_rules(spark):
    df = spark.createDataFrame(
        [("7", " eve", " Rest ", "1", "x", "2024-01-01 00:00:00"), ("123456", "a", "Rest", None, "nan", "2024-01-01 00:00:00"),
         ("8", "a", None, "1", "1", "2024-01-01 00:00:00"), ("8", "a", "Rest", "1", "1", None)],
        ["Cell", "Make", "Step name", "Cycle No", "volt(V)", "Absolute time"],
    )
    got = collect(ingest.conform(df), "cell_no")
    assert [(r["cell_no"], r["make"], r["step_name"], r["cycle_no"], r["volt_v"]) for r in got] == [
        ("0007", " EVE", "Rest", 1, None), ("123456", "A", "Rest", None, None)
    ]
    assert all(r["max_cap"] is None and r["test"] is None for r in got)


def test_csv_with_missing_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("step_name,absolute_time,cell_no,volt_v\nRest,2024-01-01 00:00:00,3,3.3\n")
    row = ingest.read_csv(spark, str(tmp_path / "a.csv")).first()
    assert (row["cell_no"], row["volt_v"], row["current_a"]) == ("0003", 3.3, None)


def test_cells_of_a_csv_without_make_and_batch_have_one_row(spark, tmp_path):
    """Sessions, curves and capacities of a cell meet whether or not its keys are known."""
    names = ["cell_no", "cycle_no", "step_name", "absolute_time", "volt_v", "current_a", "capacity_ah", "max_cap", "test"]
    rows = raw(spark, _ocv(), _rest(), _rpt(), Cell("RPT", cell="None").step("CC_DChg", 3600, 5, -9.0)).select(*names)
    rows.coalesce(1).write.option("header", True).csv(str(tmp_path / "csv"))
    found = ingest.read_csv(spark, str(tmp_path / "csv"))
    got = {r["cell_no"]: r for r in wide.build_wide(found).collect()}
    assert set(got) == {"0001", "None"} and len(got) == 2
    one = got["0001"]
    assert one["make"] is None and one["batch"] is None and one["max_cap"] == 100.0
    assert len(one["v_oc_curve"]) == 11 and one["q_rpt_ah"] == 90.0 and one["self_disch_v_start_v"] == 3.5 and one["test_session_start"] is not None
    for name in ("ocv", "self_discharge", "cycles_rpt"):
        jobs.run_job(found, name, str(tmp_path / "out"))
    merged = {r["cell_no"]: r for r in jobs.consolidate(spark, str(tmp_path / "out")).collect()}
    assert set(merged) == {"0001", "None"} and len(merged["0001"]["v_oc_curve"]) == 11 and merged["0001"]["q_rpt_ah"] == 90.0


def test_keys_come_back_as_they_were(spark):
    from cellspark.operators import segment

    keys = [(None, "None", "", 1.0), ("\x00", None, "b", None), ("\x00\x00a", "m", None, float("inf"))]
    rows = raw(spark, *[Cell("T", cell=c, make=m, batch=b, max_cap=x).step("Rest", 1, 1) for c, m, b, x in keys])
    marked = segment.with_keys(rows)
    assert all(r[k] is not None for r in marked.collect() for k in segment.KEYS)
    assert {tuple(r) for r in segment.restore_keys(marked).select("cell_no", "make", "batch", "max_cap").collect()} == set(keys)


def test_jobs_write_tables_and_consolidate(spark, tmp_path):
    out = str(tmp_path / "out")
    data = raw(spark, _ocv(), _rest(), _rpt())
    for name in ("ocv", "self_discharge", "cycles_rpt"):
        jobs.run_job(data, name, out)
    jobs.run_job(data.withColumn("batch", F.lit("2")), "cycles_rpt", out)  # other folders stay
    table = tables.read_test_table(spark, f"{out}/CYCLES_RPT", jobs.JOBS["cycles_rpt"].schema)
    assert table.where("make = 'M' and batch = '1'").count() == 1 and table.count() == 2
    merged = jobs.consolidate(spark, out)
    tables.write_consolidated_csv(merged, str(tmp_path / "csv"), chemistry="NMC")
    rows = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv")).orderBy("batch").collect()
    assert [r["batch"] for r in rows] == ["1", "2"] and {r["chemistry"] for r in rows} == {"NMC"}
    assert len(json.loads(rows[0]["v_oc_curve"])) == 11 and rows[1]["v_oc_curve"] is None
    assert rows[0]["test_session_start"] is None and float(rows[0]["Soh"]) == 90.0


def test_table_gains_missing_columns(spark, tmp_path):
    spark.sql(
        f"CREATE TABLE narrow (cohort string, make string, max_cap string, cell string, batch string) USING parquet "
        f"PARTITIONED BY (make, max_cap, cell, batch) LOCATION '{tmp_path}/narrow'"
    )
    added = tables.ensure_table(spark, "narrow", f"{tmp_path}/narrow")
    assert len(added) == len(RESULT.names) - 1 and tables.ensure_table(spark, "narrow", "") == []


def test_drift_without_a_curve_and_conflicting_capacities(spark):
    data = raw(spark, _rest(), Cell("OCVSOC", cell="1", max_cap=99.0).step("CC_DChg", 60, 25, -1.0))
    parts = [wide.ocv_arrays(extract_ocv_curves(data)), wide.self_discharge_columns(extract_self_discharge(data))]
    rows = wide.assemble(wide.sessions(data), parts)
    got = {r["max_cap"]: r["self_disch_dsoc_per_day"] for r in wide.with_dsoc_per_day(rows).collect()}
    assert got == {99.0: None, 100.0: pytest.approx(1.0)}
    assert wide.capacity_conflicts(rows).first()["rows"] == 2


def test_watermark_precedence():
    assert tables.watermark({"last_run_date": "2024-01-01"}) == "2024-01-01"
    assert tables.watermark({"last_run_date": "2024-01-01"}, since="2023-01-01") == "2023-01-01"
    assert tables.watermark({"last_run_date": "2024-01-01"}, "2023-01-01", full=True) == tables.watermark({}) == "1970-01-01"


def test_empty_inputs(spark):
    from cellspark.operators.hppc import detect_hppc_pulses

    empty = detect_hppc_pulses(raw(spark, Cell("RPT").step("Rest", 60, 3)))
    assert empty.dtypes == [(f.name, f.dataType.simpleString()) for f in PULSE.fields] and empty.count() == 0
