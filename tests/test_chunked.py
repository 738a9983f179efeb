"""The two-level operators against plain loops, with buckets small enough to be crossed often."""

import math
import random
import statistics

import pytest

from cellspark.functions import chunked
from cellspark.operators import segment, soc
from pyspark.sql import functions as F
from tests.builders import Cell, collect, raw


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(chunked, "STEP_BUCKET", 4)


def _random_cell(seed, cell, n=120):
    rng = random.Random(seed)
    c = Cell("T", cell=cell)
    for _ in range(n):
        c.step(rng.choice(["A", "B"]), rng.choice([0.0, 0.5, 3.0]), 1, current=rng.random(), cycle=rng.choice([1, 1, 1, None]))
    return c


@pytest.mark.parametrize("chunk_seconds", [1, 7, 10**8])
def test_islands_do_not_depend_on_slices(spark, chunk_seconds):
    cells = [_random_cell(k, f"{k:04d}") for k in range(4)]
    rows = segment.with_keys(raw(spark, *cells))
    got = collect(segment.label_islands(rows.repartition(7), chunk_seconds=chunk_seconds), "cell_no", "_idx")
    want = []
    for c in cells:
        block, last = 0, object()
        ordered = sorted(c.rows, key=lambda r: r["absolute_time"])
        for idx, r in enumerate(ordered, 1):
            key = (r["cycle_no"], r["step_name"])
            block, last = block + (key != last), key
            want.append((r["cell_no"], idx, block, r["step_name"]))
    assert [(g["cell_no"], g["_idx"], g["_block"], g["step_name"]) for g in got] == want


def test_ties_in_time_are_ordered_by_value(spark):
    c = Cell("T", numbered=False)
    for name, volts in [("B", 3.2), ("A", 3.1), ("A", 3.3)]:
        c.step(name, 0, 1, volts=volts)
        c.now = 0
    first = collect(segment.label_islands(segment.with_keys(raw(spark, c))), "_idx")
    again = collect(segment.label_islands(segment.with_keys(raw(spark, c)).orderBy(F.desc("volt_v"))), "_idx")
    assert first == again and [r["_block"] for r in first] == [1, 2, 3]


def test_neighbours_cross_buckets_and_gaps(spark, small_buckets):
    numbers = sorted(random.Random(1).sample(range(0, 60), 25))
    df = spark.createDataFrame([("k", n, f"s{n}") for n in numbers], "key string, n bigint, name string")
    got = collect(chunked.neighbours(df, ["key"], "n", ["name"], before="p", after="q"), "n")
    for pos, row in enumerate(got):
        assert (row["p"] or {}).get("name") == (f"s{numbers[pos - 1]}" if pos else None)
        assert (row["q"] or {}).get("name") == (f"s{numbers[pos + 1]}" if pos + 1 < len(numbers) else None)


def test_ordinal_counts_across_buckets(spark, small_buckets):
    df = spark.createDataFrame([(k, n, s) for k in "ab" for n in range(0, 30, 3) for s in (1, 0)], "key string, n int, s int")
    got = collect(chunked.ordinal(df, ["key"], "n", ["n", "s"], "i"), "key", "n", "s")
    assert [r["i"] for r in got] == list(range(1, 21)) * 2


def test_exact_median_of_a_hot_key(spark):
    rng = random.Random(3)
    values = {"hot": [rng.random() for _ in range(20001)], "even": [rng.choice([1.0, 2.0, 5.0]) for _ in range(40)], "one": [4.0], "two": [1.0, 9.0]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in [*vs, None]], "key string, v double")
    got = {r["key"]: r["m"] for r in chunked.exact_median(df, ["key"], "v", "m").collect()}
    assert got == {k: statistics.median(vs) for k, vs in values.items()}


def _fold(deltas):
    x, out = 1.0, []
    for d in deltas:
        out.append(x)
        x = min(max(x + d, 0.0), 1.0)
    return out


def _soc(spark, deltas):
    rows = [("0001", "M", "1", "100.0", b, 100.0 if d > 0 else -100.0, abs(d) * 100, 60.0) for b, d in enumerate(deltas, 1)]
    steps = spark.createDataFrame(
        rows,
        "cell_no string, make string, batch string, cap string, _block bigint, current_mean_a double, "
        "step_capacity_ah double, duration_s double",
    )
    return [r["soc"] for r in collect(soc.soc_at_step_start(steps), "_block")]


def test_charge_tracker_saturates(spark):
    assert _soc(spark, [-0.5, -0.7, 0.4, 0.9, -0.3]) == pytest.approx([1.0, 0.5, 0.0, 0.4, 1.0])


def test_charge_tracker_over_buckets(spark, small_buckets):
    deltas = [random.Random(5).uniform(-0.8, 0.8) for _ in range(1)] + [random.Random(k).uniform(-0.8, 0.8) for k in range(50)]
    assert _soc(spark, deltas) == pytest.approx(_fold(deltas), abs=1e-12)


def test_delta_falls_back_to_current_and_time(spark):
    steps = spark.createDataFrame(
        [(1, -36.0, None, 3600.0), (2, -36.0, 1e-9, 3600.0), (3, 1e-9, 5.0, 60.0), (4, None, 5.0, 60.0), (5, -36.0, None, 0.0), (6, 50.0, 5.0, 60.0)],
        "n int, current_mean_a double, step_capacity_ah double, duration_s double",
    ).withColumn("cap", F.lit("100.0"))
    got = [r["delta"] for r in collect(soc.with_delta(steps), "n")]
    assert got == pytest.approx([-0.36, -0.36, 0.0, 0.0, 0.0, 0.05])


def test_median_of_one_value_and_of_wide_ranges(spark):
    rng = random.Random(8)
    groups = {
        "same": [2.5] * 5000, "pair": [1.0, 4.0], "signs": [rng.uniform(-3, 3) for _ in range(301)], "tiny": [rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300) for _ in range(200)],
        "zero": [0.0, -0.0, 5.0, -5.0], "close": [3.2 + k * 1e-9 for k in range(1000)], "inf": [float("inf"), 1.0, 2.0, float("-inf")],
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("same", None)], "key string, v double")
    got = {r["key"]: r["m"] for r in chunked.exact_median(df, ["key"], "v", "m").collect()}
    assert got == {k: pytest.approx(statistics.median(v), abs=0) for k, v in groups.items()}


def test_median_of_many_near_values_is_found_in_small_groups(spark):
    """A million values between 3.3 and 3.3 + 1e-9 share their leading bits; no group of a round outgrows a digit's range."""
    n = 1_000_000
    rows = spark.range(n).select(F.lit("k").alias("key"), (F.lit(3.3) + F.col("id") * F.lit(1e-15)).alias("v"))
    assert chunked.exact_median(rows, ["key"], "v", "m").first()["m"] == pytest.approx(3.3 + (n - 1) / 2 * 1e-15, abs=1e-15)
    keys = rows.select(F.shiftright(chunked.order_key(F.col("v")), chunked.DIGIT_BITS).alias("above"), chunked.order_key(F.col("v")).alias("key")).distinct()
    assert keys.groupBy("above").count().agg(F.max("count")).first()[0] <= 1 << chunked.DIGIT_BITS < keys.count()


def test_order_keys_are_the_bits_of_a_double(spark):
    import struct

    rng = random.Random(4)
    values = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    values += [2.0**e for e in range(-1074, 1024)] + [x for e in range(-1021, 1023) for x in (math.nextafter(2.0**e, 0), math.nextafter(2.0**e, math.inf))]
    values += [0.0, -0.0, math.inf, -math.inf, 5e-324, -5e-324, 1.7976931348623157e308, 2.2250738585072014e-308, 2.225073858507201e-308]
    values = [v for v in values if not math.isnan(v)]

    def bits(v):
        whole = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        return -whole if v < 0 else whole

    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", chunked.order_key(F.col("v")).alias("k")).collect()
    assert all(r["k"] == bits(r["v"]) for r in got) and len(got) == len(values)
    nan = spark.sql("select double('NaN') as v, cast(null as double) as n").select(chunked.order_key(F.col("v")), chunked.order_key(F.col("n"))).first()
    assert nan[0] > bits(math.inf) and nan[1] is None


def test_charge_tracker_over_long_cells(spark):
    """Thousands of steps, several rounds inside a bucket and over buckets, two cells at once."""
    deltas = [random.Random(k).uniform(-0.3, 0.3) for k in range(9000)]
    assert _soc(spark, deltas) == pytest.approx(_fold(deltas), abs=1e-9)
    assert _soc(spark, []) == [] and _soc(spark, [-0.25]) == [1.0]


def test_order_values_are_the_doubles_again(spark):
    rng = random.Random(6)
    values = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-320, 308) for _ in range(2000)]
    values += [0.0, math.inf, -math.inf, 5e-324, -5e-324, 1.7976931348623157e308, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, -2.0]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    assert all(r["v"] == r["w"] for r in rows.withColumn("w", chunked.order_value(chunked.order_key(F.col("v")))).collect())
    assert spark.sql("select double('NaN') as v").select(F.isnan(chunked.order_value(chunked.order_key(F.col("v"))))).first()[0]


def test_steps_are_spread_by_samples_and_not_by_time(spark, small_buckets):
    """Samples of a step that lie ten years apart give it no more parts than they fill."""
    c = Cell("T").step("A", 60, 3).step("B", 10 * 365 * 86400, 9).step("A", 60, 2)
    rows = segment.with_part(segment.label_islands(segment.with_keys(raw(spark, c))))
    steps = segment.island_steps(rows, first_idx=F.min("_idx"))
    key = [*segment.KEYS, "_block", "_part"]
    spread = [tuple(r) for r in segment.over_parts(steps).select(*key).collect()]
    assert sorted(spread) == sorted(tuple(r) for r in rows.select(*key).distinct().collect()) and len(spread) == 5


def test_a_cell_of_few_samples_is_one_slice(spark, small_buckets):
    """Three samples years apart are one slice; a cell of more samples than a bucket has them by time."""
    few = Cell("T", cell="0001").step("A", 10 * 365 * 86400, 3)
    many = Cell("T", cell="0002").step("A", 9 * 3600, 10)
    got = segment.label_islands(segment.with_keys(raw(spark, few, many))).groupBy("cell_no").agg(F.count_distinct("_chunk").alias("n"))
    assert {r["cell_no"]: r["n"] for r in got.collect()} == {"0001": 1, "0002": 10}


@pytest.mark.parametrize("bucket", [4, 10**6])
def test_fallback_numbers_do_not_depend_on_slices(spark, monkeypatch, bucket):
    """Cells without, with some and with all step numbers, as one slice and as many."""
    monkeypatch.setattr(chunked, "STEP_BUCKET", bucket)
    plain = Cell("T", cell="0001", numbered=False)
    some, full = Cell("T", cell="0002", numbered=False), Cell("T", cell="0003")
    for c in (plain, some, full):
        c.step("A", 7200, 5).step("B", 7200, 5).step("B", 60, 2, cycle=2).step("A", 60, 2)
    some.numbered = True
    some.step("C", 60, 2)
    rows = segment.number_rows(segment.with_keys(raw(spark, plain, some, full)))
    got = [(r["cell_no"], r["_step_no"], r["step_name"], r["n_samples"]) for r in collect(segment.numbered_steps(rows), "cell_no", "_step_no")]
    assert got == [
        ("0001", 1, "A", 5), ("0001", 2, "B", 7), ("0001", 3, "A", 2), ("0002", 5, "C", 2),
        ("0003", 1, "A", 5), ("0003", 2, "B", 5), ("0003", 3, "B", 2), ("0003", 4, "A", 2),
    ]
