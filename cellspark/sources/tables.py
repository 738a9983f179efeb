"""Result tables: writers, readers, run state and catalog upkeep."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.schemas import RESULT, RESULT_PARTITIONS

COMPRESSION = "snappy"
RESULT_TABLE_SCHEMA = T.StructType(
    RESULT.fields + [T.StructField(name, T.StringType()) for name in RESULT_PARTITIONS]
)
STATE_SCHEMA = "last_run_date string, table string, saved_at timestamp"
EPOCH = "1970-01-01"
PARTITIONS_AT_ONCE = 200


def write_test_table(df: DataFrame, path: str, compression: str = COMPRESSION) -> None:
    """One protocol's results, in folders by make and batch; only folders that get rows are replaced.

    ``rebalance`` evens out the files: small folders share a task, a big one is split over several.
    """
    (
        df.hint("rebalance", "make", "batch")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy("make", "batch")
        .parquet(path)
    )


def read_test_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of ``write_test_table``; filters on make and batch prune folders."""
    return spark.read.schema(schema).parquet(path)


def result_rows(wide: DataFrame) -> DataFrame:
    """Wide cell rows with the text partition columns of the result table; no capacity reads ``unknown``."""
    cap = F.coalesce(F.col("max_cap").cast("string"), F.lit("unknown"))
    return wide.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in RESULT.fields],
        "make",
        cap.alias("max_cap"),
        F.col("cell_no").alias("cell"),
        "batch",
    )


def write_results(rows: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    """Replace the partitions of ``rows`` in the result table, one file each.

    ``partitions`` may name fewer levels (make and batch, say) where a folder per cell is too fine. Then a
    folder holds many cells, so ``rows`` must contain all of them.
    """
    partitions = partitions or RESULT_PARTITIONS
    (
        rows.repartition(*partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy(*partitions)
        .parquet(path)
    )


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The result table, empty if nothing was written yet; filters on partition columns prune folders."""
    try:
        return spark.read.schema(RESULT_TABLE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], RESULT_TABLE_SCHEMA)


def write_consolidated_csv(wide: DataFrame, path: str, chemistry: str | None = None) -> None:
    """One CSV row per cell, curves as JSON lists."""
    cols = [
        F.to_json(name).alias(name) if dtype.startswith("array") else F.col(name) for name, dtype in wide.dtypes
    ]
    out = wide.select(*cols)
    if chemistry:
        out = out.withColumn("chemistry", F.lit(chemistry))
    out.write.mode("overwrite").option("header", True).csv(path)


def save_state(spark: SparkSession, path: str, last_run_date: str, table: str) -> None:
    """Record the date processed so far. States are appended, so a lost job never loses the previous one."""
    spark.range(1).select(
        F.lit(last_run_date).alias("last_run_date"), F.lit(table).alias("table"), F.current_timestamp().alias("saved_at")
    ).write.mode("append").json(path)


def latest_states(states: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The state saved last (of each of ``keys``); of states saved at once, the one with the greatest date and table."""
    last = F.max(F.struct("saved_at", "last_run_date", "table")).alias("s")
    return states.groupBy(*(keys or [])).agg(last).select(*(keys or []), "s.last_run_date", "s.table")


def load_state(spark: SparkSession, path: str) -> dict:
    """The latest state, or an empty one."""
    try:
        states = spark.read.schema(STATE_SCHEMA).json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return {}
    latest = latest_states(states).first()
    return {} if latest["last_run_date"] is None else latest.asDict()


def watermark(state: dict, since: str | None = None, full: bool = False) -> str:
    """Date after which data counts as new: everything on ``full``, else ``since``, else the stored date."""
    return EPOCH if full else since or state.get("last_run_date") or EPOCH


def ensure_table(spark: SparkSession, name: str, path: str) -> list[str]:
    """Create the catalog table over ``path``, or add columns it lacks; returns the added columns."""
    wanted = {f.name: f.dataType.simpleString() for f in RESULT.fields}
    if not spark.catalog.tableExists(name):
        cols = ", ".join(f"`{c}` {t}" for c, t in wanted.items())
        parts = ", ".join(f"`{c}` string" for c in RESULT_PARTITIONS)
        spark.sql(
            f"CREATE TABLE {name} ({cols}, {parts}) USING parquet PARTITIONED BY ({', '.join(RESULT_PARTITIONS)}) "
            f"LOCATION '{path}'"
        )
        return list(wanted)
    have = {c.lower() for c in spark.table(name).columns}
    missing = [c for c in wanted if c.lower() not in have]
    if missing:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{c}` {wanted[c]}' for c in missing)})")
    return missing


def register_partitions(spark: SparkSession, name: str, path: str, written: DataFrame) -> int:
    """Add the partitions of ``written`` to the catalog table, those it has already excepted; returns their number.

    Only what was written is looked at, a few hundred partitions at a time; no folder is listed.
    """
    ensure_table(spark, name, path)
    total, batch = 0, []

    def literal(value: str | None) -> str:
        return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def add() -> None:
        specs = " ".join(f"PARTITION ({', '.join(f'`{c}` = {literal(row[c])}' for c in RESULT_PARTITIONS)})" for row in batch)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")

    for row in written.select(*RESULT_PARTITIONS).distinct().toLocalIterator():
        batch.append(row)
        total += 1
        if len(batch) == PARTITIONS_AT_ONCE:
            add()
            batch = []
    if batch:
        add()
    return total
