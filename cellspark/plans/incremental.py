"""The incremental run: find changed cells, recompute them from their whole history, upsert their rows."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.functions.lineage import cut
from cellspark.plans.ledger import Ledger
from cellspark.plans.select import changed_groups, only_cells, rows_of, with_dependencies
from cellspark.plans.upsert import merge_results
from cellspark.plans.wide import build_wide, capacity_conflicts, with_dsoc_per_day
from cellspark.sources.details import write_details
from cellspark.sources.ingest import GROUP_PARTITIONS, conform, inventory, padded, read_lake
from cellspark.sources.tables import (
    RESULT_TABLE_SCHEMA,
    load_state,
    read_results,
    register_partitions,
    result_rows,
    save_state,
    watermark,
    write_results,
)


class Run(NamedTuple):
    """What a run did.

    Its rows (None if nothing was selected), the date it advanced to, the partitions it registered, the number
    of cells whose tests disagree on the capacity, and of padded cell ids that stand for more than one id.
    """

    rows: DataFrame | None
    advanced_to: str | None = None
    registered: int = 0
    conflicting: int = 0
    merged_ids: int = 0


def merged_ids(groups: DataFrame) -> int:
    """Cells whose padded id covers several ids of the lake, such as ``1`` and ``0001``."""
    return (
        groups.groupBy(F.upper("Make"), "Batch", padded(F.col("Cell")))
        .agg(F.count_distinct("Cell").alias("n"))
        .where("n > 1")
        .count()
    )


def compute_rows(lake: DataFrame, groups: DataFrame) -> DataFrame:
    """Result rows of every cell touched by ``groups``."""
    return result_rows(with_dsoc_per_day(build_wide(conform(rows_of(lake, groups)))))


def run_name(files: DataFrame, groups: DataFrame, *request) -> str:
    """A name for what a run has to do: the request, and the files of the groups it covers."""
    own = files.join(groups.select(*GROUP_PARTITIONS), GROUP_PARTITIONS, "left_semi")
    seen = own.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("path")).alias("h")).first()
    return hashlib.sha256(repr((*request, seen["n"], seen["h"])).encode()).hexdigest()[:24]


def upsert(spark: SparkSession, ledger: Ledger, compute: Callable[[], DataFrame], output: str, table: str | None = None, widen_session: bool = True) -> tuple[DataFrame, int]:
    """Compute result rows, merge them into the table at ``output``, replacing only their partitions, and register those.

    Returns the merged rows and the number of partitions registered. Every phase is noted when it is over and is not
    done again by the same run; one that was cut short is repeated, with the same outcome. Details are written before
    the rows that point at them.
    """
    rows = ledger.table("rows", compute, RESULT_TABLE_SCHEMA)
    merged = ledger.table("merged", lambda: merge_results(rows, read_results(spark, output), widen_session), RESULT_TABLE_SCHEMA)

    def write() -> int:
        files = write_details(merged, output_details(output))
        write_results(merged, output)
        return files

    ledger.once("written", write)
    registered = ledger.once("registered", lambda: register_partitions(spark, table, output, merged) if table else 0)
    return merged, int(registered)


def output_details(output: str) -> str:
    """Where the details of a result table lie: beside it, so that its readers do not meet them."""
    return f"{output.rstrip('/')}_details"


def run_incremental(
    spark: SparkSession,
    lake: str,
    output: str,
    state: str,
    since: str | None = None,
    full: bool = False,
    makes: list[str] | None = None,
    cells: list[str] | None = None,
    dry_run: bool = False,
    table: str | None = None,
    widen_session: bool = True,
) -> Run:
    """Process what arrived after the stored date (or ``since``; everything if ``full``).

    ``makes`` and ``cells`` (``MAKE:BATCH:CELL``) restrict the run; a restricted run leaves the stored date
    alone, since it has not seen everything up to it. ``dry_run`` computes the rows and writes nothing.
    ``table`` names a catalog table to create, widen and register partitions in. A run that died is taken up by the
    next one that has the same to do, from the last phase in its ledger (beside ``state``).
    """
    stored = load_state(spark, state)
    files = cut(inventory(spark, lake))
    changed = changed_groups(files, watermark(stored, since, full), makes)
    groups = with_dependencies(changed, files, makes)
    if cells:
        groups = only_cells(groups, cells)
    groups = cut(groups)
    if groups.isEmpty():
        return Run(None)

    def compute() -> DataFrame:
        return compute_rows(read_lake(spark, lake), groups)

    if dry_run:
        return Run(merge_results(cut(compute()), read_results(spark, output), widen_session))

    ledger = Ledger(spark, f"{state.rstrip('/')}_runs", run_name(files, groups, since, full, makes, cells, table, widen_session))
    merged, registered = upsert(spark, ledger, compute, output, table, widen_session)
    counts = {"conflicting": capacity_conflicts(merged.withColumnRenamed("cell", "cell_no")).count(), "merged_ids": merged_ids(groups)}
    newest = None if makes or cells else files.agg(F.max("date")).first()[0]
    if newest is not None:
        save_state(spark, state, newest, stored.get("table") or table or output)
    ledger.record("done", newest or "")
    return Run(merged, newest, registered, **counts)
