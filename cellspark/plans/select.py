"""Which (test, make, batch, cell) groups a run has to compute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.sources.ingest import GROUP_PARTITIONS

# Tests that must be loaded together, since a result of one needs the other.
DEPENDENCY_GROUPS = [("SelfDischarge", "OCVSOC")]


def changed_groups(files: DataFrame, since: str, makes: list[str] | None = None) -> DataFrame:
    """Groups with a file dated after ``since`` (strictly), optionally of some makes only."""
    if makes:
        files = files.where(F.col("Make").isin(*makes))
    return (
        files.groupBy(*GROUP_PARTITIONS)
        .agg(F.max("date").alias("last_date"))
        .where(F.col("last_date") > F.lit(since))
    )


def with_dependencies(changed: DataFrame, files: DataFrame, makes: list[str] | None = None) -> DataFrame:
    """The changed groups, plus the partner tests of the same cell that have any data."""
    if makes:
        files = files.where(F.col("Make").isin(*makes))
    partners = {
        test: [other for other in group if other != test] for group in DEPENDENCY_GROUPS for test in group
    }
    wanted = F.array(F.col("Test"))
    for test, others in partners.items():
        wanted = F.when(F.col("Test") == test, F.array(*[F.lit(t) for t in (test, *others)])).otherwise(wanted)
    expanded = changed.select(F.explode(wanted).alias("Test"), "Make", "Batch", "Cell").distinct()
    return expanded.join(files.select(*GROUP_PARTITIONS).distinct(), GROUP_PARTITIONS, "left_semi")


def only_cells(groups: DataFrame, cells: list[str]) -> DataFrame:
    """Groups of the listed cells, each written ``MAKE:BATCH:CELL``."""
    return groups.where(F.concat_ws(":", "Make", "Batch", "Cell").isin(*cells))


def rows_of(lake: DataFrame, groups: DataFrame) -> DataFrame:
    """The whole history of the groups; the join is on folder columns, so other folders are not read."""
    return lake.join(groups.select(*GROUP_PARTITIONS), GROUP_PARTITIONS, "left_semi")
