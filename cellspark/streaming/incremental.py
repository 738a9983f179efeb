"""The incremental run as a stream over the lake.

The stream's checkpoint remembers every file seen, so a file that lands late on a date already processed is picked
up, which a stored date cannot do. Beside it lies a table of all groups seen so far with their folders: a batch finds
its groups' partners there and reads the folders of its own groups only, so the lake is not listed again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellspark.functions.lineage import cut
from cellspark.plans.incremental import compute_rows, upsert
from cellspark.plans.ledger import Ledger
from cellspark.plans.select import with_dependencies
from cellspark.schemas import PROCESSED_TESTS
from cellspark.sources.ingest import GROUP_PARTITIONS, read_lake

GROUPS_SCHEMA = "Test string, Make string, Batch string, Cell string, folder string, newest string, batch_id bigint"
#: Up to so many folders are named to the reader one by one; beyond, the lake is listed and pruned by the groups.
FOLDERS_AT_ONCE = 2_000


def known_groups(spark: SparkSession, state: str) -> DataFrame:
    """Every group seen by any batch: its folders, and the newest date it had then."""
    try:
        return spark.read.schema(GROUPS_SCHEMA).parquet(f"{state}/groups")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], GROUPS_SCHEMA)


def group_states(spark: SparkSession, state: str) -> DataFrame:
    """(Test, Make, Batch, Cell, newest): the newest date of each group over all batches."""
    return known_groups(spark, state).groupBy(*GROUP_PARTITIONS).agg(F.max("newest").alias("newest"))


def stream_incremental(
    spark: SparkSession, lake: str, output: str, checkpoint: str, max_files: int | None = None, table: str | None = None
) -> StreamingQuery:
    """Process all files that arrived since the last run, then stop.

    Each batch only tells which groups changed; their rows are recomputed from their whole history, with partner
    tests, upserted and, if ``table`` names a catalog table, registered. A batch has its phases in a ledger, and
    replaying it goes on from the last one.
    """
    state = f"{checkpoint.rstrip('/')}_state"
    arrivals = spark.readStream.schema(read_lake(spark, lake).schema).option("basePath", lake)
    if max_files:
        arrivals = arrivals.option("maxFilesPerTrigger", max_files)
    # the metadata has the path as a URL
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    folder = F.regexp_extract(path, "^(.*/Cell=[^/]*)/", 1)
    date = F.concat_ws("-", "YYYY", F.lpad("MM", 2, "0"), F.lpad("DD", 2, "0"))
    arrivals = arrivals.parquet(lake).where(F.col("Test").isin(*PROCESSED_TESTS)).select(*GROUP_PARTITIONS, folder.alias("folder"), date.alias("date"))

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        seen = batch.groupBy(*GROUP_PARTITIONS, "folder").agg(F.max("date").alias("newest")).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        # a batch that is replayed writes its own folder again
        seen.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{state}/groups")
        known = known_groups(session, state)
        groups = cut(with_dependencies(known.where(F.col("batch_id") == batch_id).select(*GROUP_PARTITIONS).distinct(), known))
        if groups.isEmpty():
            return

        def compute() -> DataFrame:
            return compute_rows(history(session, lake, known, groups), groups)

        ledger = Ledger(session, state, f"batch-{batch_id}", again=False)
        if not ledger.done:  # else the stream died after the batch, before it noted so itself
            upsert(session, ledger, compute, output, table)
            ledger.record("done")

    return arrivals.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def history(spark: SparkSession, lake: str, known: DataFrame, groups: DataFrame) -> DataFrame:
    """The lake, as far as it can hold rows of the groups."""
    folders = known.join(groups.select(*GROUP_PARTITIONS), GROUP_PARTITIONS, "left_semi").select("folder").distinct()
    some = [r["folder"] for r in folders.limit(FOLDERS_AT_ONCE + 1).collect()]
    return read_lake(spark, lake, folders=some if len(some) <= FOLDERS_AT_ONCE else None)
