"""What a run has done so far, so that a run that dies goes on from there.

A ledger is a folder of appended rows (run, phase, detail, saved_at). A run is named by what it has to do, so the same
work started again finds its own phases; ``done`` closes a run, and the same work asked for once more begins anew.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = "run string, phase string, detail string, saved_at timestamp"
# Phases in their order: result rows stored, merged rows stored, details and rows written, partitions registered, finished.
PHASES = ("rows", "merged", "written", "registered", "done")


class Ledger:
    """The phases of one run below ``folder``. With ``again``, a run that is done begins anew under the same name."""

    def __init__(self, spark: SparkSession, folder: str, run: str, again: bool = True):
        self.spark, self.folder = spark, folder.rstrip("/")
        entries = self._entries().where(F.col("run").startswith(f"{run}-")).collect()  # a few rows of one run's name
        finished = {r["run"] for r in entries if r["phase"] == "done"}
        self.run = f"{run}-{len(finished) if again else 0}"
        self.phases = {r["phase"]: r["detail"] for r in entries if r["run"] == self.run}

    @property
    def done(self) -> bool:
        return "done" in self.phases

    def _entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER_SCHEMA).json(f"{self.folder}/ledger")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], LEDGER_SCHEMA)

    def record(self, phase: str, detail: str = "") -> None:
        """Note that a phase is over. Rows are appended, so a lost job never loses an earlier phase."""
        row = self.spark.range(1).select(F.lit(self.run).alias("run"), F.lit(phase).alias("phase"), F.lit(detail).alias("detail"), F.current_timestamp().alias("saved_at"))
        row.write.mode("append").json(f"{self.folder}/ledger")
        self.phases[phase] = detail

    def table(self, phase: str, compute, schema) -> DataFrame:
        """The table of a phase: computed and stored if the run has not done so, else read back."""
        path = f"{self.folder}/runs/{self.run}/{phase}"
        if phase not in self.phases:
            compute().write.mode("overwrite").parquet(path)
            self.record(phase, path)
        return self.spark.read.schema(schema).parquet(path)

    def once(self, phase: str, act) -> str:
        """What a phase noted when it was done, now or earlier; ``act`` returns the note and can be repeated."""
        if phase not in self.phases:
            self.record(phase, str(act()))
        return self.phases[phase]
