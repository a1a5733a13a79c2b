"""The finished steps of a day's run, from which a run that failed goes on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from snapstar.functions.columns import Day, run_date
from snapstar.session import remove
from snapstar.sinks.write import DAY
from snapstar.sources.tables import partition_values

STEP_DDL = "inputs string, finished timestamp"


def fingerprint(spark: SparkSession, *folders: str) -> str:
    """Of the files under the folders: names, sizes and times, added up by Spark. No file is opened."""
    found = []
    for folder in folders:
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found.append("none")
            continue
        each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        found.append(":".join(map(str, files.agg(F.count("*"), F.sum(each)).first())))
    return " ".join(found)


class Ledger:
    """What ran for a day, in ``root/_steps/snapshot_date=D``, a folder for each finished step.

    A step is left out if it finished with the same inputs and no step before it
    had to run again. Without ``resume`` nothing is left out.
    """

    def __init__(self, spark: SparkSession, root: str, day: Day, *, resume: bool = False, attempts: int = 1):
        self.spark, self.path = spark, f"{root}/_steps/{DAY}={run_date(day)}"
        self.attempts, self.again = attempts, not resume
        if not resume:
            remove(spark, self.path)

    def step(self, name: str, job: Callable[[], object], *inputs: str) -> bool:
        """Run the job, which reads the folders ``inputs``, unless it finished before; whether it ran.

        A job that raises is tried ``attempts`` times; then later steps don't run.
        """
        marks = fingerprint(self.spark, *inputs)
        if not self.again and self._finished(name) == marks:
            return False
        self.again = True
        remove(self.spark, f"{self.path}/step={name}")
        for left in reversed(range(self.attempts)):
            try:
                job()
                break
            except Exception:
                if not left:
                    raise
        done = self.spark.range(1).select(F.lit(marks).alias("inputs"), F.current_timestamp().alias("finished"))
        done.write.mode("overwrite").parquet(f"{self.path}/step={name}")
        return True

    def _finished(self, name: str) -> str | None:
        if name not in partition_values(self.spark, self.path, "step"):
            return None
        row = self.spark.read.schema(STEP_DDL).parquet(f"{self.path}/step={name}").first()
        return row and row.inputs
