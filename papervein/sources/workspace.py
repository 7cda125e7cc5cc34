"""The folder of tables that stages read from and write to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Workspace:
    """Parquet tables under one root; schemas travel with the files."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def write(self, table: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """Overwrite the table and return it as read back, so later work starts from it."""
        writer = table.write.mode("overwrite")
        if partition_by:
            # One label then lies in files of its own and is skipped when not asked for.
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.path(name))
        return self.spark.read.schema(table.schema).parquet(self.path(name))

    def optional(self, name: str) -> DataFrame | None:
        """The table, or None where an earlier stage has not written it."""
        try:
            return self.spark.read.parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def required(self, name: str) -> DataFrame:
        table = self.optional(name)
        if table is None:
            raise FileNotFoundError(f"{self.path(name)}: run the stage that writes it first")
        return table

    def export_csv(self, name: str) -> None:
        """A copy with a header row, for tools outside Spark."""
        target = self.path(f"csv/{name}")
        self.required(name).write.mode("overwrite").csv(target, header=True)
