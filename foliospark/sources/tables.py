"""Writing result tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import RESET_ORDER, TABLES, empty

BATCH = "batch_id"


def read_if_there(spark: SparkSession, schema: str, path: str) -> DataFrame | None:
    """A Parquet folder, or nothing if no batch has written it yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class TableFolder:
    """The stored tables below one folder that all executors can reach.

    Rows are appended under the id of the batch that made them.  Writing a batch
    again replaces that batch's rows only, so a restarted stream adds nothing
    twice.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def write(self, table: str, df: DataFrame, batch: int) -> None:
        (
            df.withColumn(BATCH, F.lit(batch).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .parquet(self.path(table))
        )

    def read(self, table: str, before: int | None = None, only: int | None = None) -> DataFrame:
        """The table's rows, on request only those of earlier batches or of one batch."""
        # The schema names the partition column as well, so nothing is inferred.
        rows = read_if_there(self.spark, f"{TABLES[table]}, {BATCH} bigint", self.path(table))
        if rows is None:
            return empty(self.spark, table)
        if before is not None:
            rows = rows.filter(F.col(BATCH) < before)
        if only is not None:
            rows = rows.filter(F.col(BATCH) == only)
        return rows.drop(BATCH)

    def reset(self, tables: tuple[str, ...] = RESET_ORDER) -> DataFrame:
        """Empty the tables in dependency order and report their row counts."""
        for table in tables:
            empty(self.spark, table).withColumn(BATCH, F.lit(0).cast("bigint")).write.mode("overwrite").option(
                "partitionOverwriteMode", "static"
            ).partitionBy(BATCH).parquet(self.path(table))
        return table_counts({t: self.read(t) for t in tables})


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def save_snapshot(df: DataFrame, root: str, version: int) -> str:
    """Write a rewritten table as a new version beside the old one.

    The version read to compute ``df`` stays untouched until readers move on.
    """
    target = f"{root.rstrip('/')}/version={version:08d}"
    df.write.mode("errorifexists").parquet(target)
    return target


def append_to(df: DataFrame, name: str) -> None:
    """Append to a catalog table, which is created on first use."""
    df.write.mode("append").saveAsTable(name)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header; quotes inside values are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
