"""Choosing a join by measured size, and numbering rows without one big task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papervein.operators.checkpoints import cut_lineage

# A broadcast side is held whole by every executor, so it must be measured first.
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(table: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True if the table's measured size is within ``max_bytes``.

    Costs one map-side aggregation over the look-up table; nothing but its size
    reaches the driver.
    """
    row_bytes = F.lit(32 * len(table.columns))
    for name in table.columns:
        row_bytes = row_bytes + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    size = table.agg(F.sum(row_bytes.cast("long")).alias("size")).first()["size"]
    return (size or 0) <= max_bytes


def sized(table: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The table, marked for broadcast when it fits.

    Above the bound it is left to a shuffled join, whose hot keys adaptive execution splits.
    """
    return F.broadcast(table) if fits_broadcast(table, max_bytes) else table


def literal_table(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """A small table of constants, planned as a local relation with a known size."""
    names = [column.split()[0] for column in schema.split(",")]
    args, tuples = {}, []
    for r, row in enumerate(rows):
        for c, value in enumerate(row):
            args[f"v{r}_{c}"] = value
        tuples.append("(" + ", ".join(f":v{r}_{c}" for c in range(len(row))) + ")")
    casts = ", ".join(
        f"CAST(col{i + 1} AS {column.split()[1]}) AS {names[i]}"
        for i, column in enumerate(schema.split(","))
    )
    return spark.sql(f"SELECT {casts} FROM VALUES {', '.join(tuples)}", args=args)


def spread(df: DataFrame) -> DataFrame:
    """Repartition only an input with fewer splits than there are cores.

    A large table already has many splits and is returned as it is, unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def numbered_rows(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Add ``name``: 0, 1, 2 ... in a total order of all rows.

    The rows are range-partitioned and sorted; a row's number is its place in its partition
    after the counts of the partitions before, one number each on the driver.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = cut_lineage(sorted_rows.select("*", F.spark_partition_id().alias("_part"), place.alias("_place")))
    counts = sorted((row["_part"], row["count"]) for row in placed.groupBy("_part").count().collect())
    before, offsets = 0, []
    for part, count in counts:
        offsets.append((part, before))
        before += count
    if not offsets:
        return placed.select(*df.columns, F.col("_place").alias(name))
    starts = literal_table(df.sparkSession, "_part INT,_before LONG", offsets)
    return placed.join(starts, "_part").select(*df.columns, (F.col("_before") + F.col("_place")).alias(name))


def first_rows(df: DataFrame, group: str, n: int | Column, *order: Column) -> DataFrame:
    """The first n rows of each group in a total order.

    Spark keeps only n rows per group and task before the shuffle, so a hot group
    never meets in one task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")
