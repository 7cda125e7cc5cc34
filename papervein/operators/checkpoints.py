"""Cutting the lineage of iterative steps through the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session, else ``spark.checkpoint.dir``.

    Only a local-mode session without either gets a temporary folder; on a cluster that
    would be lost with its machine, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="papervein-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def written(df: DataFrame) -> DataFrame:
    """The table written to the checkpoint folder and read back.

    A checkpoint keeps what the optimizer has inferred about its columns.  Where one round's
    table is joined into the next one's that grows with every round; a written table starts afresh.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
