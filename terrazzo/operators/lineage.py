"""Cutting lineage where a plan would be evaluated again and again."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """df as a checkpoint in the folder of spark.checkpoint.dir, which all executors share; a temporary folder stands in
    only where none is set and the master is local, as in tests."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="terrazzo-"))
    return df.checkpoint()
