"""Folders for intermediate tables that all executors can read."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from pitchlake.sources.commits import Files


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in ``spark.checkpoint.dir``; only where that is unset and the master is
    this very machine a temporary one is taken, on a cluster it is an error."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir names no folder that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return f"{named or sc.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, folder: str) -> DataFrame:
    """The frame, computed and kept apart, after which the folder it read is removed."""
    df = df.checkpoint(eager=True)
    Files(df.sparkSession, folder).delete(folder)
    return df
