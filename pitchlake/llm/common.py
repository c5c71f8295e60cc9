"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Records and bytes in one Arrow batch handed to Python.  Texts reach 100 kB and
#: more, so the default of 10,000 records could be a gigabyte.
BATCH_RECORDS, BATCH_BYTES = 500, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Get this session ready for Python workers: bound the memory of a batch (the
    same bound for all operators, so that none loosens another's), and send this
    package to executors, which need not have it installed."""
    now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if now <= 0 or now > BATCH_RECORDS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_RECORDS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if _shipped.get("to") != sc.applicationId:
        package = Path(__file__).parent.parent
        archive = Path(tempfile.mkdtemp(prefix="spark-code-")) / "pitchlake_code.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        sc.addPyFile(str(archive))
        _shipped["to"] = sc.applicationId


_shipped: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` where the
    cluster names one.  Only where it is unset and the master is this very machine
    (tests) a temporary folder is taken; on a cluster that is an error."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir names no folder that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return named or sc.getCheckpointDir()


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of intermediate tables, whatever file system it is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs removed now.  Spark does so when the
    driver happens to collect its garbage, which a job of many steps can't wait for."""
    gc.collect()
    spark._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage in the shared folder, so that a
    lost executor costs a read and not a recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


class Memo(dict):
    """A dict that fills itself by ``make``.  Past ``most`` entries it becomes the
    old half, which is looked at before anything is made anew, and a new half
    begins; so a worker's memory stays bounded and what is used often stays."""

    def __init__(self, make, most: int = 150_000):
        super().__init__()
        self.make, self.most, self.old = make, most // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if isinstance(key, int) or len(key) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
