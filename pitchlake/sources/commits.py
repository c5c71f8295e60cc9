"""Changes of a partitioned table, each as a whole.

A change is staged beside the table: whole new partitions, and for each a small index of
its keys.  Then a record of what is to be moved in and what is to go is put in the
table's folder by one rename; from then on the change counts.  Last the partitions
are moved.  A driver lost before the record leaves the table as it was; one lost after it
leaves the record, by which readers read the staged partitions in place of the old ones
and the next writer finishes the moves.  Every move can be repeated.

One writer at a time is assumed, and a file system that renames in one step.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
RECORD, INDEX, STAGING = "_change", "_keys", "__staging_"
#: Bits of an index and hashes of a key; it tells some 6,000 keys of a partition apart, beyond
#: that only their least and greatest.  Of more arriving keys than ``LOOKED_UP`` it is not asked.
BITS, HASHES, LOOKED_UP = 1 << 16, 3, 10_000


class Files:
    """The few operations on a file system that a change needs."""

    def __init__(self, spark: SparkSession, path: str):
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._text = spark._jvm.org.apache.commons.io.IOUtils
        self._files = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._files.exists(self._at(path))

    def folders(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(self._at(path)) if s.isDirectory())

    def delete(self, path: str) -> None:
        self._files.delete(self._at(path), True)

    def make(self, path: str) -> None:
        self._files.mkdirs(self._at(path))

    def move(self, source: str, target: str) -> None:
        if not self._files.rename(self._at(source), self._at(target)):
            raise OSError(f"{source} could not be moved to {target}")

    def write(self, path: str, text: str) -> None:
        out = self._files.create(self._at(path), True)
        try:
            out.write(text.encode())
        finally:
            out.close()

    def read(self, path: str) -> str:
        stream = self._files.open(self._at(path))
        try:
            return self._text.toString(stream, "UTF-8")
        finally:
            stream.close()


@dataclass
class Change:
    """staging: folder; put, gone: names of partition folders; index: "new", "keep" or "drop"."""

    staging: str
    put: list[str]
    gone: list[str]
    index: str = "drop"


def pending(files: Files, path: str) -> Change | None:
    """The change that counts but is not all moved in yet."""
    return Change(**json.loads(files.read(f"{path}/{RECORD}"))) if files.exists(f"{path}/{RECORD}") else None


def finish(files: Files, path: str, change: Change) -> None:
    """Move a change in; what was moved before stays as it is."""
    for inside in (f"/{INDEX}", ""):
        staged, stored = set(files.folders(f"{change.staging}{inside}")), set(files.folders(f"{path}{inside}"))
        if staged:
            files.make(f"{path}{inside}")
        dropped = {*change.gone, *(change.put if inside and change.index == "drop" else ())}
        for name in change.put:
            if name in staged:
                if name in stored:
                    files.delete(f"{path}{inside}/{name}")
                files.move(f"{change.staging}{inside}/{name}", f"{path}{inside}/{name}")
        for name in sorted(dropped & stored):
            files.delete(f"{path}{inside}/{name}")
    files.delete(change.staging)
    files.delete(f"{path}/{RECORD}")


def recover(spark: SparkSession, path: str) -> None:
    """Finish a change that counts, remove what was staged and never did.  For writers."""
    files, path = Files(spark, path), path.rstrip("/")
    if (change := pending(files, path)) is not None:
        finish(files, path, change)
    parent, _, own = path.rpartition("/")
    for name in files.folders(parent or "/"):
        if name.startswith(f"{own}{STAGING}"):
            files.delete(f"{parent}/{name}")


def new_staging(path: str) -> str:
    return f"{path.rstrip('/')}{STAGING}{uuid.uuid4().hex}"


def commit(spark: SparkSession, path: str, staging: str, gone: list[str], index: str) -> None:
    """Make a staged change count and move it in."""
    files, path = Files(spark, path), path.rstrip("/")
    put = [n for n in files.folders(staging) if not n.startswith("_")]
    change = Change(staging, put, sorted(set(gone) - set(put)), index)
    files.make(path)
    files.write(f"{staging}/{RECORD}", json.dumps(asdict(change)))
    files.move(f"{staging}/{RECORD}", f"{path}/{RECORD}")
    finish(files, path, change)


def read_through(spark: SparkSession, path: str, schema: T.StructType, files: Files, change: Change) -> DataFrame:
    """The table as it is once a pending change is moved in."""
    waiting = [n for n in change.put if files.exists(f"{change.staging}/{n}")]
    hidden = {*waiting, *change.gone}
    stored = [n for n in files.folders(path) if not n.startswith("_") and n not in hidden]
    reader = lambda base, names: spark.read.schema(schema).option("basePath", base).parquet(*(f"{base}/{n}" for n in names))
    parts = [reader(base, names) for base, names in ((path, stored), (change.staging, waiting)) if names]
    if not parts:
        return spark.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def partition_name(by: str, value) -> str:
    return f"{by}={NULL_PARTITION if value is None else value}"


def _hashes(key: str) -> Column:
    return F.array(*(F.pmod(F.xxhash64(F.lit(i), key), F.lit(BITS)) for i in range(HASHES)))


def write_index(spark: SparkSession, staging: str, schema: T.StructType, key: str, by: str) -> None:
    """Beside each staged partition the Bloom filter of its values of ``key``, in pieces,
    with the least and greatest value of each piece."""
    if not [n for n in Files(spark, staging).folders(staging) if not n.startswith("_")]:
        return
    held = spark.read.schema(schema).parquet(staging).select(by, key).where(F.col(key).isNotNull()).distinct()
    probes = held.select(by, key, F.explode(_hashes(key)).alias("h"))
    pieces = probes.groupBy(by, F.bitmap_bucket_number("h").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits"), F.min(key).alias("least"), F.max(key).alias("most")
    )
    pieces.repartition(by).write.partitionBy(by).parquet(f"{staging}/{INDEX}")


def may_hold(spark: SparkSession, path: str, arriving: DataFrame, key: str, by: str) -> set | None:
    """Values of ``by`` whose partitions may hold a value of ``key`` that arrives, and those
    without an index; None if too many keys arrive to ask for each.  A partition
    that holds one is never left out."""
    files, path = Files(spark, path), path.rstrip("/")
    keys = arriving.select(key).where(F.col(key).isNotNull()).distinct()
    n, low, high = keys.agg(F.count("*"), F.min(key), F.max(key)).first()
    if n > LOOKED_UP:
        return None
    kind = {f.name: f.dataType for f in arriving.schema}
    indexed = set(files.folders(f"{path}/{INDEX}"))
    bare = [unquote(x.partition("=")[2]) for x in files.folders(path) if not x.startswith("_") and x not in indexed]
    found = set()
    if bare:
        named = spark.createDataFrame([(None if v == NULL_PARTITION else v,) for v in bare], "v string")
        found = {r[0] for r in named.select(F.col("v").cast(kind[by])).collect()}
    if not n or not indexed:
        return found
    schema = T.StructType([T.StructField("piece", T.LongType()), T.StructField("bits", T.BinaryType())])
    schema = schema.add("least", kind[key]).add("most", kind[key]).add(by, kind[by])
    pieces = spark.read.schema(schema).parquet(f"{path}/{INDEX}").where((F.col("most") >= F.lit(low)) & (F.col("least") <= F.lit(high)))
    asked = keys.select(F.col(key).alias("_key"), F.posexplode(_hashes(key)).alias("_i", "_h"))
    asked = asked.select("_key", "_i", F.bitmap_bucket_number("_h").alias("piece"), F.bitmap_bit_position("_h").alias("_bit"))
    byte = F.conv(F.hex(F.substring("bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    there = F.col("_key").between(F.col("least"), F.col("most")) & (F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1)
    hits = pieces.join(asked, "piece").where(there).groupBy(by, "_key").agg(F.count("*").alias("n")).where(F.col("n") == HASHES)
    return found | {r[0] for r in hits.select(by).distinct().collect()}
