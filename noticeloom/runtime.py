"""What operators share at run time: durable intermediate tables and size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Estimated bytes up to which a side may be broadcast. Of a written table these are compressed bytes, which unfold to ten
#: times as many and more.
BROADCAST_BYTES = 3 << 20


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, and only where that is unset a folder of our own. A
    cluster must name one, since its executors do not share a folder of this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="noticeloom-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


class Scratch:
    """Intermediate tables of one operator run. They are written in full to the shared folder, so that a lost
    executor costs a re-read and not a recomputation, and lineage ends there."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{scratch_folder(spark)}/loom-{uuid.uuid4().hex}"
        self.n = 0
        atexit.register(self.clear)

    def keep(self, df: DataFrame) -> DataFrame:
        """`df`, written and read again."""
        self.n += 1
        path = f"{self.folder}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def counted(self, df: DataFrame, condition: Column) -> tuple[DataFrame, int]:
        """keep() and the number of rows for which `condition` holds, counted while they are written."""
        seen = Observation()
        kept = self.keep(df.observe(seen, F.count_if(condition).alias("n")))
        return kept, seen.get["n"] or 0

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables of keep() that nothing reads any more."""
        for df in frames:
            for parent in {os.path.dirname(f) for f in df.inputFiles()}:
                self._delete(parent)

    def clear(self) -> None:
        """Delete everything; at the end of the program, when no result is read any more."""
        try:
            self._delete(self.folder)
        except Exception:  # noqa: BLE001 - the session may be gone
            shutil.rmtree(self.folder.removeprefix("file://").removeprefix("file:"), ignore_errors=True)

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; of a table just written, its size on disk."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`df` with a broadcast hint if its estimated size is proven to be within `limit`; otherwise unchanged, so that
    the join shuffles and adaptive execution splits skewed partitions."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """`df` divided by keys among as many tasks as the session shuffles to, for work in Python whose rows are small: adaptive
    execution would gather them by their bytes into a few tasks."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)


def apart(df: DataFrame, names: list[str]) -> DataFrame:
    """`df` with columns that would clash with the result columns `names` renamed to <column>_in (case does not matter)."""
    taken, made = {c.lower() for c in df.columns}, {n.lower() for n in names}
    out = []
    for c in df.columns:
        new = c
        while new.lower() in made or new != c and new.lower() in taken:
            new += "_in"
        out.append(new)
    return df.toDF(*out)


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once for each application, through the shared folder; they need not have it."""
    context = spark.sparkContext
    if getattr(context, "_noticeloom", None):
        return
    package = Path(__file__).resolve().parent
    made = Path(tempfile.mkdtemp(prefix="noticeloom-")) / "noticeloom.zip"
    with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(f"{scratch_folder(spark)}/code-{uuid.uuid4().hex}/noticeloom.zip")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).copyFromLocalFile(True, hadoop.Path(made.as_uri()), place)
    shutil.rmtree(made.parent, ignore_errors=True)
    context.addPyFile(place.toString())
    context._noticeloom = place.toString()
