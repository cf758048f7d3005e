"""Shared helpers of the training-data operators: the shared folder, staged
tables, a skew-safe lookup join and shipping the package to the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch handed to Python: with texts of up to some 100 kB a
#: batch stays at tens of MB.
ARROW_ROWS = 256

#: Parts that a hot lookup key is dealt out to.
SALTS = 32


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches and make this package importable on executors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so that they
    need no installed copy."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    target = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{package.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local session without
    that setting gets a private folder; any other session must name one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target)  # only an existing path can be marked
    fs.deleteOnExit(target)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage is cut
    and a lost executor takes nothing with it."""
    spark = df.sparkSession
    path = f"{scratch(spark, name)}/table"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores ahead until no column of ``df`` is named so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def salt(by: Column, salts: int | Column = SALTS) -> Column:
    return F.pmod(F.xxhash64(by), salts if isinstance(salts, Column) else F.lit(salts)).cast("int")


def attach(left: DataFrame, lookup: DataFrame, keys: Sequence[str], spread: str,
           how: str = "inner", salts: int = SALTS) -> DataFrame:
    """``left`` joined with a ``lookup`` of one row per key, where one key may
    hold a third of ``left``: each key's rows are dealt out by ``spread`` into
    ``salts`` parts, the lookup is fetched once per key and part, and no task
    needs a whole key. Keys must not be null."""
    dealt = left.withColumn("_salt", salt(F.col(spread), salts))
    parts = dealt.select(*keys, "_salt").distinct().join(lookup, list(keys), "inner")
    return dealt.join(parts, [*keys, "_salt"], how).drop("_salt")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Larger Arrow batches for the eager jobs of narrow rows in this block."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


@contextmanager
def planned_once(spark: SparkSession):
    """Plans of the eager jobs in this block are not planned anew after each exchange. With
    many short jobs that is what fills the driver: a thread for each exchange, kept for a
    minute, and code compiled for each plan. Joins in it must be safe from skew."""
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
