"""Session helpers: a local session for tests and the bench, and tables in the
shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import math
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session built here gets; a cluster session keeps its own.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8,
                  app: str = "greenledger", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("GREENLEDGER_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_folder(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, named by ``spark.checkpoint.dir``.

    Only a session with a local master gets a private folder where the setting
    is missing; any other session must name one."""
    sc = spark.sparkContext
    named = (spark.conf.get("spark.checkpoint.dir", None)
             or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir())
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all "
                           "executors share")
    if sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: executors share no private folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="greenledger-", dir="/tmp"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the application ends."""
    base = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{base}/data"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage is cut,
    a lost executor takes nothing with it, and Spark knows its size in bytes."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Bytes of files that a task scans and of a shuffle that it fetches at most, and of
# input files for which a shuffle is cut into one more partition.
TASK_BYTES, PARTITION_BYTES = 4 << 20, 2 << 20
_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_AT_MOST = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
# Bytes from which a partition of a join is split where it is larger than others: readings
# have few units, metrics and sites, so that one key has a large share of all rows.
_SKEWED, SKEWED_BYTES = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", 4 * TASK_BYTES
_UNITS = {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}


def _bytes(setting: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([bkmgt]?)b?", setting.strip().lower()).groups()
    return int(number) << _UNITS[unit]


def input_bytes(*frames: DataFrame) -> int:
    """Bytes of the files that ``frames`` read, each file once."""
    files = {path for df in frames for path in df.inputFiles()}
    if not files:
        return 0
    spark = frames[0].sparkSession
    conf, sizes = spark.sparkContext._jsc.hadoopConfiguration(), {}
    for folder in {path.rpartition("/")[0] for path in files}:
        parent = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(folder))
        for status in parent.getFileSystem(conf).listStatus(parent):
            sizes[folder, status.getPath().getName()] = status.getLen()
    names = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sum(sizes.get((path.rpartition("/")[0], names(spark.sparkContext._jvm.java.net.URI(path)).getName()), 0) for path in files)


def bounded_tasks(spark: SparkSession, *inputs: DataFrame) -> None:
    """Let the number of tasks grow with ``inputs``, not what one task has to sort and
    hold: shuffles are cut by the bytes of the input files and joined up again to
    ``TASK_BYTES`` at most, scans are cut to as much, and a join's partition of one large key
    is split. Settings that ask for smaller tasks stay as they are."""
    partitions = math.ceil(input_bytes(*inputs) / PARTITION_BYTES)
    if partitions > int(spark.conf.get(_FIRST, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_FIRST, str(partitions))
    for name in _AT_MOST:
        if _bytes(spark.conf.get(name)) > TASK_BYTES:
            spark.conf.set(name, str(TASK_BYTES))
    if _bytes(spark.conf.get(_SKEWED)) > SKEWED_BYTES:
        spark.conf.set(_SKEWED, str(SKEWED_BYTES))
