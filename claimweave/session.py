"""Session-level helpers: runtime settings, shared scratch space, lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# AQE sizes the shuffles and splits hot join keys. Forcing the skewed-join rule keeps it
# active where the join feeds an aggregate on the same keys (one more shuffle, no hot task).
# Scans and shuffles are cut small: stored columns and compressed rows unpack to many times their size.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}

PARTITION_BYTES = 4 << 20  # of stored input for each shuffle partition


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def stored_bytes(df: DataFrame) -> int:
    """The size of the files behind a scan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def size_shuffles(spark: SparkSession, stored: int) -> None:
    """Shuffles of a query over ``stored`` bytes start with as many partitions as keep a task's share the same.

    The session's own number is the least. AQE merges partitions that turn out small but splits none, so a fixed number
    lets the memory of a task grow with the input.
    """
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    wanted = -(-stored // PARTITION_BYTES)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(name, str(wanted))
    else:
        spark.conf.unset(name)


def local_session(cores: str = "*", app: str = "claimweave", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine: on a cluster
    the executors would not see it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="claimweave-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's scratch folder, which is removed when its driver ends."""
    context = spark.sparkContext
    root = f"{shared_dir(spark).rstrip('/')}/scratch/{context.applicationId}"
    place = context._jvm.org.apache.hadoop.fs.Path(root)
    place.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(place)
    return f"{root}/{uuid.uuid4().hex}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives lost executors and is read back unchanged."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_checkpoint(spark: SparkSession, path: str) -> None:
    """Removes the files of a checkpoint that nothing reads any more."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def store_table(df: DataFrame, name: str = "table", by: Sequence[str] = ()) -> DataFrame:
    """Write an intermediate result once to the shared folder and read it back.

    Used where several consumers would each run the same scans and joins again. Being columnar,
    the stored table lets every consumer read only the columns it needs; ``by`` lays it out in
    folders, so that a consumer of one value reads no other.
    """
    path = scratch_path(df.sparkSession, name)
    write = df.write.partitionBy(*by) if by else df.write
    write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Plan nodes that only read rows: reading such a frame twice costs less than storing it.
READING = {"Project", "Filter", "Relation", "LogicalRDD", "LocalRelation", "OneRowRelation", "Range"}


def only_reads(df: DataFrame) -> bool:
    """Whether the frame is a scan with filters and columns, nothing joined, aggregated, sorted or generated."""
    tree = df._jdf.queryExecution().optimizedPlan().treeString()
    return {m[1] for m in re.finditer(r"^[\s:+\-]*(\w+)", tree, re.M)} <= READING


def computed_once(df: DataFrame, name: str = "rows") -> DataFrame:
    """The frame as it is where reading it again is cheap, else stored, for use by several consumers."""
    return df if only_reads(df) else store_table(df, name)
