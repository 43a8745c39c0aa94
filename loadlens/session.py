"""Session construction and the shared scratch location.

Scratch data (checkpoints, landing files, round trips) always goes under the
folder the cluster names in ``spark.checkpoint.dir``; a local folder is only
created when that setting is missing, as in unit tests.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Scratch folders of this process that have not been released.
_SCRATCH: list[str] = []


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "loadlens", extra: dict | None = None) -> SparkSession:
    """A session with the package's settings.

    Without ``master`` the one that spark-submit or the cluster sets applies
    (or Spark's own default); driver memory is left to them as well.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    A machine-local folder serves a local master only: on a cluster the other
    machines could not read it, so there the setting must be given.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY, None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all machines of {sc.master} share")
        configured = tempfile.mkdtemp(prefix="loadlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/loadlens-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def release_scratch(spark: SparkSession) -> None:
    """Remove every scratch folder handed out so far; results that still read one must be consumed before."""
    while _SCRATCH:
        delete_path(spark, _SCRATCH.pop())


def scale_conf(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.1,
               target_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for a cluster run over ``input_bytes`` of Parquet.

    Scan splits are ``target_bytes``; the initial shuffle partition count
    assumes a shuffle of ``shuffle_fraction`` of the input (projection and
    partial aggregation shrink it) in ``target_bytes`` pieces, at least two per
    core, and AQE coalesces what turns out smaller and splits skewed join
    partitions. Broadcasts stay under a fixed threshold; nothing that grows
    with the data is broadcast by hint.
    """
    shuffle = max(2 * total_cores, int(input_bytes * shuffle_fraction // target_bytes) + 1)
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # size coalesced partitions by the advisory size, not by maximum task count
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }


def stage(df: DataFrame, name: str) -> DataFrame:  # noqa: ARG001 - name documents the call site
    """Cut lineage with an eager reliable checkpoint in the shared checkpoint folder.

    One job computes the plan and writes the checkpoint files; later reads
    start from those files, so a lost executor never forces recomputing (or
    re-reading sources that the job has since rewritten).
    """
    return df.checkpoint(eager=True)


def _hadoop_path(spark: SparkSession, path: str) -> tuple:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file exists; any error but its absence is raised."""
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds."""
    fs, p = _hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)]


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package wrote."""
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table, or an empty one if nothing was ever written there.

    Only absence counts as empty. A table that exists and cannot be read fails
    the query, so that nothing is ever rebuilt from half of it.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` as files in the shared scratch folder, for the time of the block."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)
        if path in _SCRATCH:
            _SCRATCH.remove(path)


# ---------------------------------------------------------------- versioned tables

def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a table, in order (a version without its marker is not one)."""
    if not path_exists(spark, path):
        return []
    numbers = sorted(int(n[2:]) for n in child_names(spark, path) if n.startswith("v=") and n[2:].isdigit())
    return [n for n in numbers if path_exists(spark, f"{path}/v={n}/_SUCCESS")]


def write_version(df: DataFrame, path: str, fmt: str = "parquet", options: dict | None = None) -> None:
    """Replace a table by writing its next version beside the current one.

    Readers see the old version until the new one is complete, so a crash in
    the write leaves the table as it was. The version before the last is removed.
    """
    spark = df.sparkSession
    done = _versions(spark, path)
    number = (done[-1] if done else 0) + 1
    df.write.mode("overwrite").format(fmt).options(**(options or {})).save(f"{path}/v={number}")
    for old in done[:-1]:
        delete_path(spark, f"{path}/v={old}")


def version_path(spark: SparkSession, path: str) -> str | None:
    """Folder of the last complete version; None if there is none."""
    done = _versions(spark, path)
    return f"{path}/v={done[-1]}" if done else None


def read_version(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The last complete version of a table, or an empty one before the first."""
    last = version_path(spark, path)
    return spark.createDataFrame([], schema) if last is None else spark.read.schema(schema).parquet(last)
