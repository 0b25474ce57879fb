"""Where checkpoints and written tables go, and how large a broadcast side may be."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# A broadcast side is a driver-built or counted table of at most this many narrow rows (some 20 MB).
MAX_BROADCAST_ROWS = 400_000

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session that names none gets a folder of its own; on a cluster a machine-local folder would be lost with
    the machine, so that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(CHECKPOINT_SETTING)
    if named:
        return named
    # ``local-cluster`` has executors of their own, so it is a cluster here.
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="arborlog-")
    return _local_folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read again: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` by writing it to the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Ask for a broadcast of ``df`` if its row count, which the caller knows, is within the bound.

    Beyond the bound the join is left to the planner, which shuffles and splits skewed keys.
    """
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def local_table(spark: SparkSession, schema: pa.Schema, rows: list[tuple]) -> DataFrame:
    """A model-sized table from driver values; it becomes a constant of the plan, no job is needed to read it."""
    columns = [pa.array([r[i] for r in rows], type=field.type) for i, field in enumerate(schema)]
    return spark.createDataFrame(pa.table(columns, schema=schema))
