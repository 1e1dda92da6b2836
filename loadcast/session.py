"""Session settings, durable intermediate tables and size-checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BROADCAST_ROWS = 100_000


# Runtime settings every session should have.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # HotSpot never compiles methods above 8000 bytes; beyond that, split projections beat one huge generated loop.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


SHUFFLE_BYTES = 128 * 1024 * 1024


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to a session that somebody else made.

    With `input_bytes` the shuffle partition count is raised to about one per 128 MB of input (never lowered); AQE
    merges what turns out to be small, but it cannot split ordinary aggregation partitions.
    """
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        current = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.shuffle.partitions", str(max(current, -(-input_bytes // SHUFFLE_BYTES))))
    return spark


def plan_bytes(df: DataFrame) -> int | None:
    """The largest source that a frame reads, from the sizes of its files; None where no source knows its size."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return max((n for n in sizes if n < 1 << 55), default=None)


def build_session(master: str | None = None, app: str = "loadcast", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **RUNTIME,
        # Recording a Python call site for every column expression costs more than building the plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """UTC instants and wall-clock columns are compared by value, which needs a UTC session."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC, it is {zone!r}")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir, else one below the warehouse, which Spark shares too."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_folder(spark).rstrip('/')}/loadcast/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; call it when no result that reads them is needed any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(
    df: DataFrame, name: str, partition_by: list[str] | None = None, schema: StructType | None = None
) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage before loops that read the same rows many times; unlike a cache it survives executor loss,
    and unlike a checkpoint later reads still prune columns, partitions and row groups. `schema` may name other types that
    are stored alike, such as vectors.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}/{name}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when a count, cut off just above the bound, proves the side is small.

    Above the bound the frame is returned unhinted, so the planner shuffles (and AQE splits skewed partitions).
    """
    return F.broadcast(df) if few_rows(df, max_rows) else df


def few_rows(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether `df` is small enough to be sent to every task; counts no further than the bound."""
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows
