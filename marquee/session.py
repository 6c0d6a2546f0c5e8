"""Session helpers: building one, cutting lineage, and size checks before a broadcast."""

from __future__ import annotations

import tempfile
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_ROWS = 1_000  # rows that a Python task holds at a time
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
TABLE_ROWS = 2_000_000  # of a table of at most BROADCAST_BYTES that Python tasks hold as plain arrays
FEW_ROWS = 1_000  # rows for which no whole table is sent to the tasks


def build_session(app: str = "marquee", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def reach_package(spark: SparkSession) -> SparkSession:
    """Let Python tasks import this package where the driver found it without PYTHONPATH."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(p for p in (root, env.get("PYTHONPATH", "")) if p)
    return spark


def small_batches(spark: SparkSession) -> SparkSession:
    """Let Python tasks take whole texts and their tokens ``BATCH_ROWS`` at a time, so their memory does not follow the input."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    set_to = int(spark.conf.get(name))
    if set_to <= 0 or set_to > BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: ``spark.checkpoint.dir``, or a scratch one in local mode only."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="marquee-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from the written rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df``: true when it holds at most ``max_rows`` rows and ``max_bytes`` bytes of values.

    One aggregation: each task sends two numbers, whatever the size.
    """

    def size(f: T.StructField):
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.BooleanType)):
            return F.lit(8)
        text = col if isinstance(f.dataType, T.StringType) else F.to_json(F.struct(col))
        return F.coalesce(F.octet_length(text), F.lit(0))

    total = F.sum(reduce(lambda a, b: a + b, map(size, df.schema)).cast("bigint"))
    rows, volume = df.agg(F.count(F.lit(1)), F.coalesce(total, F.lit(0))).first()
    return rows <= max_rows and volume <= max_bytes


def more_than(df: DataFrame, n: int) -> bool:
    """True when ``df`` has more than ``n`` rows; reads no column and only as many partitions as it needs."""
    return len(df.select(F.lit(1)).take(n + 1)) > n


def spread_scan(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan out over all cores when its files give fewer tasks than that.

    For a plain scan only: its number of tasks is known from the file listing, without a job. A large
    input has more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
