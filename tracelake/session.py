"""Session settings and the helpers that touch shared storage."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup table whose files are larger is never broadcast by this package.
BROADCAST_BYTES = 16 << 20

# Bytes that the optimizer knows of a table for each task of work that is heavy per row.
SPREAD_BYTES = 4 << 20

# Bytes of content for each task of work that reads files by their extents.
TASK_BYTES = 256 << 20


def build_session(app_name: str = "tracelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (AQE with skew splitting, UTC)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables.

    Taken from the session. A machine-local folder is set up only for local masters (tests).
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tracelake-"))
    return sc.getCheckpointDir().rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors: their Python workers need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_tracelake_shipped", False):
        return
    package = pathlib.Path(__file__).parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="tracelake-zip-")) / "tracelake.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._tracelake_shipped = True


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tracelake/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage by writing a Parquet table to the shared folder and reading it back.

    Later plans prune columns of it and see its real size, so the choice between a broadcast and
    a shuffled join is made on measured bytes. A lost executor costs a re-read, not a recompute.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks_for(spark: SparkSession, n_bytes: int) -> int:
    """Tasks for work on so many bytes: ``TASK_BYTES`` each, and no fewer than there are cores."""
    return max(spark.sparkContext.defaultParallelism, -(-int(n_bytes or 0) // TASK_BYTES))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """A table dealt to tasks of about ``SPREAD_BYTES``, no fewer than there are cores, for work that is heavy per row.

    As read, a small table may be one task, and a large one has tasks of 128 MB or of a row group. Here a task's time and memory stay as the table grows.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-stored_bytes(df) // SPREAD_BYTES)), *keys)


#: Rows, and bytes of them, that go to a Python worker at once. Whole texts are long, so Spark's default would fill a worker's memory; results don't depend on it.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def small_batches(df: DataFrame) -> None:
    """Have the session send at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES`` at once; a smaller setting stays."""
    conf = df.sparkSession.conf
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(conf.get(name).rstrip("b")) <= BATCH_BYTES:
        conf.set(name, f"{BATCH_BYTES}b")


def stored_bytes(df: DataFrame) -> int:
    """What the optimizer knows of a table's size; for a stored one, the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def lookup_join(
    big: DataFrame,
    table: DataFrame,
    on: str | list[str],
    how: str = "inner",
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``big`` to a stored lookup table; ``on`` may be heavily skewed in ``big``.

    A table whose files have at most ``max_broadcast_bytes`` is broadcast, and ``big`` isn't shuffled. For a larger one both sides
    are shuffled on the key, and adaptive execution splits what is too large for a task. No row of the table is copied.
    """
    on = [on] if isinstance(on, str) else on
    small = stored_bytes(table) <= max_broadcast_bytes
    return big.join(F.broadcast(table) if small else table, on, how)
