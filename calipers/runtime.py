"""Session helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent
#: Bytes of rows that go to a Python worker at once; Spark bounds only their number by itself, and texts may be long.
BATCH_BYTES = 4 << 20
#: Whether Spark removes the shuffle files of a job as soon as the job ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The folders settled within the innermost call of `only`.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark context.

    Python workers import kernels by name, so they need the package wherever the
    driver was started. Where the session does not bound the bytes of their batches, that is set, too.
    """
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) in (None, str(2**31 - 1), "2147483647b"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if getattr(sc, "_calipers_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="calipers-ship-")) / "calipers_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, Path(PACKAGE.name) / path.relative_to(PACKAGE))
    sc.addPyFile(str(archive))
    sc._calipers_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; make one only for local runs."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="calipers-checkpoint-")
    sc.setCheckpointDir(folder)


def scratch(spark: SparkSession, name: str) -> str:
    """A path for a new folder that every executor can reach."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise `df` reliably and cut its lineage; rows are stored as they are, and dealt as they were."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settle(df: DataFrame) -> DataFrame:
    """Materialise `df` reliably and cut its lineage, on little disk.

    The rows are written in columns, compressed, to the shared folder, so they outlive executors, and a lost machine
    costs a re-read and not the whole chain of rounds. What was shuffled for them is removed at once. The rows read back
    are few bytes to Spark: joins that must not broadcast them need a hint.
    """
    spark = df.sparkSession
    folder, before = scratch(spark, "settled"), spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
    if (made := _made.get()) is not None:
        made.append(folder)
    read = spark.read.schema(df.schema).parquet(folder)
    read._calipers_folder = folder
    return read


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(*settled: DataFrame) -> None:
    """Remove the files of settled frames; nothing that reads them may be run any more."""
    for df in settled:
        if folder := getattr(df, "_calipers_folder", None):
            _remove(df.sparkSession, folder)


def only(make: Callable[[], DataFrame]) -> DataFrame:
    """Settle what `make` gives, and remove all that was settled on the way to it."""
    made: list[str] = []
    outer = _made.set(made)
    try:
        result = make()
    finally:
        _made.reset(outer)
    kept = settle(result)
    for folder in made:
        _remove(result.sparkSession, folder)
    return kept


def build_session(app: str = "calipers", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; all can be overridden."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
