"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.showConsoleProgress": "false",
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # no call-site capture per expression
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, app: str = "tickwell", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **LOCAL_CONF,
        "spark.sql.shuffle.partitions": str(cores if cores != "*" else 8),
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local master may
    fall back to a temporary folder, because there driver and executors are
    one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="run-")
    return _LOCAL_DIRS[app]


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of a table, in whatever store it lies; a missing one is fine."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, remembered for ``clear_scratch``."""
    path = f"{shared_dir(spark)}/tickwell/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_mark(spark: SparkSession) -> int:
    """A point in time for ``clear_scratch``."""
    return len(_SCRATCH.get(spark.sparkContext.applicationId, []))


def clear_scratch(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> int:
    """Delete the scratch tables made since a mark, but for those in ``keep``; returns how many.

    Only results that have been written elsewhere may go: a DataFrame that is
    still to be computed reads its scratch tables when it runs.
    """
    made = _SCRATCH.get(spark.sparkContext.applicationId, [])
    gone = [path for path in made[since:] if path not in keep]
    for path in gone:
        remove_path(spark, path)
    made[since:] = [path for path in made[since:] if path in keep]
    return len(gone)

