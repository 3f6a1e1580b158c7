"""Session settings and staging of reused results in the shared folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
_WRITTEN = threading.local()  # paths staged by the innermost running ``stage_alone`` of a thread
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "ratingmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for.

    On a cluster the master and the shared folder (``spark.checkpoint.dir``) come from the
    submit command; nothing here overrides them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read, as named by the cluster in ``spark.checkpoint.dir``."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", ""
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="ratingmill-")
    return _LOCAL_DIRS[app]


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/ratingmill/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}/{label}"


def clear_staged(spark: SparkSession) -> None:
    """Delete what this application has staged; call it once the results are written."""
    _delete(spark, _own_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, so several consumers share one computation.

    The parquet copy cuts the lineage, survives the loss of executors and keeps column pruning
    and filter pushdown, which a cached or checkpointed RDD would not. Nothing reads the shuffle files
    of a finished write again, so they go with it instead of filling disks until the driver collects garbage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    written = getattr(_WRITTEN, "paths", None)
    if written is not None:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete what ``stage`` has written for ``df``, a result of ``stage`` itself; nothing may read it afterwards."""
    spark = df.sparkSession
    own = f"/ratingmill/{spark.sparkContext.applicationId}/"
    folders = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
    if any(own not in folder for folder in folders):
        raise ValueError("not a staged table")
    for folder in folders:
        _delete(spark, folder)


def stage_alone(build: Callable[[], DataFrame], label: str) -> DataFrame:
    """``stage(build(), label)`` without what ``build`` stages on its way: once the result is written nothing may read that again."""
    outer = getattr(_WRITTEN, "paths", None)
    _WRITTEN.paths = []
    try:
        result = stage(build(), label)
        *passing, kept = _WRITTEN.paths
    finally:
        _WRITTEN.paths = outer
    for path in passing:
        _delete(result.sparkSession, path)
    if outer is not None:
        outer.append(kept)
    return result
