"""Session helpers: a local session for tests and the shared working folder."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "replyloom", **conf) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # single-file tables: rows over all cores
        .config("spark.replyloom.deal", cores)
        # plan building need not record Python call sites
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("_", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_made: set[str] = set()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the folder the cluster names in ``spark.checkpoint.dir``, or
    below the warehouse, which is always set, where that is not."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
        if not _made and spark.sparkContext.master.startswith("local"):
            atexit.register(_remove_made)
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if root.endswith("/_work"):
        _made.add(path)
    return path


def _remove_made() -> None:
    """At the end of a local session: what it wrote below the warehouse."""
    for path in _made:
        shutil.rmtree(path.removeprefix("file:"), ignore_errors=True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``shared_folder`` named, once nothing reads it any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def existing(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern with ``{a,b}`` choices names and that are there, on any file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return [s.getPath().toString() for s in found or []]


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Inside, these session settings hold."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_dropped(spark: SparkSession):
    """Inside, Spark removes a query's shuffle files when the query has ended."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def cut_lineage(df: DataFrame, purpose: str, arrow_rows: int = 1000, **written: int) -> DataFrame:
    """``df`` written once below the shared folder and read back: an iterative fit
    then does not repeat the plan behind it, and a lost executor costs a re-read. Once the
    rows are written, nothing needs the shuffle files they came from, so they go.
    ``arrow_rows`` bounds what Python steps of the plan get at a time, ``written`` are the writer's
    settings: a reader holds a group of rows at once, so tables of large rows need small groups."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, purpose)
    with shuffles_dropped(spark), settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(arrow_rows)}):
        df.write.options(**{f"parquet.block.{k.replace('_', '.')}": v for k, v in written.items()}).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _written[out] = path
    return out


_written: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def remove_written(*tables: DataFrame) -> None:
    """Remove what ``cut_lineage`` wrote for these tables, once nothing reads them any more."""
    for table in tables:
        if table in _written:
            remove_folder(table.sparkSession, _written.pop(table))
