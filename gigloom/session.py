"""Session settings and the shared working folder."""

import atexit
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # building a layout makes thousands of small expressions; do not record a call site for each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # pages are wide rows: keep each batch handed to Python small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}


_settled: list[str] = []


def session(master: str | None = None, app: str = "gigloom", **settings) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a scratch folder only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    own = tempfile.mkdtemp(prefix="gigloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """Write an intermediate result once, to the shared folder, and go on from the files.

    Used where several later steps read the same costly result; survives lost executors.
    """
    path = f"{shared_dir(df.sparkSession)}/settled-{uuid4().hex}"
    df.write.parquet(path)
    remember(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remember(path: str) -> None:
    """A folder that `drop_settled` removes."""
    _settled.append(path)


def remembered() -> list[str]:
    """The folders that `drop_settled` would remove now."""
    return list(_settled)


def drop_settled(spark: SparkSession, only: list[str] | None = None) -> None:
    """Delete this program's intermediate results once a run's outputs are written: all of them, or only those named."""
    for path in list(_settled) if only is None else [p for p in only if p in _settled]:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        _settled.remove(path)


def bounded_batches(spark: SparkSession, rows: int = 512) -> None:
    """Fewer rows at a time to Python, where the session still has Spark's default of 10,000: pages and texts are wide.

    Both sides hold a batch in memory outside the heap, so a wide one counts twice for each task.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal a scan out over `partitions` tasks before costly work; without a number it keeps its splits.

    The default is the session's spark.gigloom.partitions, which suits tables of a few large
    files that are parsed on many cores; where it is unset nothing is moved.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.gigloom.partitions", "0"))
    return df.repartition(n) if n else df


def dealt_out(scan: DataFrame) -> DataFrame:
    """A scan whose rows cost far more than their bytes, over as many tasks as a shuffle has at least.

    Splits follow the bytes of a file, and small rows that are built into pages come in few of them. A scan of more splits
    stays as it is. spark.gigloom.partitions goes first where it is set.
    """
    if int(scan.sparkSession.conf.get("spark.gigloom.partitions", "0")):
        return spread(scan)
    tasks = int(scan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return scan.repartition(tasks) if scan.rdd.getNumPartitions() < tasks else scan
