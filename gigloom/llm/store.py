"""Intermediate tables in the shared folder that spark.checkpoint.dir names."""

import io
import os
import zipfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from gigloom.session import bounded_batches, remember, shared_dir


_shipped: set[str] = set()


def shipped(spark: SparkSession) -> None:
    """Give executors this package, once per application, as Spark hands out any Python file of a job.

    Texts are wide rows, so batches handed to Python are bounded too.
    """
    bounded_batches(spark)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "gigloom")):
            for name in sorted(names):
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), top))
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/gigloom-{uuid4().hex}.zip")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(path)
    out.write(bytearray(held.getvalue()))
    out.close()
    remember(str(path))
    spark.sparkContext.addPyFile(fs.makeQualified(path).toString())
    _shipped.add(app)


def stored(df: DataFrame, *by: str) -> DataFrame:
    """Write a table once, where every executor can reach it, and go on from its files.

    Cuts the lineage: an executor lost later costs a reread, not a recomputation. The caller
    removes such tables with gigloom.session.drop_settled once its outputs are written.
    """
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid4().hex}"
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    remember(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spare(df: DataFrame, name: str) -> str:
    """`name`, longer where `df` has a column of that name already (names count whatever their case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
