"""Incremental runs: the batch operators applied to newly landed files."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gigloom.operators.keys import dedupe, new_only
from gigloom.sources.tables import exists, live


def append_new(stream: DataFrame, target: str, keys, order, checkpoint: str, keep: str = "last",
               prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Append rows whose key the target does not hold yet; stops when all landed files are read.

    A micro-batch that runs again after a failure finds its own rows in the target and adds
    nothing, so each key is written once. Rows without a whole key are told apart by all their
    columns.
    """
    names = [keys] if isinstance(keys, str) else list(keys)

    def marked(df: DataFrame) -> DataFrame:
        part = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in names])
        return df.withColumn("_mark", F.when(part, F.to_json(F.struct(*sorted(df.columns)))).otherwise(F.to_json(F.struct(*names))))

    def write(batch: DataFrame, _: int) -> None:
        rows = dedupe(prepare(batch) if prepare else batch, keys, order, keep)
        held = live(batch.sparkSession, target)
        if exists(batch.sparkSession, held):
            seen = batch.sparkSession.read.schema(rows.schema).parquet(held)
            rows = new_only(marked(rows), marked(seen), "_mark").drop("_mark")
        rows.write.mode("append").parquet(held)

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
