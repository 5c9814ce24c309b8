"""New files as they arrive: a stream that takes what is there and loads only unknown keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import load_new


def load_stream(spark: SparkSession, source: str, schema: T.StructType, target: str, key: str, checkpoint: str) -> StreamingQuery:
    """Read the parquet files that arrived in ``source`` and append rows with new keys to ``target``.

    A batch that is repeated after a failure finds its keys loaded and adds nothing.
    """

    def add(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        path = session.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        there = path.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).exists(path)
        # Only the first batch finds no target; a target that can't be read is an error.
        loaded = session.read.schema(schema).parquet(target) if there else session.createDataFrame([], schema)
        load_new(loaded, batch, key).write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    return (
        stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
