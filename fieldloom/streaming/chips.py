"""Extension: a stream of new chips into a table, each chip once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fieldloom.sources.files import write_missing


def read_new(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def ingest(chips: DataFrame, target: str, checkpoint: str, key: str = "chip", once: bool = True) -> StreamingQuery:
    """Append each batch's chips that target lacks. A batch that runs again after a failure adds nothing twice."""

    def batch(df: DataFrame, _: int) -> None:
        write_missing(df.dropDuplicates([key]), target, key)

    writer = chips.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
