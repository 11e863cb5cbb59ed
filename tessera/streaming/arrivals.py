"""Arriving entity files, resolved batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.plans.bulk import Engine
from tessera.sources.files import entities_from


def watch(spark: SparkSession, folder: str, checkpoint: str, engine: Engine, once: bool = True):
    """A query that runs the engine over each micro-batch of Parquet entity lists in a folder.

    A batch that is run again finds its entities in the store, so results are not doubled.
    """
    stream = spark.readStream.schema("entity_id string, name string, entity_type string, row_no long").parquet(folder)

    def work(batch: DataFrame, number: int) -> None:
        if batch.head(1):
            engine.run(entities_from(batch))

    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
