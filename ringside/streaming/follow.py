"""Event documents loaded as their files arrive.

Ingestion is an idempotent keyed load, so a stream is the same load per
micro-batch: a batch that is retried after a failure changes nothing.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ringside.plans.build import Store, ingest


def follow_folder(store: Store, folder: str, state: str, files_per_batch: int = 1000) -> StreamingQuery:
    """One JSON document per line; stops after what is there has been loaded."""
    lines = (
        store.spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .text(folder)
        .select(F.col("value").alias("payload"), F.col("_metadata.file_modification_time").alias("at"),
                F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        # the load order inside a batch: file time, file, place in the file. One task reads a block of a file
        # from start to end, so that the growing id tells the lines of a block apart.
        order = F.struct("at", "file", "block", F.monotonically_increasing_id().alias("line"))
        ingest(store, batch.select("payload", order.alias("seq")))

    return (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
