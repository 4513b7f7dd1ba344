"""Status events that arrive as files, loaded as they come.

Each micro-batch goes through the same append as a daily run: rows at or below
the stored id are late and dropped. ``availableNow`` makes it a scheduled job
that ends when the waiting files are done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.daily import ingest_status

SCHEMA = "id bigint, machine_id string, status string, timestamp timestamp_ntz"


def load_available(spark: SparkSession, folder: str, checkpoint: str, files_per_batch: int = 1_000) -> StreamingQuery:
    """Append the waiting Parquet files of a folder to raw_machine_status.

    A batch that is retried after a failure finds its ids stored and adds nothing.
    """

    def append(batch: DataFrame, _: int) -> None:
        ingest_status(batch)

    return (
        spark.readStream.schema(SCHEMA)
        .option("maxFilesPerTrigger", str(files_per_batch))
        .parquet(folder)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
