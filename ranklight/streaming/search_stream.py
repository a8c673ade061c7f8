"""Stream of queries → ranked hits.

Query rows ``(query_id, text)`` arrive as files in ``query_dir``; each micro-batch is answered with the
same batch operator (:func:`ranklight.operators.ranking.search`) against a saved index, and written to
``out_dir/epoch=<id>`` with overwrite, so a replayed epoch after a failure replaces its own output
instead of duplicating it (exactly-once output on top of the source checkpoint).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklight.operators import ranking
from ranklight.operators.indexing import TextIndex

QUERY_SCHEMA = "query_id bigint, text string"


def start_search_stream(spark: SparkSession, index: TextIndex, query_dir: str, out_dir: str, checkpoint: str,
                        k: int = 10, method: str = "cosine", file_format: str = "parquet",
                        available_now: bool = True, max_files_per_trigger: int | None = None):
    reader = spark.readStream.schema(QUERY_SCHEMA).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(query_dir)

    def answer(batch: DataFrame, epoch_id: int) -> None:
        hits = ranking.search(index, batch, k, method=method).withColumn("epoch", F.lit(epoch_id))
        hits.drop("epoch").write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/epoch={epoch_id}")

    w = stream.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()
