"""The refresh of a vector table fed by a stream of documents: each micro-batch is one merge."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ostraka.operators.embeddings import COLUMNS, Embed, document_chunks, embedded, stale, surplus_chunks, upserted


def merge_batch(stored: DataFrame, documents: DataFrame, model: str, embed: Embed) -> DataFrame:
    """The table after the documents of one batch: stale chunks embedded anew, surplus ones gone.

    Documents that aren't in the batch keep their rows.
    """
    chunks = document_chunks(documents, model, F.col("language"))
    kept = stored.join(surplus_chunks(stored, chunks).select("xml_id", "model_name", "chunk_index"), ["xml_id", "model_name", "chunk_index"], "left_anti")
    fresh = embedded(stale(chunks, stored), embed).filter(~F.col("skipped")).withColumn("updated_at", F.current_timestamp()).select(*COLUMNS)
    return upserted(kept.select(*COLUMNS), fresh)


def refresh_stream(documents: DataFrame, read: Callable[[SparkSession], DataFrame], write: Callable[[DataFrame, int], None], model: str, embed: Embed, checkpoint: str) -> StreamingQuery:
    """Starts the refresh; ``write`` gets each new table with the number of its batch, to write it once."""

    def each(batch: DataFrame, number: int) -> None:
        write(merge_batch(read(batch.sparkSession), batch, model, embed), number)

    return documents.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
