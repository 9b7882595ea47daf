"""Incremental ingestion as a Structured Streaming query (I8).

"Process everything available now, each file once": a ``binaryFile``
file stream over the landing root delivers the paths of new objects
(only path, length and modification time are selected), and
``foreachBatch`` runs the batch ingestion (``plans.incremental``) on the
files of that micro-batch.  The stream's checkpoint is the list of files
already seen.

* ``trigger(availableNow=True)`` processes the backlog and stops, in one
  micro-batch, or in bounded ones with ``max_files_per_trigger``.
* In ``stop`` mode a failing file raises inside ``foreachBatch``; the
  batch is not committed, so the same files come again on the next start
  (after the file is corrected under the same name, I6).  Files already
  SUCCESS in the tracker are skipped on the replay.  A replay takes a new
  batch id, since the rows of files that succeeded before stay in the old
  one; rows of a batch that crashed before its last events are never
  visible, and ``IngestionStore.vacuum`` deletes them.
* Zero-length objects, which a file stream does not deliver, are taken
  from the listing, so they fail as in the batch run.
* File order inside a micro-batch follows the batch rules (customers
  first, then by name), not the arrival order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.incremental import (SUCCESS, IncrementalConfig, IngestionError, IngestionStore,
                                 listing_from_paths, run_incremental)
from ..sources.files import Landing

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def start_stream_ingest(spark: SparkSession, landing: Landing, store: IngestionStore,
                        checkpoint_location: str, cfg: IncrementalConfig | None = None,
                        available_now: bool = True, max_files_per_trigger: int | None = None,
                        processing_time: str | None = None):
    cfg = cfg or IncrementalConfig()
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    paths = reader.load(landing.root).select("path", "length")

    def process(batch: DataFrame, epoch_id: int) -> None:
        # a zero-length object gives no stream row: take those not yet loaded from the listing
        empty = landing.listing([cfg.customers_prefix, cfg.orders_prefix]).where("length = 0").select("path", "length")
        done = store.tracker_latest().where(F.col("status") == SUCCESS).select("file_name")
        empty = empty.join(done, landing.key(F.col("path")) == F.col("file_name"), "left_anti")
        listing = listing_from_paths(landing, batch.where("length > 0").unionByName(empty), cfg)
        if listing.isEmpty():
            return
        run_incremental(spark, landing, store, cfg, raise_on_error=(cfg.on_error == "stop"),
                        listing=listing)

    w = paths.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def run_stream_once(spark: SparkSession, landing: Landing, store: IngestionStore,
                    checkpoint_location: str, cfg: IncrementalConfig | None = None) -> str | None:
    """Drain what is available now; return the ingestion error, if the run stopped on one."""
    q = start_stream_ingest(spark, landing, store, checkpoint_location, cfg)
    try:
        q.awaitTermination()
    except Exception as exc:  # StreamingQueryException wrapping the batch's error
        text = str(exc)
        if IngestionError.__name__ not in text and "IngestionError" not in repr(exc):
            raise
        return text
    return None
