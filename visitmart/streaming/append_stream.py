"""Append loads as a Structured Streaming job over a landing folder.

The source appends every new extract file to one table. Run as a batch
``LOAD DATA`` it re-appends a file when a run is repeated. Here the landing
folder is a file stream source: the checkpoint records which files were
taken, so each file is appended exactly once however often the job runs,
and a job killed halfway resumes from its last committed batch.

Each micro-batch is committed to the append table under an id made of the
checkpoint and the batch number, rejects beside it under the same id: a batch
that runs again after a failure replaces what it had written. With ``dedup_keys``
rows whose keys the table holds already, from a batch load or the stream, are left
out, by the rule of the batch load (``sinks.append``).

``trigger(availableNow=True)`` processes what has landed and stops, which
fits the source's scheduled, batch-style runs; the same code runs as a
continuous stream with a processing-time trigger.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ..sources.csvload import LoadSpec, decoded, parse_rows, split_rows, with_options
from ..sources.sinks import load_append


def stream_append(spark: SparkSession, landing: str, spec: LoadSpec, target: str,
                  checkpoint: str, files_per_batch: int = 100, dedup_keys: list[str] | None = None) -> None:
    """Append every not-yet-loaded CSV file under ``landing`` to ``target``."""
    raw = decoded(with_options(spark.readStream, spec)
                  .option("maxFilesPerTrigger", files_per_batch)
                  .option("recursiveFileLookup", "true")
                  .csv(landing), spec)
    feed = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, batch_id: int) -> None:
        load_append(split_rows(parse_rows(batch, spec), spec), target, batch=f"s{feed}n{batch_id}",
                    dedup_keys=dedup_keys)

    query = (raw.writeStream
             .foreachBatch(write)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
