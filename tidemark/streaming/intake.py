"""Store payload documents that landed since the last call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tidemark.plans.jobs import Pipeline
from tidemark.sources.landing import explode_documents, stamp_documents


def store_new_documents(
    pipeline: Pipeline,
    folder: str,
    checkpoint: str,
    run_id: Column,
    attempt_number: Column,
    extracted_at: Column,
) -> None:
    """Ingest the new ``{"pages": [...]}`` files of a folder, then stop.

    The checkpoint remembers which files were read. A batch that is repeated after a
    failure changes nothing, because recorded attempts are skipped. The metadata columns
    may use ``source_file`` and ``modified_at``.
    """

    def store(batch: DataFrame, _: int) -> None:
        stamped = stamp_documents(batch, run_id, attempt_number, extracted_at)
        pipeline.store_extractions(explode_documents(stamped))

    files = pipeline.spark.readStream.option("wholetext", "true").text(folder)
    # The file columns have to be named while the source is still in the plan.
    with_files = files.select("value", "_metadata")
    stream = (
        with_files.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
