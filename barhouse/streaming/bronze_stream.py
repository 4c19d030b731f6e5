"""The bronze load as a stream: the file source remembers which files it has read."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from barhouse.plans.loads import FILE_KEYS, FILES, append_files, loaded_documents, recorded_run
from barhouse.plans.warehouse import Warehouse
from barhouse.sources.price_files import with_provenance


def stream_bronze(
    wh: Warehouse,
    src: str,
    checkpoint: str,
    glob: str = "*.json",
    files_per_batch: int = 100_000,
    archive: str | None = None,
) -> StreamingQuery:
    """Load everything that is staged in ``src``, then stop; run it again for new files.

    A batch's part is named by the id that the checkpoint gave the query, so a new
    checkpoint at the same path never meets older parts. A batch that is repeated
    after a crash is left out if its part is there, and documents that any job has
    loaded are left out by the ledger: no row is lost or added twice. With
    ``archive`` the source moves files away once a later batch has started.

    The checkpoint counts a rejected file as read; :func:`retry_rejected` tries it
    again.
    """
    reader = (
        wh.spark.readStream.format("text")
        .option("wholetext", "true")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)

    def load(files: DataFrame, batch_id: int) -> None:
        with recorded_run(wh, "stream_bronze") as run:
            stream = json.loads(wh.spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
            part = f"stream-{stream}-{batch_id}"
            if not wh.parts(FILES, [part]):
                append_files(run, files.join(loaded_documents(wh), FILE_KEYS, "left_anti"), part)

    return (
        with_provenance(reader.load(src))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
