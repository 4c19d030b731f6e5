"""Typed bars as a stream: the newest version of each key is streaming state, and each batch merges what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barhouse.operators.incremental import typed_columns
from barhouse.plans.loads import SILVER, merge_parts, recorded_run
from barhouse.plans.warehouse import Warehouse, at
from barhouse.schemas import BAR_KEYS, VALUE_COLS
from barhouse.sources.price_files import bars_and_verdicts, with_provenance

#: Which version of a bar is newest, whenever its file arrives.
RUN_ORDER = ("file_stamp", "source_file", "file_pos")
#: How long after the newest day a bar's versions are remembered.
LATENESS = "60 days"


def newest_versions(files: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The newest version of each key of a stream of price files, by the run that fetched it.

    A streaming aggregation: tasks keep one row per key before the shuffle, and the state holds one per key
    whose day is not older than the watermark, the newest day seen less ``lateness``.
    """
    bars = bars_and_verdicts(files).where("kind = 'bar'")
    typed = bars.select(*typed_columns(), F.struct(*RUN_ORDER).alias("version")).where("date is not null")
    timed = typed.withColumn("day", F.col("date").cast("timestamp")).withWatermark("day", lateness)
    newest = F.max_by(F.struct(*VALUE_COLS), "version").alias("bar")
    return timed.groupBy("ticker", "day").agg(newest).select("ticker", F.to_date("day").alias("date"), "bar.*")


def stream_silver(
    wh: Warehouse,
    src: str,
    checkpoint: str,
    glob: str = "*.json",
    files_per_batch: int = 100_000,
    lateness: str = LATENESS,
) -> StreamingQuery:
    """Merge what is staged in ``src`` into the typed table, then stop; run it again for new files.

    A correction replaces the bar, and a file of an older run that arrives late does not replace a newer one,
    because the state knows the newest version. A batch that is repeated after a crash merges the same rows
    again, which changes nothing, and a restart goes on from the checkpoint. Later than ``lateness`` a version
    is no longer told from an older one, and Spark leaves it out; ``repair_silver`` finds such bars once
    Bronze has their file. Rejected files and dates that cannot be read are left to the Bronze and typed load.
    """
    reader = (
        wh.spark.readStream.format("text")
        .option("wholetext", "true")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        with recorded_run(wh, "stream_silver") as run:
            stamp = wh.next_stamp(SILVER)
            source = run.once(batch.select(*BAR_KEYS, *VALUE_COLS)).withColumn("loaded_at", at(stamp))
            periods = {r.period: r["count"] for r in source.groupBy(wh.period_of()).count().collect()}
            if periods:
                merge_parts(run, SILVER, source, periods, BAR_KEYS, stamp)
            run.detail = f"batch {batch_id}"

    return (
        newest_versions(with_provenance(reader.load(src)), lateness)
        .writeStream.outputMode("update")
        .foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
