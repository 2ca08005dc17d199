"""Incremental (Structured Streaming) form of the band counts.

The same lazy ``band_counts`` plan runs over a streaming file source: new
Parquet files dropped into the source folder update the counts. State is
kept by Spark's streaming aggregation under a checkpoint folder; every
micro-batch writes the complete (small, bounded: one row per band) table to a
folder of its own, so a batch that fails midway leaves the last one readable.
The last few folders are kept, for readers that began before a new one came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans import analyses
from ..plans import fixtures as fx
from ..plans.queries import AGE_BANDS_SQL, query
from ..session import delete_paths, scratch_path
from ..sources.sinks import write_parquet


def band_counts_stream(spark: SparkSession, source_dir: str, schema: StructType, out_dir: str,
                       checkpoint_dir: str, age: str = "age", text: str = "crime",
                       pattern: str = fx.CRIME_PATTERN, max_files_per_trigger: int | None = None,
                       kept_epochs: int = 3):
    """Start a streaming query that writes the band counts over all files seen
    so far in ``source_dir`` to ``out_dir/epoch=<n>``; returns the handle. Read
    them with :func:`latest`. ``availableNow`` processes what is there and stops.
    After each batch the folder older than the last ``kept_epochs`` is deleted."""
    if kept_epochs < 1:
        raise ValueError("kept_epochs must be at least 1")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    counts = analyses.band_counts(stream, age, text, pattern)

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")  # a repeated epoch replaces itself
        if epoch >= kept_epochs:
            delete_paths(spark, [f"{out_dir}/epoch={epoch - kept_epochs}"])

    return (counts.writeStream.outputMode("complete").foreachBatch(publish)
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())


def latest(spark: SparkSession, out_dir: str) -> DataFrame:
    """The newest complete table of a stream."""
    rows = spark.read.parquet(out_dir)
    return rows.where(F.col("epoch") == rows.agg(F.max("epoch")).scalar()).drop("epoch")


@query("age_bands_stream", AGE_BANDS_SQL)
def q_age_bands_stream(spark, sf):
    src = scratch_path(spark, "incident-stream")
    first, second = fx.incident_eras(spark, sf)
    from ..operators import trim_names
    out, checkpoint = scratch_path(spark, "band-stream-out"), scratch_path(spark, "band-stream-ckpt")
    # two eras arriving one after the other: each is a batch, of however many files
    for era, rows in enumerate((first, trim_names(second)), 1):
        write_parquet(rows, f"{src}/era={era}")
        band_counts_stream(spark, f"{src}/*", first.schema, out, checkpoint).awaitTermination()
    return latest(spark, out)
