"""A growing folder of pages, processed as it grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stewardry.operators.reports import found_people
from stewardry.plans.extraction import process_pages
from stewardry.sources.objects import name_below
from stewardry.sources.pages import accepted_pages, decode_pages


def stream_page_files(spark: SparkSession, folder: str, max_files: int = 10_000) -> DataFrame:
    """New page files of a folder as `source_file, raw` (see `sources.pages`)."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = (
        spark.readStream.format("binaryFile").schema(schema)
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
    )
    text = F.col("content").cast("string")
    raw = F.when(F.is_valid_utf8(text), text).otherwise(F.decode("content", "ISO-8859-1"))
    return files.select(name_below(folder).alias("source_file"), raw.alias("raw"))


def ingest_new_pages(pages: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Starts processing everything that is new, then stops by itself.

    `pages` streams good pages. Each batch replaces its own folder `batch=<id>` below
    `output`, so a batch that is run again after a failure leaves one copy. Rows are
    those of `found_people`.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        found_people(process_pages(batch)).write.mode("overwrite").parquet(
            f"{output}/batch={batch_id}"
        )

    return (
        pages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_folder(spark: SparkSession, folder: str, output: str, checkpoint: str) -> StreamingQuery:
    """`ingest_new_pages` over a folder of page files."""
    return ingest_new_pages(
        accepted_pages(decode_pages(stream_page_files(spark, folder))), output, checkpoint
    )
