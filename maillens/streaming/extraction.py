"""Incremental mail extraction with Structured Streaming.

The extraction stage appended to its output file once per mail. Here new
mail files arriving anywhere below a folder are parsed (same native
expressions as the batch parser) and appended to a Parquet message
table. The checkpoint inside that table's folder records which files were
taken, so a restarted or retried query neither loses nor duplicates a mail.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from maillens.sources.mail import parse_mails


def mail_stream(spark: SparkSession, src_dir: str,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (path, sender, to_list, body, parse_ok) of new mail files."""
    reader = spark.readStream.option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.text(src_dir, wholetext=True)
    raw = raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
    return parse_mails(raw).drop("raw")


def extract_incrementally(spark: SparkSession, src_dir: str, out_dir: str,
                          checkpoint: str | None = None, available_now: bool = True,
                          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append parsed mails to ``out_dir`` (Parquet). ``available_now``
    processes what is there and stops; otherwise it keeps polling. The
    checkpoint belongs to the output: ``out_dir/_checkpoint`` by default
    (readers skip such a folder)."""
    checkpoint = checkpoint or f"{out_dir.rstrip('/')}/_checkpoint"
    writer = (mail_stream(spark, src_dir, max_files_per_trigger).writeStream
              .format("parquet").option("checkpointLocation", checkpoint)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start(out_dir)
