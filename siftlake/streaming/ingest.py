"""Resumable ingestion of captured responses under a budget, as a stream over a folder."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.operators import ledger
from siftlake.sources.captured import CAPTURED

#: Files that one batch takes; the budget is looked at between batches.
FILES = 100


def ingest(spark: SparkSession, inbox: str, store: str, most_records: int | None = None, files: int = FILES) -> int:
    """Take response files (one object a line or a file, as ``CAPTURED``) from ``inbox`` into the ledger below ``store``; returns the records it then holds.

    A run takes what no earlier run took, ``files`` at a time, until nothing is left or the ledger holds ``most_records``.  Files beyond the budget wait for a later
    run: the checkpoint below ``store`` remembers where it stopped.  Acquisitions and records are written under their batch's number, so a
    batch that is run again after a failure replaces itself, and responses held already add nothing.
    """
    base, full = store.rstrip("/"), []

    def held(name: str) -> DataFrame | None:
        """What earlier batches wrote."""
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}")
        there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        return spark.read.parquet(f"{base}/{name}") if there else None

    def records(before: int | None = None) -> int:
        rows = held("source_records")
        return 0 if rows is None else rows.count() if before is None else rows.filter(F.col("batch") < before).count()

    def take(batch: DataFrame, number: int) -> None:
        if most_records is not None and records(number) >= most_records:
            full.append(number)
            raise RuntimeError("the budget is used up")  # the batch isn't committed: a later run begins with it
        fresh, before = ledger.acquisition_rows(batch), held("acquisitions")
        new = fresh.dropDuplicates(["id"]) if before is None else ledger.append_new(before.filter(F.col("batch") < number), fresh)
        new.write.mode("overwrite").parquet(f"{base}/acquisitions/batch={number}")
        kept = spark.read.schema(fresh.schema).parquet(f"{base}/acquisitions/batch={number}")
        ledger.record_rows(kept).write.mode("overwrite").parquet(f"{base}/source_records/batch={number}")

    stream = spark.readStream.schema(CAPTURED).option("maxFilesPerTrigger", files).json(inbox)
    try:
        stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).foreachBatch(take).start().awaitTermination()
    except StreamingQueryException:
        if not full:
            raise
    return records()
