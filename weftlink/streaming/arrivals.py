"""Linking records as they arrive, with everything learned held fixed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from weftlink.functions import text
from weftlink.plans.pipeline import Linkage


def normalized(stream: DataFrame) -> DataFrame:
    """The normalized stream: row-wise, so it has no state and needs no watermark."""
    return text.normalize(stream)


def link_arrivals(stream: DataFrame, owners: DataFrame, fitted: dict, linkage: Linkage, output: str, checkpoint: str) -> StreamingQuery:
    """Match every micro-batch of candidate records against the fixed S1 records.

    A batch's matches are written under its number, so a batch that is run again after a
    failure replaces its own rows only.
    """

    def run(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        records = owners.select(*batch.columns).unionByName(batch)
        matches, _ = linkage.predict(fitted, records)
        matches.write.mode("overwrite").parquet(f"{output}/batch={number}")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).start()
