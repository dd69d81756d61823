"""An extension: volumes that arrive in a folder are picked once each, by a stream with its own checkpoint."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..scratch import shared_folder


def arriving(spark: SparkSession, folder: str) -> DataFrame:
    """path, modified of new *.mrc files; contents aren't kept."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.mrc").load(folder)
    return files.select("path", F.col("modificationTime").alias("modified"))


def pick_arrivals(spark: SparkSession, segmentations: str, tomograms: str, out: str, pick, name: str = "arrivals") -> StreamingQuery:
    """Run pick(manifests of the new segmentations) for all that has arrived; results are Parquet by batch.

    A batch that is run again after a failure overwrites its own folder, so picks come once.
    """
    from ..sources.mrc import manifests

    def each(batch: DataFrame, number: int) -> None:
        stems = [Path(r.path).stem for r in batch.select("path").collect()]
        found, _ = manifests(spark, segmentations, tomograms)
        pick(found.where(F.col("tomogram_id").isin(stems))).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = arriving(spark, segmentations).writeStream.foreachBatch(each).option("checkpointLocation", f"{shared_folder(spark)}/{name}")
    return writer.trigger(availableNow=True).start()
