"""Incremental runs: new files only, by the checkpoint of a file stream; each batch is committed by an upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ingest
from ..plans.pipeline import PipelineConfig, ingest_files


def ingest_new_files(spark: SparkSession, config: PipelineConfig, analyzer: ingest.Analyzer, checkpoint: str, embedder: ingest.Embedder | None = None) -> None:
    """Read the files that no earlier run with this checkpoint has seen, then stop. A batch that fails is read again."""

    def each(batch: DataFrame, _: int) -> None:
        files = batch.select("path", F.try_parse_json("value").alias("doc"))
        ingest_files(batch.sparkSession, files, config, analyzer, embedder).collect()  # one row of counts

    stream = spark.readStream.format("text").option("wholetext", "true").load(config.data_dir).select(F.col("_metadata.file_path").alias("path"), "value")
    query = stream.where(F.col("path").endswith(".json")).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
