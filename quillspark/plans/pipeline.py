"""The chain from rag-ready documents to the chunk table, and its configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import chunking, ingest, masking
from ..session import cut
from ..sources import exports, sinks


@dataclass(frozen=True)
class PipelineConfig:
    """What a run needs; nothing is read or created when this is imported."""

    data_dir: str
    table_dir: str
    dead_letter_dir: str
    my_email: str = "example@example.com"
    identities: dict[str, str] = field(default_factory=dict)
    sensitive_words: dict[str, str] = field(default_factory=dict)
    chunk_size: int = chunking.SIZE
    chunk_overlap: int = chunking.OVERLAP
    resume: bool = True

    def __post_init__(self) -> None:
        if not 0 <= self.chunk_overlap < self.chunk_size:
            raise ValueError("chunk_overlap must be below chunk_size")
        for name in ("data_dir", "table_dir", "dead_letter_dir"):
            if not getattr(self, name):
                raise ValueError(f"{name} is missing")


def ingest_files(spark: SparkSession, files: DataFrame, config: PipelineConfig, analyzer: ingest.Analyzer, embedder: ingest.Embedder | None = None) -> DataFrame:
    """Flatten, mask, judge, split, compare and upsert rag-ready files (path, doc); gives the run's metrics. With
    `config.resume`, dead letters of earlier runs are tried again, and deleted after the commit."""
    docs = exports.flatten_rag(files).withColumn("page_content", masking.mask_text(F.col("page_content"), config.identities, config.sensitive_words))
    docs = docs.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "doc_pos.*", "page_content", "data_source", dates.parse_original_time(F.col("original_time")).alias("original_time"))
    seen = cut(ingest.judged(docs, analyzer))  # costly and not repeatable
    kept = seen.where("error is null and not coalesce(is_noise, false)").withColumn("doc_key", F.concat_ws("#", "shape", F.lpad(F.col("i").cast("string"), 12, "0"), F.lpad((F.col("j") + 1).cast("string"), 12, "0")))
    chunks = chunking.chunked(kept, "page_content", "file_name", "doc_key", F.expr("substring(doc_key, 1, length(doc_key) - 16)"), config.chunk_size, config.chunk_overlap)
    table = sinks.ChunkTable(spark, config.table_dir)
    chunks = ingest.changed(chunks, table.read())
    if embedder is not None:
        chunks = ingest.embedded(chunks, embedder)
    chunks = chunks.select("file_name", "raw_content", "data_source", "content_category", F.col("generated_tags").alias("style_tags"), "is_noise", "information_weight", "content_hash", "chunk_index", *(["embedding"] if embedder is not None else []), "original_time")
    letters = sinks.dead_letters(spark, config.dead_letter_dir) if config.resume else []
    dead = table.upsert(cut(sinks.recovered(spark, chunks, letters)), compared=True)
    sinks.write_dead_letters(dead, config.dead_letter_dir)
    sinks.delete_letters(spark, letters)
    return ingest.run_metrics(seen)


def run(spark: SparkSession, config: PipelineConfig, analyzer: ingest.Analyzer, embedder: ingest.Embedder | None = None) -> DataFrame:
    return ingest_files(spark, exports.read_json_files(spark, config.data_dir, recursive=False), config, analyzer, embedder)
