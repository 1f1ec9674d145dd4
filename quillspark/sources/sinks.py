"""Sinks: JSON in batches, the chunk table, dead letters. Runs write into folders of their own, so names never clash."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import KEY, TABLE, changed, upserted, validated


def write_json_batches(df: DataFrame, folder: str, size: int = 100) -> str:
    """JSON lines with at most `size` items in a file, in a new folder of this run; characters stay as they are."""
    at = f"{folder.rstrip('/')}/run_{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", size).json(at)
    return at


def write_posts_and_threads(posts: DataFrame, threads: DataFrame, folder: str, size: int = 100) -> dict[str, str]:
    """Posts and threads each in batches of their own kind."""
    return {kind: write_json_batches(df, f"{folder.rstrip('/')}/kind={kind}", size) for kind, df in (("posts", posts), ("messages", threads))}


class ChunkTable:
    """A chunk table in a folder: versions are whole and written beside each other, a marker names the current one."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        fs, path = self._files()
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        ok = [int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()]
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(v for v in ok if fs.exists(done(f"{self.folder}/v{v}/_SUCCESS")))

    def read(self) -> DataFrame:
        """The current version; an empty table if there is none."""
        v = self.versions()
        return self.spark.read.parquet(f"{self.folder}/v{v[-1]}") if v else self.spark.createDataFrame([], TABLE)

    def upsert(self, chunks: DataFrame, compared: bool = False) -> DataFrame:
        """Write the next version with changed and new chunks; a run that fails leaves the current one. Gives the dead
        letters. `compared`: unchanged chunks are already left out."""
        now = self.read()
        good, dead = validated(chunks)
        new = (good if compared else changed(good, now)).withColumn("created_at", F.current_timestamp())
        v = self.versions()
        upserted(now, new.select(*[c for c in now.columns if c in new.columns], *[F.lit(None).cast(now.schema[c].dataType).alias(c) for c in now.columns if c not in new.columns])).write.mode("overwrite").parquet(f"{self.folder}/v{(v[-1] if v else 0) + 1}")
        return dead


def write_dead_letters(dead: DataFrame, folder: str) -> None:
    """In a folder of this run, so that they can be deleted once a later run has taken them in."""
    dead.write.parquet(f"{folder.rstrip('/')}/letters_{uuid.uuid4().hex}")


def _folder(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def dead_letters(spark: SparkSession, folder: str) -> list[str]:
    """The folders of letters that earlier runs left."""
    fs, path = _folder(spark, folder)
    return sorted(s.getPath().toString() for s in fs.listStatus(path) if s.getPath().getName().startswith("letters_")) if fs.exists(path) else []


def delete_letters(spark: SparkSession, letters: list[str]) -> None:
    """After the commit of a run that took them in: those that failed again are in that run's own folder."""
    for folder in letters:
        fs, path = _folder(spark, folder)
        fs.delete(path, True)


def recovered(spark: SparkSession, chunks: DataFrame, letters: list[str]) -> DataFrame:
    """`chunks` and the dead letters of earlier runs whose key they don't hold; delete the letters only after the commit."""
    if not letters:
        return chunks
    old = spark.read.parquet(*letters)
    return chunks.unionByName(old.select(*[c for c in chunks.columns if c in old.columns]).join(chunks.select(*KEY), KEY, "left_anti"), allowMissingColumns=True)
