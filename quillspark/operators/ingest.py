"""From rag-ready documents to the chunk table: shapes, metadata, noise, changes, upsert, dead letters."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["file_name", "chunk_index"]
#: The widest texts of the table's columns.
WIDTHS = {"file_name": 255, "data_source": 100, "content_category": 100, "content_hash": 64}
TABLE = "file_name string, raw_content string, ai_summary string, data_source string, content_category string, style_tags array<string>, is_noise boolean, information_weight decimal(3,2), content_hash string, chunk_index int, embedding array<float>, original_time timestamp, created_at timestamp"


class Analyzer(Protocol):
    """Judges documents: a frame with page_content gives is_noise, generated_tags, content_category, information_weight."""

    def analyze(self, texts: list[str]) -> list[dict]: ...


class Embedder(Protocol):
    """Gives one vector for each text."""

    def embed(self, texts: list[str]) -> list[list[float]]: ...


def standardized(meta: Column, source: str, default: str) -> tuple[Column, Column]:
    """(original_time, data_source) of a metadata JSON text. A key that is there wins even if its value is null."""
    return standardized_map(F.from_json(meta, "map<string,string>"), F.lit(default), source)


def standardized_map(meta: Column, default: Column, source: str = "source") -> tuple[Column, Column]:
    """The same of a map."""
    has = lambda k: F.coalesce(F.map_contains_key(meta, k), F.lit(False))
    value = lambda k: F.try_element_at(meta, F.lit(k))
    time = F.when(has("original_time"), value("original_time")).otherwise(F.coalesce(value("timestamp"), value("created_at")))
    origin = F.when(has("data_source"), value("data_source")).when(has(source), value(source)).otherwise(default)
    return time, origin


def merged(thread: Column, message: Column, ids: Column) -> Column:
    """Maps of metadata: the message's entries win over the thread's, the ids over both."""
    last = lambda a, b: F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)
    none = F.create_map().cast("map<string,string>")
    return last(last(F.coalesce(thread, none), F.coalesce(message, none)), F.coalesce(ids, none))


def judged(docs: DataFrame, analyzer: Analyzer, batch: int = 1, attempts: int = 5, wait: float = 2.0, calls: int = 20) -> DataFrame:
    """`docs` with the verdict and `error` (null unless the analyzer failed for the row after all attempts).

    Each task has at most `calls` calls of `batch` texts open at once. A call that fails for several texts is made again
    for each, so an error is that of its own row. Cut the result (it is costly and need not be repeatable) before it is
    used twice."""
    verdict = "is_noise boolean, generated_tags array<string>, content_category string, information_weight double, error string"
    fields = [f.strip().split(" ")[0] for f in verdict.split(",")]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def call(texts: list[str]) -> list[dict]:
            got = with_retry(lambda: [v | {"error": None} for v in analyzer.analyze(texts)], len(texts), attempts, wait)
            if len(texts) > 1 and all(g["error"] is not None for g in got):
                return [x for t in texts for x in call([t])]
            return got

        for pdf in it:
            texts = pdf["page_content"].tolist()
            with ThreadPoolExecutor(calls) as pool:
                rows = [r for part in pool.map(call, [texts[i : i + batch] for i in range(0, len(texts), batch)]) for r in part]
            yield pd.concat([pdf.reset_index(drop=True), pd.DataFrame([[r.get(f) for f in fields] for r in rows], columns=fields, dtype=object)], axis=1)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInPandas(run, f"{schema}, {verdict}")


def with_retry(call, n: int, attempts: int = 5, wait: float = 2.0, most: float = 10.0) -> list[dict]:
    """Only failures of the network are tried again, with growing pauses; others fail the batch's rows at once."""
    import time

    for k in range(attempts):
        try:
            return call()
        except (ConnectionError, TimeoutError) as e:
            if k + 1 == attempts:
                return [{"error": str(e) or type(e).__name__}] * n
            time.sleep(min(most, wait * 2**k))
        except Exception as e:  # noqa: BLE001
            return [{"error": str(e) or type(e).__name__}] * n
    return []


def embedded(chunks: DataFrame, embedder: Embedder, batch: int = 100) -> DataFrame:
    """`chunks` with `embedding`, in requests of `batch` texts."""

    @F.pandas_udf("array<float>")
    def vectors(s: pd.Series) -> pd.Series:
        out: list = []
        for i in range(0, len(s), batch):
            out += embedder.embed(s.iloc[i : i + batch].tolist())
        return pd.Series(out, index=s.index)

    return chunks.withColumn("embedding", vectors("raw_content"))


def changed(chunks: DataFrame, target: DataFrame) -> DataFrame:
    """Chunks whose key is new or whose hash differs: one equi-join with the target's keys and hashes."""
    old = target.select(*KEY, F.col("content_hash").alias("__old"))
    return chunks.join(old, KEY, "left").where(~F.col("content_hash").eqNullSafe(F.col("__old"))).drop("__old")


def upserted(target: DataFrame, chunks: DataFrame) -> DataFrame:
    """The target after the upsert: each key once, the new row where there is one. Repeated new keys: the greatest
    hash counts, so that retries agree."""
    cols = target.columns
    new = chunks.groupBy(*KEY).agg(F.max_by(F.struct(*[c for c in cols if c not in KEY]), F.coalesce("content_hash", F.lit(""))).alias("__new"), F.lit(True).alias("__is"))
    x = target.withColumn("__was", F.lit(True)).join(new, KEY, "full")
    return x.select(*[F.col(c) if c in KEY else F.when(F.col("__is"), F.col("__new")[c]).otherwise(F.col(c)).alias(c) for c in cols])


def appended(target: DataFrame, chunks: DataFrame) -> DataFrame:
    """The target and the rows of keys that it doesn't have."""
    return target.unionByName(chunks.join(target.select(*KEY), KEY, "left_anti").select(*target.columns))


def stale_chunks(target: DataFrame, chunks: DataFrame) -> DataFrame:
    """Rows of the target whose file now has fewer chunks."""
    most = chunks.groupBy("file_name").agg(F.max("chunk_index").alias("__most"))
    return target.join(most, "file_name").where(F.col("chunk_index") > F.col("__most")).drop("__most")


def validated(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the table, dead letters with the error): one bad value fails its own row only."""
    weight = F.col("information_weight").try_cast("decimal(3,2)")
    errors = [F.when(F.length(c) > n, F.lit(f"{c} is longer than {n}")) for c, n in WIDTHS.items() if c in chunks.columns]
    errors += [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in ("file_name", "raw_content", "content_hash", "chunk_index")]
    errors.append(F.when(F.col("information_weight").isNotNull() & weight.isNull(), F.lit("information_weight is out of range")))
    x = chunks.withColumn("error", F.coalesce(*errors))
    good = x.where("error is null").drop("error").withColumn("information_weight", F.coalesce(weight, F.lit(0.5).cast("decimal(3,2)")))
    return good, x.where("error is not null").withColumn("failed_at", F.current_timestamp())


def run_metrics(docs: DataFrame) -> DataFrame:
    """One row of counts of a judged run (is_noise, error)."""
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    failed = F.col("error").isNotNull()
    return docs.agg(F.count("*").alias("total_read"), n(~failed & F.coalesce("is_noise", F.lit(False))).alias("noise_filtered"), n(failed).alias("processing_errors"), n(~failed & ~F.coalesce("is_noise", F.lit(False))).alias("kept"))


def batch_numbers(df: DataFrame, size: int, order: str, bucket: Column | list[Column], out: str = "batch_no") -> DataFrame:
    """`out`: number of the batch of `size` rows in the order of a column; buckets as in `numbered`."""
    from .threads import numbered

    x = numbered(df.withColumn("__all", F.lit(0)), ["__all"], bucket, [order], "__pos")
    return x.withColumn(out, F.floor(F.col("__pos") / size).cast("long")).drop("__all", "__pos")
