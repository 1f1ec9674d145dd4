"""Texts in overlapping chunks, numbered within their file."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import pystrip
from .threads import numbered

SIZE, OVERLAP = 800, 100
SEPARATORS = ("\n\n", "\n", " ", "")


def split_text(text: str, size: int = SIZE, overlap: int = OVERLAP, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Pieces of at most `size` characters, cut at the coarsest separator that stands in the text, each with up to
    `overlap` characters of the one before; a separator stays with the piece that follows it."""
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    sep, finer = separators[at], separators[at + 1 :]
    parts = list(text) if sep == "" else [p for p in re.split(f"(?={re.escape(sep)})", text) if p]
    if sep and any(p.startswith(sep) and p[len(sep) :].startswith(sep[:1]) for p in parts):
        # Lookahead splits inside runs of the separator too; keep each cut at a whole separator.
        pieces = text.split(sep)
        parts = [p for p in [pieces[0], *[sep + x for x in pieces[1:]]] if p]
    out: list[str] = []
    held: list[str] = []
    total = 0

    def flush() -> None:
        joined = "".join(held).strip()
        if joined:
            out.append(joined)

    for p in parts:
        if len(p) >= size and finer and len(p) > size or len(p) > size:
            if held:
                flush()
                held, total = [], 0
            out += split_text(p, size, overlap, finer) if finer else [p.strip()]
            continue
        if held and total + len(p) > size:
            flush()
            while held and (total > overlap or total + len(p) > size):
                total -= len(held.pop(0))
        held.append(p)
        total += len(p)
    if held:
        flush()
    return out


def chunks_of(c: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """array<string>: short texts are one chunk (their trimmed text) in the JVM; long ones are split by Arrow batches."""

    @F.pandas_udf("array<string>")
    def split(s: pd.Series) -> pd.Series:
        return s.map(lambda t: split_text(t, size, overlap) if t else [])

    t = F.coalesce(c, F.lit(""))
    bare = pystrip(t)
    short = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.array(bare))
    return F.when(F.length(t) <= size, short).otherwise(split(F.when(F.length(t) > size, t)))


def chunked(docs: DataFrame, text: str, file: str, order: str, bucket: Column, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """`docs` by chunk: raw_content, content_hash and the 0-based chunk_index over the chunks of each file."""
    x = docs.select("*", F.posexplode(chunks_of(F.col(text), size, overlap)).alias("chunk_pos", "raw_content"))
    x = x.withColumn("content_hash", F.sha2("raw_content", 256))
    return numbered(x, [file], bucket, [order, "chunk_pos"], "chunk_index").withColumn("chunk_index", F.col("chunk_index").cast("int"))
