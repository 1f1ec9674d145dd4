"""Masking by ordered rules, and speakers' pseudonyms.

Null and blank texts pass unchanged. Rules run in their order, once; each is a built-in expression, so a text
column is masked in one projection.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import pystrip

#: Columns that pass verbatim, and columns that hold speakers.
EXCLUDED = ["doc_id", "id", "uuid", "file_format", "doc_type", "last_modified", "created_at", "is_ocr", "timestamp", "content_type", "message_id"]
#: Generated ids: kept too, since masking digits in them breaks joins.
GENERATED = ["thread_id", "post_id", "comment_id"]
SPEAKERS = ["sender_name", "sender", "receiver", "author", "creator", "from", "to"]
#: The rules in their order.
RULES = [
    (r"(?U)(?<!\d)(?:(?:25[0-5]|2[0-4]\d|[01]?\d\d?)\.){3}(?:25[0-5]|2[0-4]\d|[01]?\d\d?)(?!\d)", "[REDACTED_IP]"),
    (r"(?U)https?://[^\s<>\"']+|(?:www\.)[^\s<>\"']+", "[REDACTED_URL]"),
    (r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+", "[REDACTED_EMAIL]"),
    (r"(?U)(?:\+886\s*|0)9\d{2}[\s\-]?\d{3}[\s\-]?\d{3}", "[REDACTED_PHONE]"),
    (r"(?U)(?:\+886\s*|0)[2-8][\s\-]?\d{3,4}[\s\-]?\d{4}", "[REDACTED_PHONE]"),
    (r"(?U)(?<![A-Za-z0-9])[A-Za-z][1289]\d{8}(?![0-9])", "[REDACTED_ID]"),
    (r"(?U)(?<!\d)\d{8}(?!\d)", "[REDACTED_ID]"),
]
ME = "[AUTHOR_ME]"


def mask_text(c: Column, identities: Mapping[str, str] | None = None, words: Mapping[str, str] | None = None, rules: list[tuple[str, str]] | None = None) -> Column:
    """Identities, then sensitive words, literally and in their order; then the rules."""
    out = c
    for table in (identities or {}, words or {}):
        for k, v in table.items():
            out = F.replace(out, F.lit(k), F.lit(v))
    for pattern, tag in RULES if rules is None else rules:
        out = F.regexp_replace(out, pattern, tag)
    return F.when(pystrip(c) == "", c).otherwise(out)


def mask_columns(df: DataFrame, identities: Mapping[str, str] | None = None, words: Mapping[str, str] | None = None) -> DataFrame:
    """Every string in every column, nested ones too, but for excluded, generated and speaker columns."""
    skip = {*EXCLUDED, *GENERATED, *SPEAKERS}

    def walk(c: Column, t: T.DataType, name: str) -> Column:
        if name in skip:
            return c
        if isinstance(t, T.StringType):
            return mask_text(c, identities, words)
        if isinstance(t, T.ArrayType):
            return F.transform(c, lambda x: walk(x, t.elementType, name))
        if isinstance(t, T.StructType):
            return F.when(c.isNotNull(), F.struct(*[walk(c[f.name], f.dataType, f.name).alias(f.name) for f in t.fields]))
        return c

    return df.select(*[walk(F.col(f"`{f.name}`"), f.dataType, f.name).alias(f.name) for f in df.schema.fields])


def with_speakers(df: DataFrame, scope: str, speaker: str | list[str], order: list[str], identities: list[str] | None = None, out: str | list[str] = "speaker_tag") -> DataFrame:
    """`out`: ``[SPEAKER_n]`` by first appearance in the scope, ``[AUTHOR_ME]`` for own identities; null stays null.

    Several columns share one numbering, in a row by the order in which they are given; each has its own `out`.
    First appearances are aggregated per speaker before they are numbered, so a large scope is no large window."""
    speakers, outs = ([speaker], [out]) if isinstance(speaker, str) else (speaker, out)
    own = lambda c: pystrip(F.col(c)).isin(identities or [])
    x = df.withColumns({f"__name{i}": F.when(~own(c), pystrip(F.col(c))) for i, c in enumerate(speakers)})
    met = F.explode(F.array(*[F.struct(F.lit(i).alias("at"), F.col(f"__name{i}").alias("name")) for i in range(len(speakers))]))
    met = x.select(F.col(scope).alias("__scope"), F.struct(*order).alias("__order"), met.alias("__met")).where("__met.name is not null")
    firsts = met.groupBy("__scope", F.col("__met.name").alias("__key")).agg(F.min(F.struct("__order", "__met.at")).alias("__first"))
    numbers = firsts.select("__scope", "__key", F.row_number().over(Window.partitionBy("__scope").orderBy("__first")).alias("__n"))
    tags = {}
    for i, (c, o) in enumerate(zip(speakers, outs, strict=True)):
        n = numbers.select(F.col("__scope").alias(f"__scope{i}"), F.col("__key").alias(f"__key{i}"), F.col("__n").alias(f"__n{i}"))
        x = x.join(n, F.col(scope).eqNullSafe(F.col(f"__scope{i}")) & (F.col(f"__name{i}") == F.col(f"__key{i}")), "left")
        tags[o] = F.when(own(c), ME).when(F.col(f"__n{i}").isNotNull(), F.concat(F.lit("[SPEAKER_"), F.col(f"__n{i}").cast("string"), F.lit("]")))
    return x.withColumns(tags).drop(*[f"__{k}{i}" for k in ("name", "scope", "key", "n") for i in range(len(speakers))])


#: Kinds of entities that are replaced; others get the general tag.
ENTITY_TAGS = {"PERSON": "[REDACTED_PERSON]", "LOCATION": "[REDACTED_LOCATION]", "ORGANIZATION": "[REDACTED_ORG]"}


def mask_entities(c: Column, recognizer: Callable[[str], list[tuple[int, int, str]]] | None = None, tags: Mapping[str, str] | None = None) -> Column:
    """`c` with the entities that `recognizer` finds, as (start, end, kind), replaced. Off without a recognizer; a
    text for which it fails stays unchanged."""
    if recognizer is None:
        return c
    names = dict(tags or ENTITY_TAGS)

    def one(t: str | None) -> str | None:
        if not t or not t.strip():
            return t
        try:
            found = sorted(recognizer(t), reverse=True)
        except Exception:  # noqa: BLE001
            return t
        for a, b, kind in found:
            t = t[:a] + names.get(kind, f"[REDACTED_{kind}]") + t[b:]
        return t

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(one)

    return run(c)
