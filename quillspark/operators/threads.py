"""Grouping, ordering and linking of messages, posts and comments.

Positions in groups are computed in two steps, within buckets of the order and over the buckets' counts, so a group
may hold any share of the rows: no window holds more than one bucket or one row for each bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, keys: list[str], bucket: Column | list[Column], order: list[str], out: str = "position") -> DataFrame:
    """`out`: 0-based position of each row among the rows of its keys, by bucket, then by `order`.

    `bucket` must not fall when `order` rises (a prefix of the first order column, or its quotient). Of several buckets
    each is finer than the one before; no window then holds more than one bucket's finer ones, so a bucket may be hot
    too. Null keys form a group; ties are broken by the further order columns."""
    buckets = bucket if isinstance(bucket, list) else [bucket]
    names = [f"__b{i}" for i in range(len(buckets))]
    x = df.withColumns(dict(zip(names, buckets, strict=True)))
    counts = x.groupBy(*keys, *names).agg(F.count("*").alias("__n"))
    x = x.withColumn("__r", F.row_number().over(Window.partitionBy(*keys, *names).orderBy(*[F.asc_nulls_first(o) for o in order])))
    position = F.col("__r") - 1
    for level in range(len(names), 0, -1):
        by = [*keys, *names[: level - 1]]
        before = F.sum("__n").over(Window.partitionBy(*by).orderBy(F.asc_nulls_first(names[level - 1])).rowsBetween(Window.unboundedPreceding, -1))
        on = [*by, names[level - 1]]
        shift = counts.select(*[F.col(k).alias(f"__k{level}_{i}") for i, k in enumerate(on)], F.coalesce(before, F.lit(0)).alias(f"__shift{level}"))
        match = F.lit(True)
        for i, k in enumerate(on):
            match = match & x[k].eqNullSafe(shift[f"__k{level}_{i}"])
        x = x.join(shift, match).drop(*[f"__k{level}_{i}" for i in range(len(on))])
        position = position + F.col(f"__shift{level}")
        counts = counts.groupBy(*by).agg(F.sum("__n").alias("__n"))
    return x.withColumn(out, position).drop("__r", *names, *[f"__shift{i + 1}" for i in range(len(names))])


def carried_forward(df: DataFrame, keys: list[str], bucket: Column, order: str, value: str, initial: str | None, out: str) -> DataFrame:
    """`out`: the last value that is not null up to each row, `initial` before the first."""
    x = df.withColumn("__b", bucket)
    lasts = x.where(F.col(value).isNotNull()).groupBy(*keys, "__b").agg(F.max_by(value, order).alias("__last"))
    buckets = x.select(*keys, "__b").distinct().join(lasts, [*keys, "__b"], "left")
    w = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = buckets.withColumn("__before", F.last("__last", ignorenulls=True).over(w)).drop("__last")
    own = F.last(value, ignorenulls=True).over(Window.partitionBy(*keys, "__b").orderBy(order))
    x = x.withColumn("__own", own).join(before, [*keys, "__b"], "left")
    return x.withColumn(out, F.coalesce("__own", "__before", F.lit(initial))).drop("__b", "__own", "__before")


def thread_summary(messages: DataFrame, key: str = "subject_clean") -> DataFrame:
    """One row for each thread: its id, whether I wrote in it, its number of messages."""
    return messages.groupBy(key).agg(F.md5(F.first(key)).alias("thread_key"), F.coalesce(F.bool_or("is_me"), F.lit(False)).alias("mine"), F.count("*").alias("total_messages"))


def match_comments(posts: DataFrame, comments: DataFrame, prefix: int = 20) -> DataFrame:
    """comment_id, post_id (null: an orphan): the first post (by post_pos) whose content's beginning stands in the
    comment's target_title. Every substring of the title of a length that a beginning has meets the beginnings in a
    hash join; empty beginnings match nothing."""
    heads = posts.withColumn("head", F.substring("page_content", 1, prefix)).where("head <> ''").groupBy("head").agg(F.min(F.struct("post_pos", "post_id")).alias("p"))
    sizes = heads.select(F.length("head").alias("size")).distinct()  # at most `prefix` rows
    t = comments.where("target_title <> ''").join(F.broadcast(sizes), F.length("target_title") >= F.col("size"))
    grams = t.select("comment_id", F.explode(F.expr("array_distinct(transform(sequence(1, length(target_title) - size + 1), i -> substring(target_title, i, size)))")).alias("head"))
    best = grams.join(heads, "head").groupBy("comment_id").agg(F.min("p").alias("p"))
    return comments.join(best, "comment_id", "left").select("comment_id", F.col("p.post_id").alias("post_id"))


def orphan_posts(comments: DataFrame, matches: DataFrame) -> DataFrame:
    """A post for each comment that matches none."""
    x = comments.join(matches.where("post_id is null").select("comment_id"), "comment_id")
    return x.select(F.concat(F.lit("orphan_"), F.col("comment_id").cast("string")).alias("post_id"), F.lit("Orphaned Comment").alias("page_content"), F.lit("comments").alias("source"), "timestamp")
