"""Problem 6: texts of varying length in containers of fixed capacity.

Texts above a third of the capacity are matched first: each with the largest other one that still fits, at most two
to a container. Smaller texts then go, largest first, into the tightest gap that holds them, and only then into
containers of their own. A text is split only if it alone exceeds the capacity.

The matching works on the histogram of sizes, which has at most as many rows as the capacity has tokens however
many texts there are. It gives ranges: the texts of one size, numbered in Spark, from .. to, are in these
containers at these places. The texts meet their range by their size and number. Numbers are given within hashed
shares of each size and shifted by the shares' sums, so a size may hold a third of all texts.

Defined results: null and empty texts have no tokens and are in no container. Copies are packed each on their own.
Ties of size are ordered by doc_id. Texts are measured whole.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut, table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The public pattern by which that tokenizer splits text.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The texts of one size are numbered in hashed shares, of which there is one for so many texts of any size: should a
#: size hold all texts, a task numbers about so many.
SHARE_TEXTS = 20_000

_encoders: dict[str, object] = {}


def encoder(path: str):
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def token_sizes(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, tokens of the texts with tokens. `tokenizer`: a vocabulary file that all executors can read."""

    def measure(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(tokenizer)
        for pdf in it:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "tokens": [len(e.encode_ordinary(t)) for t in pdf["text"]]})

    return docs.where("text is not null and text <> ''").select("doc_id", "text").mapInPandas(measure, "doc_id long, tokens long").where("tokens > 0")


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(size, from, to, container, each, place): the texts of `size` numbered from .. to - 1 are in the containers
    from `container` on, `each` in every one of them, the first at `place`. At most a few rows for each size."""
    left = {s: n for s, n in histogram.items() if n > 0}
    groups: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}  # gap: [(contents, containers)]
    gaps: list[int] = []

    def put(contents: list[tuple[int, int]], n: int) -> None:
        gap = capacity - sum(s * k for s, k in contents)
        if gap not in groups:
            groups[gap] = []
            bisect.insort(gaps, gap)
        groups[gap].append((contents, n))

    large = sorted(s for s in left if s * 3 > capacity)
    for s in reversed(large):
        while left[s]:
            i = bisect.bisect_right(large, min(s, capacity - s)) - 1
            while i >= 0 and (not left[large[i]] or large[i] == s and left[s] < 2):
                i -= 1
            if i < 0:
                put([(s, 1)], left[s])
                left[s] = 0
            elif large[i] == s:
                put([(s, 2)], left[s] // 2)
                left[s] %= 2
            else:
                n = min(left[s], left[large[i]])
                put([(s, 1), (large[i], 1)], n)
                left[s] -= n
                left[large[i]] -= n
    for s in sorted((s for s in left if s * 3 <= capacity), reverse=True):
        n = left[s]
        while n:
            i = bisect.bisect_left(gaps, s)
            if i == len(gaps):
                each = capacity // s
                if n >= each:
                    put([(s, each)], n // each)
                if n % each:
                    put([(s, n % each)], 1)
                break
            gap = gaps[i]
            contents, m = groups[gap].pop()
            if not groups[gap]:
                del groups[gap]
                gaps.pop(i)
            each = gap // s
            full = min(m, n // each)
            if full:
                put([*contents, (s, each)], full)
                n, m = n - full * each, m - full
            if m and n and n < each:
                put([*contents, (s, n)], 1)
                n, m = 0, m - 1
            if m:
                put(contents, m)
    out, used, container = [], dict.fromkeys(histogram, 0), 0
    for gap in sorted(groups):
        for contents, m in groups[gap]:
            place = 0
            for s, each in contents:
                out.append((s, used[s], used[s] + m * each, container, each, place))
                used[s] += m * each
                place += each
            container += m
    return out


def pack(sizes: DataFrame, specs: DataFrame) -> DataFrame:
    """container_kind, container_id, place, doc_id, piece, first_token, tokens. `sizes`: doc_id, tokens; `specs`:
    container_kind, capacity_tokens, a fixed, small table."""
    kinds = {r["container_kind"]: r["capacity_tokens"] for r in specs.where("capacity_tokens > 0").collect()}
    spec = F.explode(F.array(*[F.struct(F.lit(k).alias("container_kind"), F.lit(c).cast("long").alias("capacity")) for k, c in sorted(kinds.items())]))
    x = sizes.select("doc_id", F.col("tokens").alias("all"), spec.alias("k")).select("doc_id", "all", "k.*")
    # Pieces of a text that exceeds the capacity: full ones and a rest.
    x = x.withColumn("piece", F.explode(F.expr("sequence(0, cast((all - 1) div capacity as int))")))
    x = x.withColumn("first_token", F.col("piece") * F.col("capacity")).withColumn("tokens", F.least("capacity", F.col("all") - F.col("first_token")))
    shares = -(-sizes.count() // SHARE_TEXTS) or 1
    x = x.withColumn("share", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shares)).cast("int"))
    per_share = cut(x.groupBy("container_kind", "tokens", "share").agg(F.count("*").alias("n")))
    histogram = per_share.groupBy("container_kind", "tokens").agg(F.sum("n").alias("n")).collect()  # at most one row for each token of each capacity
    rows = []
    for kind, capacity in kinds.items():
        rows += [(kind, *r) for r in plan({r["tokens"]: r["n"] for r in histogram if r["container_kind"] == kind}, capacity)]
    ranges = sizes.sparkSession.createDataFrame(pd.DataFrame(rows, columns=["kind", "size", "lo", "hi", "container", "each", "at"]), "kind string, size long, lo long, hi long, container long, each long, at long")
    shift = per_share.withColumn("shift", F.sum("n").over(Window.partitionBy("container_kind", "tokens").orderBy("share").rowsBetween(Window.unboundedPreceding, -1))).select("container_kind", "tokens", "share", F.coalesce("shift", F.lit(0)).alias("shift"))
    x = x.withColumn("no", F.row_number().over(Window.partitionBy("container_kind", "tokens", "share").orderBy("doc_id", "piece")) - 1)
    x = x.join(shift, ["container_kind", "tokens", "share"]).withColumn("no", F.col("no") + F.col("shift"))
    # Ranges: a few for each token of each capacity, whatever the number of texts.
    x = x.join(F.broadcast(ranges), (F.col("container_kind") == F.col("kind")) & (F.col("tokens") == F.col("size")) & (F.col("no") >= F.col("lo")) & (F.col("no") < F.col("hi")))
    within = F.col("no") - F.col("lo")
    return x.select("container_kind", (F.col("container") + F.floor(within / F.col("each"))).cast("long").alias("container_id"), (F.col("at") + within % F.col("each")).cast("int").alias("place"), "doc_id", "piece", "first_token", "tokens")


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container, and the place in it, of each text or piece, for each kind of container."""
    return pack(cut(token_sizes(table(spark, sf_dir, "documents"))), table(spark, sf_dir, "container_specs"))


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """container_kind, containers, tokens, fill: how full the containers are."""
    specs = table(spark, sf_dir, "container_specs")  # fixed table
    x = p6_containers(spark, sf_dir).groupBy("container_kind").agg((F.max("container_id") + 1).alias("containers"), F.sum("tokens").alias("tokens"))
    return x.join(F.broadcast(specs), "container_kind").select("container_kind", "containers", "tokens", (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("fill"))


QUERIES = {"p6_containers": p6_containers, "p6_fill": p6_fill}
