import random

import pytest
from quillspark.llm.packing import pack, plan, token_sizes
from pyspark.sql import functions as F


@pytest.mark.parametrize("seed", range(30))
def test_plan_against_its_rules(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 64, 512])
    histogram = {s: r.choice([0, 1, 2, 7, 1000]) for s in r.sample(range(1, capacity + 1), min(capacity, r.choice([1, 5, 10])))}
    rows = plan(histogram, capacity)
    bins: dict[int, list[tuple[int, int]]] = {}
    for size, n in histogram.items():
        own = sorted(x for x in rows if x[0] == size)
        assert sum(b - a for _, a, b, *_ in own) == n and all(x[2] == y[1] for x, y in zip(own, own[1:], strict=False))
    for size, lo, hi, container, each, place in rows:
        for k in range(hi - lo):
            bins.setdefault(container + k // each, []).append((place + k % each, size))
    assert all(sum(s for _, s in b) <= capacity and sorted(p for p, _ in b) == list(range(len(b))) for b in bins.values())
    total = sum(s * n for s, n in histogram.items())
    # No two containers could be one: all but one are more than half full.
    assert sum(sum(s for _, s in b) * 2 <= capacity for b in bins.values()) <= 1 or total == 0


def test_pack_every_token_once(spark):
    sizes = spark.createDataFrame([(i, n) for i, n in enumerate([1, 5, 5, 5, 9, 10, 11, 25, 3, 2, 30, 7] * 20)], "doc_id long, tokens long").withColumn("place", F.lit("clash"))
    specs = spark.createDataFrame([("a", 10), ("b", 64)], "container_kind string, capacity_tokens long")
    rows = pack(sizes, specs).collect()
    for kind, capacity in (("a", 10), ("b", 64)):
        own = [r for r in rows if r.container_kind == kind]
        assert sum(r.tokens for r in own) == sum([1, 5, 5, 5, 9, 10, 11, 25, 3, 2, 30, 7]) * 20
        assert len({(r.doc_id, r.piece) for r in own}) == len(own) == len({(r.container_id, r.place) for r in own})
        per: dict[int, int] = {}
        for r in own:
            per[r.container_id] = per.get(r.container_id, 0) + r.tokens
        assert max(per.values()) <= capacity and set(per) == set(range(len(per)))
        assert all(r.piece == 0 or r.first_token == r.piece * capacity for r in own)


def test_nulls_empty_and_long_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (4, "word " * 5000), (5, "one two")], "doc_id long, text string")
    got = {r.doc_id: r.tokens for r in token_sizes(docs).collect()}
    assert set(got) == {3, 4, 5} and got[3] == 2 == got[5] and got[4] >= 5000
    assert pack(token_sizes(docs.limit(0)), spark.createDataFrame([("a", 10)], "container_kind string, capacity_tokens long")).count() == 0


def test_fill_is_near_the_lower_bound(spark, monkeypatch):
    import random

    from quillspark.llm import packing

    r = random.Random(5)
    for shares in (20_000, 100):
        monkeypatch.setattr(packing, "SHARE_TEXTS", shares)
        sizes = [min(9000, int(r.lognormvariate(5.5, 1.2)) + 1) for _ in range(3000)] + [120] * 1500
        df = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, tokens long")
        for capacity in (512, 2048):
            specs = spark.createDataFrame([("k", capacity)], "container_kind string, capacity_tokens long")
            out = packing.pack(df, specs).toPandas()
            assert out.groupby("container_id").tokens.sum().max() <= capacity and out.tokens.sum() == sum(sizes)
            assert not out.duplicated(["container_id", "place"]).any()
            assert out.container_id.nunique() <= -(-sum(sizes) // capacity) * 1.02 + 1
