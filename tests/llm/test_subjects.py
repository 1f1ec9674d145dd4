import random

from quillspark.llm.subjects import p8_found, terms
from pyspark.sql import functions as F

WORDS = {"music": ["violin", "melody", "choir", "rehearsal", "tempo", "sonata"], "sport": ["goalkeeper", "striker", "referee", "tournament", "sprint", "medal"]}
DAILY = ["lamp", "rug", "parcel", "umbrella", "candle", "scarf"]


def test_terms(spark):
    r = spark.createDataFrame([("The Violin, 琴聲很好 a b",)], "s string").select(terms(F.col("s")).alias("t")).first()
    assert r.t == ["the", "violin", "琴聲", "聲很", "很好"]


def test_areas_of_documents(spark, tmp_path):
    r = random.Random(1)
    say = lambda a: f"We compared the {r.choice(WORDS.get(a, DAILY))} with the {r.choice(WORDS.get(a, DAILY))} after lunch."
    kinds = [("music",), ("sport",), ("music", "sport"), ()]
    docs = [(i, kinds[i % 4], " ".join([*[say(a) for a in kinds[i % 4] for _ in range(4)], say(""), say("")])) for i in range(400)]
    docs += [(1000, (), None), (1001, (), ""), (1002, (), "  ")]
    spark.createDataFrame([(i, t, "clash") for i, _, t in docs], "doc_id long, text string, area string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, a) for i, own, _ in docs[:120] for a in own or ("none",)]
    spark.createDataFrame(labels, "doc_id long, subject string").write.parquet(f"{tmp_path}/subject_labels.parquet")
    spark.createDataFrame([(a, "") for a in WORDS], "subject string, description string").write.parquet(f"{tmp_path}/subject_areas.parquet")
    got = {tuple(x) for x in p8_found(spark, str(tmp_path)).collect()}
    want = {(i, a) for i, own, _ in docs for a in own}
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.03 * len(want)


def test_samples_have_a_bound_and_are_the_same_in_every_run(spark):
    from quillspark.llm.subjects import _sample

    df = spark.range(10_000).withColumnRenamed("id", "doc_id")
    got = _sample(df, 1000, 10_000)
    assert 900 < got.count() < 1100 and got.exceptAll(_sample(df, 1000, 10_000)).count() == 0
    assert _sample(df, 10_000, 10_000).count() == 10_000


def test_leaf_terms_weigh_rare_words_little(spark):
    from quillspark.llm.subjects import leaf_terms

    rows = [(0, "", 100), (1, "", 100), (0, "violin", 90), (1, "violin", 10), (0, "rare", 1), (0, "the", 100), (1, "the", 100)]
    got = {r.term: r.gain for r in leaf_terms(spark.createDataFrame(rows, "leaf int, term string, n long")).where("leaf = 0").collect()}
    assert got["violin"] > 10 * got["rare"] and "" not in got and got.get("the", 0) < 0.2 * got["violin"]


def test_all_labelled_documents_weigh_terms(spark, monkeypatch):
    from quillspark.llm import subjects

    class Seen(Exception):
        pass

    def weights(counts, areas):
        raise Seen({r.term: r.n for r in counts.where("area = 'music'").collect()})

    monkeypatch.setattr(subjects, "_weights", weights)
    monkeypatch.setattr(subjects, "with_leaves", lambda docs: docs.withColumn("leaf", F.lit(0)))
    docs = spark.range(25_000).select(F.col("id").alias("doc_id"), F.lit("The violin again.").alias("text"))
    labels = docs.select("doc_id", F.explode(F.array(F.lit("music"), F.when(F.col("doc_id") < 1000, "sport"), F.lit("unknown"))).alias("subject"))
    try:
        subjects.document_subjects(docs, labels.union(labels), spark.createDataFrame([("music",), ("sport",)], "subject string"))
    except Seen as x:
        assert x.args[0]["violin"] == 24_500  # 1,000 documents have two areas, half of each counts
    else:
        raise AssertionError


def test_centres_are_fitted_on_all_documents(spark, monkeypatch):
    from quillspark.llm import subjects

    class Fit(subjects.BisectingKMeans):
        def fit(self, df):
            rows.append((df.count(), df.rdd.getNumPartitions()))
            return super().fit(df)

    rows = []
    monkeypatch.setattr(subjects, "BisectingKMeans", Fit)
    monkeypatch.setattr(subjects, "LEAVES", 2)
    monkeypatch.setattr(subjects, "FIT_PART", 2000, raising=False)
    words = F.array(F.when(F.col("id") % 2 == 0, "violin").otherwise("striker"), F.lit("lamp"))
    docs = spark.range(25_000).select(F.col("id").alias("doc_id"), F.array(words).alias("sents"))
    assert subjects.with_leaves(docs).groupBy("leaf").count().count() == 2
    assert rows == [(25_000, 13)]
