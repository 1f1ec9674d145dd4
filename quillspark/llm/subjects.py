"""Problem 8: the subject areas of each document.

Normalised document vectors are clustered by bisecting k-means; the centres are fitted on all documents, and every
document is put into its leaf. Leaves are labelled by their discriminative terms, counted over all documents, with what
all hand-labelled documents say of these terms: each leaf has a mixture of areas. A document's own mixture of leaves, by their terms in its text, gives the areas that it may
treat, and the mixtures of the leaves a term stands in, beside the sample, what the term tells of its sentence. Of these
areas a document has those that at least two of its sentences deal with, or the only one of a short text.

The table of the documents' terms is partitioned by document once, together with the labels, so sentences and documents
are aggregated in place and no label is broadcast; counts of terms have partial sums. Term weights are broadcast only up to a measured size (`session.light`). What the
driver holds is the centres of ``LEAVES`` clusters of ``FEATURES`` numbers.

Defined results: null, empty and blank texts have no area. Copies are judged each on their own. Documents without
a label are treated like all others; without any labels no document has an area. Texts are processed whole.
"""

from __future__ import annotations

import math

from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut, light, table

LEAVES, FEATURES, ITERATIONS = 96, 1 << 12, 6
#: Documents of a partition while the centres are fitted: each partition has a sum of ``FEATURES`` numbers for each leaf.
FIT_PART = 250_000
#: Discriminative terms of each leaf.
TOP = 120
#: A text of at most so many sentences is short.
SHORT = 4
#: The share of a document's leaf mixture that an area must have.
LEAST_SHARE = 0.005
#: Weights are logs; a term of one area alone has the log of the number of areas. The share of that which a term must
#: reach (below, it tells only of languages and habits), and a sentence in the rounds and at the end.
LEAST_WEIGHT, IN_ROUNDS, AT_END = 0.417, 0.6255, 0.834
#: How much more a labelled document counts than one that only its leaf labels.
SAMPLE_WEIGHT = 10.0
#: Rounds in which the sentences' areas weigh the terms anew.
ROUNDS = 1


def terms(text: Column) -> Column:
    """Distinct lower-case words of three letters or more, and pairs of Chinese characters."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([a-zß-öø-ÿ]{3,}(?:-[a-zß-öø-ÿ]+)*)"), F.lit(1))
    runs = F.regexp_extract_all(text, F.lit("([一-鿿]{2,})"), F.lit(1))
    pairs = F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, F.lit(2)))))
    return F.array_distinct(F.concat(words, pairs))


def document_terms(docs: DataFrame) -> DataFrame:
    """doc_id, sents: the terms of each sentence that has some."""
    parts = F.split(F.regexp_replace("text", r"\r\n?", "\n"), r"(?<=[.!?…])\s+|(?<=[。！？])|\n\s*\n|\n(?=\p{Lu}|[一-鿿])")
    x = docs.where("text is not null").select("doc_id", F.filter(F.transform(parts, terms), lambda t: F.size(t) > 0).alias("sents"))
    return x.where("size(sents) > 0")


def _sample(df: DataFrame, most: int, n: int) -> DataFrame:
    """Some `most` of `n` documents, the same ones in every run; for trials, the queries take all documents."""
    return df if n <= most else df.where(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < most)


def with_labels(docs: DataFrame, labels: DataFrame, areas: list[str]) -> DataFrame:
    """`docs` (doc_id, sents), partitioned by doc_id, with `known`: the areas of a labelled document, null for others."""
    known = labels.where(F.col("subject").isin(areas)).groupBy("doc_id").agg(F.sort_array(F.collect_set("subject")).alias("known"))
    return docs.repartition("doc_id").join(known.hint("shuffle_hash"), "doc_id", "left")


def with_leaves(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, sents) with the leaf of each document."""
    tf = HashingTF(inputCol="own", outputCol="tf", numFeatures=FEATURES, binary=True).transform(docs.withColumn("own", F.flatten("sents")))
    idf = IDF(inputCol="tf", outputCol="idf", minDocFreq=3).fit(tf.select("tf"))
    vectors = Normalizer(inputCol="idf", outputCol="features").transform(idf.transform(tf))
    parts = max(8, docs.sparkSession.sparkContext.defaultParallelism, math.ceil(docs.count() / FIT_PART))
    fit = cut(vectors.select("features").repartition(parts))
    model = BisectingKMeans(k=LEAVES, maxIter=ITERATIONS, seed=7, minDivisibleClusterSize=0.001).fit(fit)
    return model.transform(vectors).select("doc_id", "sents", F.col("prediction").alias("leaf"))


def leaf_counts(leaves: DataFrame) -> DataFrame:
    """leaf, term, n: the documents of each leaf with each term; the term '' stands in all."""
    own = F.array_union(F.array(F.lit("")), F.flatten("sents"))
    return leaves.select("leaf", F.explode(own).alias("term")).groupBy("leaf", "term").agg(F.count("*").alias("n"))


def leaf_terms(counts: DataFrame, top: int = TOP) -> DataFrame:
    """leaf, term, gain: the most discriminative terms of each leaf; gain: the share of its documents that have the term
    times the log-odds of that share against all documents', so that rare words of a few documents don't count much."""
    size = counts.where("term = ''").select("leaf", F.col("n").alias("docs"))  # one row for each leaf
    total = size.agg(F.sum("docs").alias("total"))
    all_ = counts.groupBy("term").agg(F.sum("n").alias("n_all"))
    x = counts.where("term <> ''").join(all_, "term").join(F.broadcast(size), "leaf").join(F.broadcast(total))
    gain = F.log((F.col("n") + 0.5) / (F.col("docs") - F.col("n") + 0.5)) - F.log((F.col("n_all") + 0.5) / (F.col("total") - F.col("n_all") + 0.5))
    return x.withColumn("gain", F.col("n") / F.col("docs") * gain).where("gain > 0").withColumn("rank", F.row_number().over(Window.partitionBy("leaf").orderBy(F.desc("gain"), "term"))).where(F.col("rank") <= top).select("leaf", "term", "gain")


def _weights(counts: DataFrame, areas: list[str]) -> DataFrame:
    """term, w (array by area, the last for none): log of the term's share in an area against its usual share."""
    total = counts.groupBy("area").agg(F.sum("n").alias("n_area"))
    full = counts.join(F.broadcast(total), "area")  # one row for each area
    per = full.groupBy("term").agg(*[F.sum(F.when(F.col("area") == a, F.col("n") / F.col("n_area"))).alias(f"a{k}") for k, a in enumerate(areas)], F.sum("n").alias("n"))
    share = [F.coalesce(f"a{k}", F.lit(0.0)) for k in range(len(areas))]
    mean = sum(share[1:], share[0]) / len(areas)
    smooth = 0.02
    return per.where("n >= 3").select("term", F.array(*[F.log((s / mean) * (1 - smooth) + smooth) for s in share]).alias("w")).where(F.array_max("w") > LEAST_WEIGHT * math.log(len(areas)))


def leaf_mixtures(top: DataFrame, first: DataFrame, areas: list[str]) -> DataFrame:
    """leaf, area, p: what the discriminative terms of each leaf (`top`) say, by what the terms' weights (`first`) exceed
    the least one: words of a language or habit hardly do."""
    least = LEAST_WEIGHT * math.log(len(areas))
    scores = first.join(F.broadcast(top), "term").groupBy("leaf").agg(*[F.sum(F.greatest(F.col("w")[k] - least, F.lit(0.0)) * F.col("gain")).alias(f"s{k}") for k in range(len(areas))])  # LEAVES x TOP rows
    mixture = scores.select("leaf", F.explode(F.array(*[F.struct(F.lit(a).alias("area"), F.col(f"s{k}").alias("p")) for k, a in enumerate(areas)])).alias("m")).select("leaf", "m.area", "m.p")
    return mixture.withColumn("p", F.try_divide("p", F.sum("p").over(Window.partitionBy("leaf")))).where("p > 0.01")


def sentence_areas(docs: DataFrame, weights: DataFrame, areas: list[str], least: float) -> DataFrame:
    """doc_id, sent, of, area, share: the area of each sentence with terms of `weights` (term, w, v), by the sum of their
    weights w, none where nothing stands out; share: what these terms give to the document's leaf mixture, by area."""
    n = range(len(areas))
    x = docs.select("doc_id", F.size("sents").alias("of"), F.posexplode("sents").alias("sent", "terms")).select("doc_id", "of", "sent", F.explode("terms").alias("term"))
    x = x.join(weights, "term").groupBy("doc_id", "sent").agg(F.first("of").alias("of"), *[F.coalesce(F.sum(F.col("w")[k]), F.lit(0.0)).alias(f"s{k}") for k in n], *[F.coalesce(F.sum(F.col("v")[k]), F.lit(0.0)).alias(f"v{k}") for k in n])
    best = F.array_max(F.array(*[F.struct(F.col(f"s{k}").alias("s"), F.lit(a).alias("a")) for k, a in enumerate(areas)]))
    return x.withColumn("best", best).select("doc_id", "sent", "of", F.when(F.col("best.s") >= least * math.log(len(areas)), F.col("best.a")).otherwise(F.lit("none")).alias("area"), F.array(*[F.col(f"v{k}") for k in n]).alias("share"))


def document_subjects(docs: DataFrame, labels: DataFrame, subjects: DataFrame) -> DataFrame:
    """doc_id, subject, sentences, of, kinds, share: each area of each document's leaf mixture that sentences deal with."""
    areas = sorted(r["subject"] for r in subjects.select("subject").where("subject is not null").distinct().collect()) + ["none"]  # ten rows
    n = range(len(areas))
    docs = cut(with_labels(document_terms(docs.select("doc_id", "text")), labels, areas))
    counts = cut(leaf_counts(with_leaves(docs)))
    top = cut(leaf_terms(counts))
    in_doc = docs.where("known is not null").select("known", F.array_distinct(F.flatten("sents")).alias("own")).select(F.explode("known").alias("area"), (1 / F.size("known")).alias("part"), "own")
    in_doc = in_doc.select("area", "part", F.explode("own").alias("term"))
    direct = cut(in_doc.groupBy("area", "term").agg(F.sum("part").alias("n")))
    mixture = cut(leaf_mixtures(top, _weights(direct, areas), areas))
    # Leaves cover all documents, the sample is pure: both count, each term's sums scaled to the sample's weight.
    spread = cut(counts.where("term <> ''").join(F.broadcast(mixture), "leaf").groupBy("area", "term").agg(F.sum(F.col("n") * F.col("p")).alias("n")))  # LEAVES x areas rows
    both = direct.withColumn("n", F.col("n") * SAMPLE_WEIGHT).unionByName(spread).groupBy("area", "term").agg(F.sum("n").alias("n"))
    # What the leaves that a term stands in make of it: summed over a document's terms, the document's own leaf mixture.
    given = spread.groupBy("term").agg(F.sum("n").alias("n"), *[F.coalesce(F.sum(F.when(F.col("area") == a, F.col("n"))), F.lit(0.0)).alias(f"x{k}") for k, a in enumerate(areas)])
    given = cut(given.select("term", F.array(*[F.col(f"x{k}") / F.col("n") for k in n]).alias("v")))
    with_mixture = lambda w: light(cut(w.join(given, "term", "left")))
    weights = with_mixture(_weights(both, areas))
    for _ in range(ROUNDS):
        per = sentence_areas(docs, weights, areas, IN_ROUNDS).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("sent", "area"))).alias("is"))
        x = docs.join(per, "doc_id").select(F.posexplode("sents").alias("sent", "terms"), "is")
        x = x.select(F.try_element_at("is", "sent").alias("area"), "terms").where("area is not null").select("area", F.explode("terms").alias("term"))
        weights = with_mixture(_weights(cut(x.groupBy("area", "term").agg(F.count("*").alias("n"))), areas))
    x = sentence_areas(docs, weights, areas, AT_END).groupBy("doc_id").agg(F.first("of").alias("of"), *[F.count_if(F.col("area") == a).alias(f"n{k}") for k, a in enumerate(areas)], *[F.sum(F.col("share")[k]).alias(f"v{k}") for k in n])
    own = F.array(*[F.struct(F.lit(a).alias("subject"), F.col(f"n{k}").alias("sentences"), F.try_divide(F.col(f"v{k}"), sum([F.col(f"v{j}") for j in n], F.lit(0.0))).alias("share")) for k, a in enumerate(areas) if a != "none"])
    own = F.filter(own, lambda p: (p["sentences"] > 0) & (F.coalesce(p["share"], F.lit(0.0)) >= LEAST_SHARE))
    return x.select("doc_id", "of", own.alias("own")).select("doc_id", "of", F.size("own").alias("kinds"), F.inline("own"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The areas that each document treats."""
    x = document_subjects(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "subject_labels"), table(spark, sf_dir, "subject_areas"))
    return x.where((F.col("sentences") >= 2) | ((F.col("kinds") == 1) & (F.col("of") <= SHORT))).select("doc_id", "subject")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """subject, documents, share: the composition of the corpus by area."""
    n = table(spark, sf_dir, "documents").agg(F.count("*").alias("total"))
    x = p8_found(spark, sf_dir).groupBy("subject").agg(F.count("*").alias("documents"))
    return x.join(F.broadcast(n)).select("subject", "documents", (F.col("documents") / F.col("total")).alias("share"))


QUERIES = {"p8_found": p8_found, "p8_shares": p8_shares}
