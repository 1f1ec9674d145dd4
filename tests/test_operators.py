import random

import pytest
from quillspark.operators import chunking, ingest, masking, threads
from quillspark.plans import reference_queries
from pyspark.sql import functions as F


def test_positions_and_carried_values_against_loops(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["hot"] * 5 + ["a", None]), r.choice([None, "x", "y"]), r.choice(["", "2020-01", "2021-05-06"])) for i in range(600)]
    df = spark.createDataFrame(rows, "i int, k string, v string, t string").withColumn("shift", F.lit("clash"))
    got = {x.i: x.position for x in threads.numbered(df, ["k"], F.substring("t", 1, 4), ["t", "i"]).collect()}
    for k in ("hot", "a", None):
        assert [got[x[0]] for x in sorted((x for x in rows if x[1] == k), key=lambda x: (x[3], x[0]))] == list(range(sum(x[1] == k for x in rows)))
    known = [x for x in rows if x[1] is not None]
    got = {x.i: x.s for x in threads.carried_forward(spark.createDataFrame(known, "i int, k string, v string, t string"), ["k"], F.floor(F.col("i") / 50), "i", "v", "none", "s").collect()}
    state = {}
    for i, k, v, _ in known:
        state[k] = v or state.get(k, "none")
        assert got[i] == state[k]


def test_speakers(spark):
    rows = [(1, "t", " Ann "), (2, "t", "Bob"), (3, "t", "Ann"), (4, "t", "Me"), (5, "t", None), (6, "t", ""), (7, None, "Bob"), (8, "u", "Bob")]
    df = spark.createDataFrame(rows, "i int, t string, s string")
    got = {r.i: r.speaker_tag for r in masking.with_speakers(df, "t", "s", ["i"], ["Me"]).collect()}
    assert got == {1: "[SPEAKER_1]", 2: "[SPEAKER_2]", 3: "[SPEAKER_1]", 4: "[AUTHOR_ME]", 5: None, 6: "[SPEAKER_3]", 7: "[SPEAKER_1]", 8: "[SPEAKER_1]"}


def test_speakers_of_several_columns(spark, tmp_path):
    me = next(iter(reference_queries.ME))
    rows = [(1, "t", "b@x.test", "a@x.test"), (2, "t", " a@x.test ", me), (3, "t", "c@x.test", None), (4, None, "", "c@x.test"), (5, "u", me, "a@x.test")]
    spark.createDataFrame(rows, "msg_no long, thread_id string, sender string, receiver string").withColumn("page_content", F.lit("a@x.test")).write.parquet(f"{tmp_path}/message_data.parquet")
    got = reference_queries.masked_messages(spark, str(tmp_path))
    assert got.columns == ["msg_no", "thread_id", "sender", "receiver", "page_content"]
    assert {r.msg_no: (r.sender, r.receiver) for r in got.collect()} == {1: ("[SPEAKER_1]", "[SPEAKER_2]"), 2: ("[SPEAKER_2]", "[AUTHOR_ME]"), 3: ("[SPEAKER_3]", None), 4: ("[SPEAKER_1]", "[SPEAKER_2]"), 5: ("[AUTHOR_ME]", "[SPEAKER_1]")}


def test_mail_times_of_the_whole_table(spark, tmp_path):
    rows = [(1, "Wed, 12 Mar 2014 10:00:00 +0800"), (2, "12 Mar 2014 10:00:00 EST"), (3, "Wed, 12 Mar 2014 10:00:00 +0000 (UTC)"), (4, "2014/3/12 10:00"), (5, None)]
    spark.createDataFrame(rows, "msg_no long, timestamp string").write.parquet(f"{tmp_path}/message_data.parquet")
    got = reference_queries.QUERIES["rfc2822_to_iso_all"](spark, str(tmp_path))
    assert {tuple(r) for r in got.collect()} == {(1, "2014-03-12T02:00:00Z"), (2, "2014-03-12T15:00:00Z"), (3, "2014-03-12T10:00:00Z"), (4, ""), (5, "")}


def test_masking_order_and_nesting(spark):
    one = lambda t: spark.createDataFrame([(t,)], "v string").select(masking.mask_text(F.col("v"), {"me@x.test": "[AUTHOR_ME]"}, {"a$b": "c\\1"})).first()[0]
    assert one("http://10.0.0.1/x me@x.test y@x.test a$b") == "[REDACTED_URL] [AUTHOR_ME] [REDACTED_EMAIL] c\\1"
    assert one("09123456781.1.1.1") == "[REDACTED_PHONE]1.1.1.1"
    assert one("A123456789 12345678 123456789") == "[REDACTED_ID] [REDACTED_ID] 123456789"
    assert one(None) is None and one("  ") == "  "
    df = spark.sql("select 12345678 as n, '12345678' as thread_id, 'x 12345678' as body, array(named_struct('c', '12345678', 'timestamp', '12345678')) as a, '12345678' as sender")
    r = masking.mask_columns(df).first()
    assert (r.n, r.thread_id, r.body, r.a[0].c, r.a[0].timestamp, r.sender) == (12345678, "12345678", "x [REDACTED_ID]", "[REDACTED_ID]", "12345678", "12345678")


def test_entities_by_a_given_recognizer(spark):
    def find(t):
        if "fail" in t:
            raise ValueError
        i = t.find("Ann")
        return [(i, i + 3, "PERSON")] if i >= 0 else []

    df = spark.createDataFrame([("hi Ann!",), ("fail Ann",), (None,), ("",)], "v string")
    assert [r[0] for r in df.select(masking.mask_entities(F.col("v"), find)).collect()] == ["hi [REDACTED_PERSON]!", "fail Ann", None, ""]
    assert [r[0] for r in df.select(masking.mask_entities(F.col("v"))).collect()] == ["hi Ann!", "fail Ann", None, ""]


def test_comments_meet_their_first_post(spark):
    r = random.Random(4)
    posts = [(i, i, "".join(r.choices("ab ", k=r.choice([0, 1, 3, 30])))) for i in range(30)] + [(30, 30, None)]
    comments = [(i, "".join(r.choices("ab ", k=r.randrange(40))), "t") for i in range(60)] + [(60, None, "t"), (61, "", "t")]
    p = spark.createDataFrame(posts, "post_id int, post_pos int, page_content string")
    c = spark.createDataFrame(comments, "comment_id int, target_title string, timestamp string")
    got = threads.match_comments(p, c)
    want = {i: next((k for k, _, t in posts if t and t[:20] in (title or "")), None) for i, title, _ in comments}
    assert {x.comment_id: x.post_id for x in got.collect()} == want
    assert threads.orphan_posts(c, got).count() == sum(v is None for v in want.values())


@pytest.mark.parametrize("seed", range(40))
def test_splitter(seed):
    r = random.Random(seed)
    # Numbered words, so that each chunk has one place in the text.
    text = "".join(f"{k}{'漢w'[k % 2] * r.randrange(1, 120 if k % 9 == 0 else 9)}" + r.choice([" ", "\n", "\n\n", "\n\n\n", ""]) for k in range(1000, 1000 + r.randrange(0, 90)))
    chunks = chunking.split_text(text, 80, 10)
    assert all(0 < len(c) <= 80 for c in chunks)
    assert all(c in text for c in chunks)
    at = 0
    for c in chunks:  # nothing but blanks lies between chunks, and they overlap by at most ten characters
        i = text.index(c, max(0, at - 10))
        assert text[at:i].strip() == "" or i <= at
        at = max(at, i + len(c))
    assert text[at:].strip() == ""


def test_short_text_is_one_chunk():
    for t in ("", "x", " a b \n\n c ", "z" * 800):
        assert chunking.split_text(t) == ([t.strip()] if t.strip() else [])
    assert max(map(len, chunking.split_text("z" * 801))) == 800


ROW = "file_name string, chunk_index int, content_hash string, raw_content string, information_weight double"


def test_diff_upsert_append(spark):
    old = spark.createDataFrame([("a", 0, "h0", "x", 0.5), ("a", 1, "h1", "x", 0.5), ("b", 0, None, "x", 0.5)], ROW)
    new = spark.createDataFrame([("a", 0, "h0", "n", 0.5), ("a", 1, "H1", "n", 0.5), ("b", 0, None, "n", 0.5), ("c", 0, "h", "n", 0.5), ("c", 0, "h", "n", 0.5)], ROW)
    diff = ingest.changed(new, old)
    assert sorted((r.file_name, r.chunk_index) for r in diff.collect()) == [("a", 1), ("c", 0), ("c", 0)]
    up = ingest.upserted(old, diff)
    assert sorted((r.file_name, r.chunk_index, r.content_hash) for r in up.collect() if r.content_hash) == [("a", 0, "h0"), ("a", 1, "H1"), ("c", 0, "h")]
    assert ingest.changed(new, up).count() == 0 and up.count() == 4
    assert ingest.appended(old, new.dropDuplicates(["file_name", "chunk_index"])).count() == 4
    good, dead = ingest.validated(spark.createDataFrame([("f" * 256, 0, "h", "x", 0.5), ("f", 0, "h", "x", 12.5), ("f", 1, "h", "x", None), (None, 0, "h", "x", 0.1)], ROW))
    assert [str(r.information_weight) for r in good.collect()] == ["0.50"] and dead.count() == 3


def test_retry_and_errors(spark):
    class Flaky:
        def analyze(self, texts):
            if any("bad" in t for t in texts):
                raise ValueError("no")
            return [{"is_noise": "noise" in t, "generated_tags": ["t"], "content_category": "c", "information_weight": 0.5} for t in texts]

    df = spark.createDataFrame([("good",), ("noise",), ("bad",)], "page_content string").repartition(3)
    out = ingest.judged(df, Flaky(), batch=1, wait=0)
    assert {r.page_content: (r.is_noise, r.error) for r in out.collect()} == {"good": (False, None), "noise": (True, None), "bad": (None, "no")}
    assert ingest.run_metrics(out).first().asDict() == {"total_read": 3, "noise_filtered": 1, "processing_errors": 1, "kept": 1}
    calls = []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise TimeoutError
        return [{}]

    assert ingest.with_retry(call, 1, 5, 0, 0) == [{}] and len(calls) == 3


def test_an_error_is_that_of_its_own_row(spark):
    class One:
        def analyze(self, texts):
            if "bad" in texts:
                raise ValueError("no")
            return [{"is_noise": False, "generated_tags": [], "content_category": "x", "information_weight": 0.5} for _ in texts]

    df = spark.createDataFrame([(i, "bad" if i == 7 else f"t{i}") for i in range(45)], "i long, page_content string").coalesce(1)
    for batch in (1, 20):
        out = {r.i: r.error for r in ingest.judged(df, One(), batch=batch, wait=0).collect()}
        assert len(out) == 45 and [i for i, e in out.items() if e] == [7]


def test_numbers_over_two_buckets(spark):
    from quillspark.operators.threads import numbered

    df = spark.createDataFrame([(k, t, n) for k in (None, "a") for n, t in enumerate(["", "", "2020", "2020-01-01", "2020-01-01 1", " x", "", "zz"] * 20)], "k string, t string, n long")
    out = numbered(df, ["k"], [F.substring("t", 1, 4), F.struct("t", F.floor(F.col("n") / 8))], ["t", "n"], "pos").collect()
    for k in (None, "a"):
        own = sorted((r for r in out if r.k == k), key=lambda r: (r.t, r.n))
        assert [r.pos for r in own] == list(range(160))


def test_dates_that_mail_readers_know(spark):
    from quillspark.functions import dates

    rows = [("Wed, 12 Mar 2014 10:00 +0800", "2014-03-12T02:00:00Z"), ("12 Mar 14 10:00:00 EST", "2014-03-12T15:00:00Z"), ("Wed, 12 Mar 2014 10:00:00 +0800 (CST)", "2014-03-12T02:00:00Z"), ("12 Mar 2014 10:00:00", "2014-03-12T10:00:00Z"), ("soon", ""), ("", ""), (None, ""), ("12 Mar 2014 99:99:99 +0800", None), ("9" * 5000, "")]
    out = spark.createDataFrame([(t,) for t, _ in rows], "t string").select(dates.rfc2822_to_iso(F.col("t")).alias("x")).collect()
    assert all(w is None or r.x == w for r, (_, w) in zip(out, rows, strict=True)), out
