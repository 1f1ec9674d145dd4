import random
import re
import uuid

from quillspark.functions import dates, text
from pyspark.sql import functions as F

ODD = " \t\n\r\x1c\x85\xa0　  abcÄ漢>:"


def rows(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def got(df, col):
    return [r[0] for r in df.orderBy("i").select(col).collect()]


def texts(n=300):
    r = random.Random(3)
    return ["".join(r.choices(ODD, k=r.randrange(14))) for _ in range(n)]


def test_strip_and_clean_against_python(spark):
    values = texts()
    df = rows(spark, values)
    assert got(df, text.pystrip(F.col("v"))) == [v.strip() for v in values]
    assert got(df, text.clean_text(F.col("v"))) == [re.sub(r"[ \t]+", " ", re.sub(r"\n+", "\n", v)).strip() for v in values]


def test_subjects(spark):
    cases = [("Re: Fwd: 回覆：Plan", "Plan"), ("RE:re : x", "x"), ("AW: x", "AW: x"), ("Re:", "No Subject"), ("", "No Subject"), (None, "No Subject"), ("Report: a", "Report: a")]
    assert got(rows(spark, [c for c, _ in cases]), text.clean_subject(F.col("v"))) == [w for _, w in cases]


def test_bodies_against_a_loop(spark):
    r = random.Random(5)
    lines = ["On Monday Ann wrote:", "--- Original Message ---", "___", "From: A <a@b.test>", "> quoted", "Sent from my iPad", "從我的 iPhone 傳送", "text", "  more ", "", "", "On Monday", "__"]
    values = ["\n".join(r.choices(lines, weights=[1, 1, 1, 1, 3, 3, 3, 9, 9, 9, 9, 3, 3], k=r.randrange(1, 12))) for _ in range(300)]

    def model(v):
        out = []
        for s in (x.strip() for x in v.split("\n")):
            if re.search(r"^On\s+.+?wrote:$|^-{3,}\s*Original Message\s*-{3,}|^_{3,}$|^From:\s+.*<.+@.+>", s, re.I):
                break
            if not s.startswith(">") and not re.search(r"^Sent from my (iPhone|iPad|Android)|^從我的\s*(iPhone|iPad|Android)\s*傳送", s, re.I):
                out.append(s)
        return re.sub(r"\n{3,}", "\n\n", "\n".join(out).strip())

    assert got(rows(spark, values), text.clean_body(F.col("v"))) == [model(v) for v in values]


def test_latin1_uuid_and_paths(spark):
    bad = "價格ü".encode().decode("latin-1")
    df = rows(spark, [bad, "價格", "é", "plain", "", None])
    assert got(df, text.fix_latin1(F.col("v"))) == ["價格ü", "價格", "é", "plain", "", ""]
    names = ["a.txt-0", "檔-17", "", "x" * 1000]
    assert got(rows(spark, names), text.uuid5(F.col("v"))) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]
    df = rows(spark, ["a/b/C.TXT", "x.tar.gz", "none", ".hidden"])
    assert got(df, text.extension(F.col("v"))) == ["txt", "gz", "", ""] and got(df, text.stem(F.col("v"))) == ["C", "x.tar", "none", ".hidden"]
    df = rows(spark, ["x/facebook_data/messages/inbox/a.json", "instagram_data/post_comments.json", "threads_data/your_posts.json", "y/other.json"])
    assert got(df, text.meta_source(F.col("v"))) == ["facebook", "instagram", "threads", "unknown"]
    assert got(df, text.meta_route(F.col("v"))) == ["messages", "comments", "posts", None]


def test_times(spark):
    df = rows(spark, ["Wed, 12 Mar 2014 10:00:00 +0800", "12 Mar 2014 10:00:00 EST", "nonsense", "", None])
    assert got(df, dates.rfc2822_to_iso(F.col("v"))) == ["2014-03-12T02:00:00Z", "2014-03-12T15:00:00Z", "", "", ""]
    df = rows(spark, ["1500000000", "1500000000123", "1500000000.5", "0", "x", None])
    assert got(df, dates.meta_epoch_to_iso(F.col("v"))) == ["2017-07-14T02:40:00+00:00", "2017-07-14T02:40:00.123000+00:00", "2017-07-14T02:40:00.500000+00:00", "", "", ""]
    df = rows(spark, ["2024/1/2 3:4:5", "2024-01-02T03:04:05", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05+08:00", "2024/1/2", "x" * 9999])
    assert [str(x) for x in got(df, dates.parse_original_time_compat(F.col("v")).cast("string"))] == ["2024-01-02 03:04:05"] * 2 + ["None"] * 4
    assert [str(x) for x in got(df, dates.parse_original_time(F.col("v")).cast("string"))] == ["2024-01-02 03:04:05"] * 3 + ["2024-01-01 19:04:05"] + ["None"] * 2
