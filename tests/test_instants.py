import datetime as dt
import zoneinfo

from quillspark.operators.instants import normalise_instants, zone_intervals
from pyspark.sql import functions as F

ZONES = ["America/New_York", "Europe/Berlin", "Australia/Sydney", "Asia/Kolkata", "Asia/Taipei", "Australia/Lord_Howe"]


def ms(local: dt.datetime, zone: str) -> int:
    return int(local.replace(tzinfo=zoneinfo.ZoneInfo(zone)).timestamp() * 1000)


def test_local_times_against_the_standard_library(spark):
    rows = []
    for zone in ZONES:
        for year in (1971, 1999, 2012, 2024, 2099):
            day = dt.datetime(year, 1, 1)
            while day.year == year:  # every half hour near changes is met by stepping 7.5 h
                rows.append((zone, day.strftime("%Y-%m-%d %H:%M:%S"), ms(day, zone)))
                day += dt.timedelta(hours=7, minutes=30)
        for month, days in ((3, range(8, 32)), (4, range(1, 9)), (10, range(1, 32)), (11, range(1, 9))):
            for d in days:
                for h in range(4):
                    x = dt.datetime(2021, month, d, h, 15)
                    rows.append((zone, x.strftime("%d.%m.%Y, %H:%M Uhr"), ms(x, zone)))
    df = spark.createDataFrame(rows, "zone string, t string, want long").withColumn("o", F.lit("dmy"))
    out = normalise_instants(df, "t", "zone", "o")
    assert out.count() == len(rows)
    bad = out.where("not (epoch_ms <=> want)").collect()
    assert bad == []
    assert {r[0] for r in out.select("time_status").distinct().collect()} == {"direct", "ambiguous", "nonexistent"}


def test_formats_and_defined_results(spark):
    utc = lambda *a: int(dt.datetime(*a, tzinfo=dt.timezone.utc).timestamp() * 1000)
    cases = [
        ("2020-01-02T03:04:05Z", utc(2020, 1, 2, 3, 4, 5)),
        ("2020-01-02T03:04:05.123987+00:00", utc(2020, 1, 2, 3, 4, 5) + 123),
        ("2020-01-02 03:04:05,9+05:30", utc(2020, 1, 1, 21, 34, 5) + 900),
        ("20200102T030405+0530", utc(2020, 1, 1, 21, 34, 5)),
        ("2019-12-10T19:15:21+08:00[Asia/Taipei]", utc(2019, 12, 10, 11, 15, 21)),
        ("2019-12-10 19:15:21 Asia/Taipei", utc(2019, 12, 10, 11, 15, 21)),
        ("Wed, 22 Nov 2017 15:28:47 EST", utc(2017, 11, 22, 20, 28, 47)),
        ("Fri Oct 16 2015 15:05:20 GMT+0800", utc(2015, 10, 16, 7, 5, 20)),
        ("September 17, 2019 5:47:18 PM GMT+08:00", utc(2019, 9, 17, 9, 47, 18)),
        ("Jun 26, 2019 12:14:28 AM EDT", utc(2019, 6, 26, 4, 14, 28)),
        ("民國106年4月5日 15:55", utc(2017, 4, 5, 15, 55)),
        ("2024年8月4日 週日 上午12:23", utc(2024, 8, 4, 0, 23)),
        ("2021/01/10（日） 下午01:59", utc(2021, 1, 10, 13, 59)),
        ("[12/09/2017, 10:44:46 pm]", utc(2017, 9, 12, 22, 44, 46)),
        ("26/2/22, 7:01 AM", utc(2022, 2, 26, 7, 1)),
        ("1472932872", 1472932872000), ("1330562176.4439", 1330562176443), ("1463792329696", 1463792329696), ("1544423937240399", 1544423937240),
        ("2019-3-18 0:52:21", utc(2019, 3, 18, 0, 52, 21)),
        (None, None), ("", None), ("  ", None), ("-", None), ("0", None), ("N/A", None), ("yesterday", None), ("2013-11-15", None),
        ("2023-02-30 10:00:00", None), ("2021-13-05 08:00", None), ("12/13/2020, 10:00", None), ("2020-01-02 25:00:00", None), ("x" * 200_000, None),
    ]
    rows = [(i, t, "UTC", "dmy", w, "clash") for i, (t, w) in enumerate(cases * 2)]  # every row twice
    df = spark.createDataFrame(rows, "i int, t string, zone string, o string, want long, offset_s string")
    out = normalise_instants(df, "t", "zone", "o")
    assert [(r.t, r.epoch_ms, r.want) for r in out.where("not (epoch_ms <=> want)").collect()] == []
    assert out.count() == len(rows) and "offset_s" in out.columns


def test_empty_table_and_unknown_zone(spark):
    df = spark.createDataFrame([], "t string, zone string, o string")
    assert normalise_instants(df, "t", "zone", "o").count() == 0
    df = spark.createDataFrame([("2020-01-01 10:00:00", None, "dmy"), ("2020-01-01 10:00:00", "No/Where", None), ("2020-01-01T10:00:00+01:00", None, None)], "t string, zone string, o string")
    assert sorted(str(r.epoch_ms) for r in normalise_instants(df, "t", "zone", "o").collect()) == ["1577869200000", "None", "None"]


def test_intervals_do_not_overlap(spark):
    iv = zone_intervals(spark.createDataFrame([(z,) for z in ZONES], "zone string")).select("zone", "local_from", "local_to").distinct().collect()
    for z in ZONES:
        own = sorted((r.local_from, r.local_to) for r in iv if r.zone == z)
        assert all(a[1] == b[0] for a, b in zip(own, own[1:], strict=False)), z


def test_padded_texts_and_years_outside(spark):
    rows = [("2020-01-02" + " " * 150 + "03:04:05", "Europe/Berlin"), ("1923-05-01 12:00:00", "Europe/Berlin"), ("1850-05-01 12:00:00", "Europe/Berlin"), ("2150-05-01 12:00:00", "Europe/Berlin"), ("1850-05-01T12:00:00Z", None), ("x" * 5000, "Europe/Berlin")]
    out = normalise_instants(spark.createDataFrame(rows, "t string, zone string").withColumn("o", F.lit("dmy")), "t", "zone", "o").collect()
    utc = lambda *a: int(dt.datetime(*a, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert [(r.epoch_ms, r.time_status) for r in out] == [(utc(2020, 1, 2, 2, 4, 5), "direct"), (utc(1923, 5, 1, 11, 0, 0), "direct"), (None, "outside"), (None, "outside"), (utc(1850, 5, 1, 12, 0, 0), "instant"), (None, None)]
