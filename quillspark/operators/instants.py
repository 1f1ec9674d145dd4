"""Problem 2: time texts of many formats and zones to one instant in UTC.

A time text is first brought to the fields ``year|month|day|hour|minute|second|fraction|half|zone`` by one
regular expression per format, all of them built-in column expressions. A text with an offset is then an
instant by arithmetic. A text without one is local time in a zone, and is resolved by an as-of join to the
zone's offset intervals: the intervals are derived in Spark from the zone's offsets, cut where two of them
overlap on the local clock (an hour that occurs twice) or leave a gap (an hour that was skipped), and laid out
by zone and year, so that the join is an equi-join with a range test and gives one row for each row.

Defined results: null, empty and blank texts, placeholders, dates without a time of day, impossible dates and
zero give null, and so do runs of fewer than nine digits, which may be dates. A null or unknown zone gives null for local times only. Repeated rows are resolved each on
their own; columns of the input keep their names, and the names added are those passed by the caller.
"""

from __future__ import annotations

import calendar
import zoneinfo

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut

#: Offsets in minutes of zone abbreviations that name one offset.
ABBREVIATIONS = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "WET": 0,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
    "BST": 60, "WEST": 60, "CET": 60, "MEZ": 60, "CEST": 120, "MESZ": 120, "EET": 120, "EEST": 180,
    "JST": 540, "KST": 540, "AWST": 480, "AEST": 600, "AEDT": 660,
}
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
#: Years for which offsets are laid out; local times of other years give null, with the status ``outside``.
YEARS = (1900, 2100)

_ZONE = r"(Z|[A-Z]{2,5}(?:[+-]\d{1,2}:?\d{2})?|[+-]\d{2}:?\d{2}|[A-Za-z]+/[A-Za-z_+\-/0-9]+)?"
_CLOCK = r"(\d{1,2}):(\d{1,2})(?::(\d{1,2})(?:[.,](\d{1,9}))?)?"
_WEEKDAY = r"(?:(?:週|星期|周)[一二三四五六日天]|[(（](?:週|星期|周)?[一二三四五六日天][)）])?"
#: (regular expression, replacement by the nine fields); `a/b` in the fields of a slash date stays in its order.
FORMATS = [
    (rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})[T ]{_CLOCK} ?{_ZONE}(?:\[([A-Za-z_/+\-0-9]+)\])?$", "$1|$2|$3|$4|$5|$6|$7||$8|$9"),
    (r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})(Z|[+-]\d{2}:?\d{2})?$", "$1|$2|$3|$4|$5|$6|||$7|"),
    (rf"^(\d{{4}})/(\d{{1,2}})/(\d{{1,2}}) ?{_WEEKDAY} ?(上午|下午|[AaPp][Mm])? ?{_CLOCK} ?{_ZONE}$", "$1|$2|$3|$5|$6|$7|$8|$4|$9|"),
    (rf"^\[?(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}|\d{{2}}),? {_CLOCK} ?([AaPp][Mm])? ?{_ZONE}\]?$", "$3|$1/$2||$4|$5|$6|$7|$8|$9|"),
    (rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}|\d{{2}}),? (?:um )?{_CLOCK} ?(?:Uhr)? ?{_ZONE}$", "$3|$2|$1|$4|$5|$6|$7||$8|"),
    (rf"^(?:[A-Za-z]{{2,9}}, ?)?(\d{{1,2}}) ([A-Za-z]{{3,9}})\.? (\d{{4}}),? {_CLOCK} ?{_ZONE}(?: ?\([^)]*\))?$", "$3|$2|$1|$4|$5|$6|$7||$8|"),
    (rf"^[A-Za-z]{{3,9}} ([A-Za-z]{{3,9}}) (\d{{1,2}}) (\d{{4}}) {_CLOCK} ?{_ZONE}(?: ?\([^)]*\))?$", "$3|$1|$2|$4|$5|$6|$7||$8|"),
    (rf"^([A-Za-z]{{3,9}})\.? (\d{{1,2}}), (\d{{4}}),? {_CLOCK} ?([AaPp][Mm])? ?{_ZONE}$", "$3|$1|$2|$4|$5|$6|$7|$8|$9|"),
    (rf"^民國(\d{{1,3}})年(\d{{1,2}})月(\d{{1,2}})日 ?{_WEEKDAY} ?(上午|下午)? ?{_CLOCK}$", "R$1|$2|$3|$5|$6|$7|$8|$4||"),
    (rf"^(\d{{4}})年(\d{{1,2}})月(\d{{1,2}})日 ?{_WEEKDAY} ?(上午|下午)? ?{_CLOCK}$", "$1|$2|$3|$5|$6|$7|$8|$4||"),
]
_EPOCH = r"^\d{9,20}(?:\.\d{1,9})?$"


def _squeeze(text: Column) -> Column:
    """Unusual blanks to one space, edges cut."""
    return F.trim(F.regexp_replace(text, r"[\s  -​  　‎‏]+", " "))


def _offset_minutes(zone: Column) -> Column:
    """Minutes east of UTC of an abbreviation or offset; null for a region or anything unknown."""
    bare = F.regexp_replace(zone, r"^(?:GMT|UTC)(?=[+-])", "")
    names = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    digits = F.regexp_replace(bare, r"[^0-9]", "")
    hours = F.expr("0").cast("int") + F.substring(F.lpad(digits, 4, "0"), 1, 2).try_cast("int")
    minutes = F.substring(F.lpad(digits, 4, "0"), 3, 2).try_cast("int")
    sign = F.when(bare.startswith("-"), -1).otherwise(1)
    return F.when(bare.rlike(r"^[+-]\d{1,2}:?\d{2}$"), sign * (hours * 60 + minutes)).when(bare.rlike("^[A-Z]{1,5}$"), F.try_element_at(names, bare))


def zone_intervals(zones: DataFrame, zone_col: str = "zone", years: tuple[int, int] = YEARS) -> DataFrame:
    """Offset intervals of every zone in `zones`, on the local clock, by year.

    Columns: ``zone, bucket (year), local_from, local_to, offset_s, matches``, in seconds since 1970 on the
    local clock. ``matches`` is the number of offsets that give the local time: 1 plain, 2 ambiguous (offset_s is
    the first one's), 0 nonexistent (offset_s is the one before the change). Within a zone the pieces neither
    overlap nor leave gaps. Size: zones of the public time-zone database (some 600) times years times at most
    some 5 pieces, whatever the size of the data, so it may be broadcast.
    """
    known = sorted(zoneinfo.available_timezones())
    z = zones.select(F.col(zone_col).alias("zone")).where(F.col("zone").isin(known)).distinct()
    first, last = (f"{years[0]}-01-01", f"{years[1] + 1}-01-01")
    offset = lambda at: F.unix_seconds(F.from_utc_timestamp(at, F.col("zone"))) - F.unix_seconds(at)
    # Days on which the offset changes, then the hour, then the minute.
    changed = z.withColumn("at", F.expr(f"timestamp'{first} 00:00:00'"))
    for reach, step in ((f"timestamp'{last} 00:00:00'", "1 day"), ("at + interval 23 hour", "1 hour"), ("at + interval 59 minute", "1 minute")):
        probes = changed.select("zone", F.explode(F.expr(f"sequence(at, {reach}, interval {step})")).alias("at"))
        changed = probes.where(offset(F.col("at")) != offset(F.col("at") + F.expr(f"interval {step}")))
    changed = changed.select("zone", (F.col("at") + F.expr("interval 1 minute")).alias("at"))
    starts = changed.unionByName(z.select("zone", F.expr(f"timestamp'{first} 00:00:00'").alias("at")))
    w = Window.partitionBy("zone").orderBy("at")
    far = 1 << 60
    spans = starts.select("zone", F.unix_seconds("at").alias("start"), offset(F.col("at")).alias("off"), F.row_number().over(w).alias("n"), F.unix_seconds(F.lead("at").over(w)).alias("end"))
    # At each change the local clock jumps from `before` to `after`; between lies a gap or a doubled stretch.
    w = Window.partitionBy("zone").orderBy("start")
    spans = spans.select("zone", "off", "n", (F.col("start") + F.col("off")).alias("after"), (F.col("start") + F.lag("off").over(w)).alias("before"), (F.col("end") + F.col("off")).alias("end_before"), (F.col("end") + F.lead("off").over(w)).alias("end_after"), F.lag("off").over(w).alias("old"))
    plain = spans.select(
        "zone",
        F.when(F.col("n") == 1, -far).otherwise(F.greatest("after", "before")).alias("local_from"),
        F.when(F.col("end_before").isNull(), far).otherwise(F.least("end_before", "end_after")).alias("local_to"),
        F.col("off").alias("offset_s"), F.lit(1).alias("matches"),
    )
    jumps = spans.where(F.col("n") > 1).select(
        "zone", F.least("before", "after").alias("local_from"), F.greatest("before", "after").alias("local_to"),
        F.col("old").alias("offset_s"), F.when(F.col("after") > F.col("before"), 0).otherwise(2).alias("matches"),
    )
    pieces = plain.unionByName(jumps).where("local_from < local_to")
    begin, end = (calendar.timegm((y, 1, 1, 0, 0, 0)) for y in (years[0], years[1] + 1))
    year = lambda s: F.year(F.timestamp_seconds(F.greatest(F.lit(begin), F.least(s, F.lit(end - 1)))))
    return pieces.withColumn("bucket", F.explode(F.sequence(year(F.col("local_from")), year(F.col("local_to"))))).select("zone", "bucket", "local_from", "local_to", "offset_s", "matches")


def parse_time_text(text: Column, date_order: Column) -> Column:
    """struct<epoch_ms, local_s, millis, region>: epoch_ms of an instant that the text itself names, or the local
    time in seconds with its milliseconds, and the region if the text names one. All null: no time."""
    t = _squeeze(text)
    fields = F.lit(None).cast("string")
    for pattern, repl in reversed(FORMATS):
        fields = F.when(t.rlike(pattern), F.regexp_replace(t, pattern, repl)).otherwise(fields)
    return F.transform(F.array(F.struct(t.alias("t"), F.split(fields, r"\|").alias("f"))), lambda x: _resolve(x["t"], x["f"], date_order))[0]


def _resolve(t: Column, f: Column, date_order: Column) -> Column:
    num = lambda c: c.try_cast("int")
    slash = F.contains(f[1], F.lit("/"))
    a, b = F.split_part(f[1], F.lit("/"), F.lit(1)), F.split_part(f[1], F.lit("/"), F.lit(2))
    mdy = F.lower(date_order) == "mdy"
    dmy = F.lower(date_order) == "dmy"
    month_text = F.when(slash, F.when(mdy, a).when(dmy, b)).otherwise(f[1])
    name = F.lower(F.substring(f[1], 1, 3))
    names = F.array(*[F.lit(m) for m in MONTHS])
    month = F.when(f[1].rlike("^[A-Za-z]"), F.nullif(F.array_position(names, name).cast("int"), F.lit(0))).otherwise(num(month_text))
    day = num(F.when(slash, F.when(mdy, b).when(dmy, a)).otherwise(f[2]))
    year = F.when(f[0].startswith("R"), num(F.substring(f[0], 2, 9)) + 1911).when(F.length(f[0]) == 2, num(f[0]) + 2000).otherwise(num(f[0]))
    half = F.lower(f[7])
    h = num(f[3])
    pm, am = half.isin("pm", "下午"), half.isin("am", "上午")
    hour = F.when(pm & (h < 12), h + 12).when(am & (h == 12), 0).otherwise(h)
    second = F.coalesce(num(F.nullif(f[5], F.lit(""))), F.lit(0))
    ok = month.between(1, 12) & day.between(1, 31) & (hour <= 23) & num(f[4]).between(0, 59) & (second <= 59) & ~((pm | am) & (h == 0) & (h > 12))
    local = F.when(ok, F.unix_seconds(F.try_make_timestamp(year, month, day, hour, num(f[4]), second.cast("decimal(16,6)"), F.lit("UTC"))))
    millis = F.substring(F.rpad(F.coalesce(f[6], F.lit("")), 3, "0"), 1, 3).try_cast("int")
    zone = F.nullif(f[8], F.lit(""))
    region = F.when(F.contains(zone, F.lit("/")), zone).when(zone.isNull(), F.nullif(f[9], F.lit("")))
    minutes = _offset_minutes(zone)
    whole = F.split_part(t, F.lit("."), F.lit(1))
    frac = F.substring(F.rpad(F.split_part(t, F.lit("."), F.lit(2)), 3, "0"), 1, 3).try_cast("long")
    n = whole.try_cast("long")
    epoch = F.when(F.length(whole) <= 11, n * 1000 + frac).when(F.length(whole) <= 14, n).when(F.length(whole) <= 17, F.floor(n / 1000).cast("long")).otherwise(F.expr("null").cast("long"))
    epoch = F.when(F.length(whole) >= 18, F.floor(n.cast("decimal(20,0)") / 1000000).cast("long")).otherwise(epoch)
    unknown = zone.isNotNull() & minutes.isNull() & region.isNull()
    return F.struct(
        F.when(t.rlike(_EPOCH), F.when(n > 0, epoch)).when(minutes.isNotNull(), (local - minutes * 60) * 1000 + millis).alias("epoch_ms"),
        F.when(minutes.isNull() & ~unknown, local).alias("local_s"),
        millis.cast("long").alias("millis"),
        region.alias("region"),
    )


def _regions(df: DataFrame, text_col: str) -> DataFrame:
    """The zone names that stand in the texts."""
    named = F.col(text_col).rlike("[A-Za-z]/[A-Za-z]")
    return df.where(named).select(F.regexp_extract(text_col, r"([A-Za-z]+/[A-Za-z_+\-/0-9]+)", 1).alias("zone"))


def normalise_instants(df: DataFrame, text_col: str, zone_col: str, order_col: str, intervals: DataFrame | None = None, out: str = "epoch_ms", status: str = "time_status") -> DataFrame:
    """`df` with `out` (milliseconds since 1970 in UTC, or null) and `status`: ``instant`` (the text names the
    offset), ``direct``, ``ambiguous`` or ``nonexistent`` local time, or null.

    A local time before or after the years of `YEARS` gives null with the status ``outside``.

    `intervals` is the result of ``zone_intervals``; if absent it is derived from the zones that occur in
    `zone_col` and in the texts. Needs no shuffle of `df`: the intervals are bounded and broadcast.
    """
    p, key = "__parsed", "__zone"
    if intervals is None:
        in_text = _regions(df, text_col)
        intervals = zone_intervals(in_text.unionByName(df.select(F.col(zone_col).alias("zone"))).distinct())
    x = df.withColumn(p, parse_time_text(F.col(text_col), F.col(order_col)))
    x = x.withColumn(key, F.coalesce(F.col(f"{p}.region"), F.col(zone_col)))
    bucket = F.year(F.timestamp_seconds(F.col(f"{p}.local_s")))
    i = intervals.select(F.struct("*").alias("__iv"))
    on = (x[key] == F.col("__iv.zone")) & (bucket == F.col("__iv.bucket")) & (F.col(f"{p}.local_s") >= F.col("__iv.local_from")) & (F.col(f"{p}.local_s") < F.col("__iv.local_to"))
    x = x.join(F.broadcast(i), on, "left")
    local_ms = (F.col(f"{p}.local_s") - F.col("__iv.offset_s")) * 1000 + F.col(f"{p}.millis")
    x = x.withColumn(out, F.coalesce(F.col(f"{p}.epoch_ms"), local_ms))
    kind = F.when(F.col("__iv.matches") == 1, "direct").when(F.col("__iv.matches") == 2, "ambiguous").when(F.col("__iv.matches") == 0, "nonexistent")
    return x.withColumn(status, F.when(F.col(f"{p}.epoch_ms").isNotNull(), "instant").otherwise(F.coalesce(kind, F.when(~bucket.between(*YEARS), "outside")))).drop(p, key, "__iv")


#: (table, row key, time column) of the tables with time texts.
TIMED = [("message_data", "msg_no", "timestamp"), ("chat_messages", "chat_no", "timestamp"), ("meta_posts", "post_no", "timestamp"), ("writing_style_logs", "id", "original_time")]


def timed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tbl, row_id, time_text, export_batch of the four tables."""
    parts = [spark.read.parquet(f"{sf_dir}/{t}.parquet").select(F.lit(t).alias("tbl"), F.col(k).alias("row_id"), F.col(c).alias("time_text"), "export_batch") for t, k, c in TIMED]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instants of all time texts that are not already in the normal form."""
    batches = spark.read.parquet(f"{sf_dir}/export_batches.parquet").select("export_batch", "home_zone", "date_order")  # fixed table
    rows = timed_rows(spark, sf_dir).where(~F.col("time_text").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"))
    zones = _regions(rows, "time_text").distinct()
    intervals = cut(zone_intervals(zones.unionByName(batches.select(F.col("home_zone").alias("zone")))))
    rows = rows.join(F.broadcast(batches), "export_batch", "left")
    return normalise_instants(rows, "time_text", "home_zone", "date_order", intervals).where(F.col("epoch_ms").isNotNull()).select("tbl", "row_id", F.col("epoch_ms").cast("long").alias("epoch_ms"))


QUERIES = {"p2_found": p2_found}
