"""Column functions on times. The session's time zone is UTC."""

from __future__ import annotations

import calendar
from datetime import datetime, timedelta
from email.utils import parsedate_tz

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ISO = "yyyy-MM-dd'T'HH:mm:ss"


def epoch_to_iso(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), ISO + "'Z'")


def meta_epoch_to_iso(value: Column) -> Column:
    """Seconds or, above 1e11, milliseconds to ISO with ``+00:00``; a fraction only if there is one; null, 0: ''."""
    v = value.try_cast("double")
    at = F.timestamp_micros(F.round(F.when(v > 1e11, v / 1000).otherwise(v) * 1_000_000).cast("long"))
    whole = F.unix_micros(at) % 1_000_000 == 0
    text = F.when(whole, F.date_format(at, ISO)).otherwise(F.date_format(at, ISO + ".SSSSSS"))
    return F.when(v.isNull() | (v == 0), "").otherwise(F.concat(text, F.lit("+00:00")))


def rfc2822_to_iso(text: Column) -> Column:
    """A mail's date to ISO with ``Z``: the usual shape by built-in expressions; seconds left out, two-digit years,
    obsolete zones and other habits that mail readers know by the standard library, in Arrow batches of those texts only.
    Without a zone it is UTC; what is no date gives ''."""
    usual = usual_rfc2822_to_iso(text)
    return F.when(usual != "", usual).otherwise(F.coalesce(_any_rfc2822(F.when((usual == "") & text.rlike("[0-9]"), text)), F.lit("")))


@F.pandas_udf(StringType())
def _any_rfc2822(s: pd.Series) -> pd.Series:
    def one(t: str | None) -> str | None:
        try:
            parsed = parsedate_tz(t) if t else None
            return (datetime(1970, 1, 1) + timedelta(seconds=calendar.timegm((*parsed[:6], 0, 1, 0)) - (parsed[9] or 0))).strftime("%Y-%m-%dT%H:%M:%SZ") if parsed else None
        except (ValueError, OverflowError, TypeError, IndexError):
            return None

    return s.map(one)


def usual_rfc2822_to_iso(text: Column) -> Column:
    """``Wed, 12 Mar 2014 10:00:00 +0800`` to ISO with ``Z``; anything else gives ''."""
    bare = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", "")
    bare = F.regexp_replace(bare, r"\s*\([^)]*\)$", "")
    bare = F.regexp_replace(bare, r"\s(?:GMT|UTC|UT|Z)$", " +0000")
    for zone, offset in (("EST", "-0500"), ("EDT", "-0400"), ("CST", "-0600"), ("CDT", "-0500"), ("MST", "-0700"), ("MDT", "-0600"), ("PST", "-0800"), ("PDT", "-0700")):
        bare = F.regexp_replace(bare, rf"\s{zone}$", f" {offset}")
    ok = bare.rlike(r"^\d{1,2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2} [+-]\d{4}$")
    return F.coalesce(F.date_format(F.try_to_timestamp(F.when(ok, bare), F.lit("d MMM yyyy HH:mm:ss Z")), ISO + "'Z'"), F.lit(""))


def parse_original_time_compat(text: Column) -> Column:
    """The first of three formats without a zone, as UTC; with a zone or otherwise null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in ("yyyy/M/d H:m:s", "yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s")])


def parse_original_time(text: Column) -> Column:
    """As `parse_original_time_compat`, and ISO with ``Z`` or an offset, so that no producer's time is lost."""
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})$"), text)
    return F.coalesce(parse_original_time_compat(text), F.try_to_timestamp(iso))
