"""Opening hours as columns: durations, weekly total, night-only places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from poiloom.functions.text import stripped

DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
#: What stands for no hours; fixed values.
NO_HOURS = ("Not available", "", "nan", "00:00-00:00")
#: A whole number as Python's int() reads it, in ASCII digits.
WHOLE = r"^\s*[+-]?\d+(_\d+)*\s*$"


def _known(c: Column) -> Column:
    s = stripped(c)
    return F.when(~s.isin(*NO_HOURS), s)


def _clock(part: Column) -> Column:
    """hh:mm as hours; null if it isn't two whole numbers."""
    bits = F.split(part, ":", -1)
    h, m = F.get(bits, F.lit(0)), F.get(bits, F.lit(1))
    ok = (F.size(bits) == 2) & h.rlike(WHOLE) & m.rlike(WHOLE)

    def number(x: Column) -> Column:
        return F.replace(F.trim(F.regexp_replace(x, r"\s", "")), F.lit("_"), F.lit("")).try_cast("double")

    return F.when(ok, number(h) + number(m) / 60.0)


def _times(days: list[Column]) -> Column:
    """Of each day an opening and a closing hour, null where unknown; one expression for all days."""
    bits = F.transform(F.array(*days), lambda d: F.split(_known(d), "-", -1))
    return F.transform(
        bits,
        lambda b: F.when(F.size(b) == 2, F.struct(_clock(F.get(b, F.lit(0))).alias("start"), _clock(F.get(b, F.lit(1))).alias("end"))),
    )


def _lengths(days: list[Column]) -> Column:
    def length(t: Column) -> Column:
        return F.when(t["end"] < t["start"], 24.0 - t["start"] + t["end"]).otherwise(t["end"] - t["start"])

    return F.transform(F.transform(_times(days), length), lambda x: F.when(x > 0, x))


def opening(day: Column) -> Column:
    """Hour of opening; it needs no valid closing time."""
    return F.get(_times([day]), F.lit(0))["start"]


def duration(day: Column) -> Column:
    """Hours open on a day, over midnight if it closes earlier than it opens; null if unknown or not above 0."""
    return F.get(_lengths([day]), F.lit(0))


def weekly_hours(days: list[Column]) -> Column:
    """Sum of the known days from Monday on; null if none is known."""
    return F.aggregate(_lengths(days), F.lit(None).cast("double"), lambda total, x: F.when(x.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + x))


def night_only(days: list[Column], night_start: float) -> Column:
    """Whether no known opening is before night_start; null if none is known."""
    opens = F.filter(F.transform(_times(days), lambda t: t["start"]), lambda o: o.isNotNull())
    return F.when(F.size(opens) > 0, F.forall(opens, lambda o: o >= night_start))
