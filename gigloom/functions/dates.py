"""Posting dates. `as_of` is always a parameter, so re-run tasks give the same rows."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gigloom.functions.text import clean, col, collapse, let, strip

# shape check, Spark pattern; one- and two-digit days and months are both accepted
MDY = (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy")
DMY = (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy")
YMD = (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d")
YMD_SLASH = (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d")
DMY_DASH = (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy")
MON_D_Y = (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy")
MONTH_D_Y = (r"^[A-Za-z]{3,9} \d{1,2}, \d{4}$", "MMMM d, yyyy")
D_MON_Y = (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy")

ISO = (r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?"
       r"(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)?)?$")

MAX_DAYS = 700_000  # further back than year 1


def moment(as_of) -> Column:
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")


def in_formats(c, formats) -> Column:
    """First format that reads the text wins; null when none does."""
    return let(collapse(c), lambda t: F.coalesce(*[
        F.when(t.rlike(shape), F.try_to_timestamp(t, F.lit(pattern))) for shape, pattern in formats]))


def _back(as_of, days) -> Column:
    return F.when(days <= MAX_DAYS, as_of - F.make_dt_interval(F.least(days, F.lit(MAX_DAYS))))


def _number(text, pattern) -> Column:
    return F.regexp_extract(text, pattern, 1).try_cast("int")


def relative(c, as_of) -> Column:
    """'N days ago', 'yesterday', 'today' / 'just now'."""
    now, ago = moment(as_of), r"(\d+)\s+day[s]?\s+ago"
    return let(F.lower(F.coalesce(col(c), F.lit(""))), lambda t: (
        F.when(t.rlike(ago), _back(now, _number(t, ago)))
        .when(t.contains("yesterday"), _back(now, F.lit(1)))
        .when(t.contains("today") | t.contains("just now"), now)))


def relative_or_written(c, as_of) -> Column:
    """Relative text, else 'Jan 5, 2024', '5-1-2024', '5-Jan-2024'."""
    c = col(c)
    phrase = r"\d+\s+day[s]?\s+ago|yesterday|today|just now"
    return F.when(F.lower(c).rlike(phrase), relative(c, as_of)).otherwise(
        in_formats(c, [MON_D_Y, DMY_DASH, D_MON_Y]))


def month_first(c) -> Column:
    """US order first; a leading 'posted on' is dropped."""
    text = strip(F.regexp_replace(col(c), r"(?iU)posted\s*on", ""))
    return in_formats(text, [MDY, DMY, YMD, MON_D_Y, MONTH_D_Y, D_MON_Y])


def day_first(c) -> Column:
    return in_formats(clean(c), [MONTH_D_Y, MON_D_Y, YMD, DMY_DASH, DMY, MDY])


def iso_or_written(c) -> Column:
    """ISO-8601 with any offset (none means UTC), then numeric forms, day first."""
    def read(t):
        stamp = F.regexp_replace(t, ",", ".")
        stamp = F.regexp_replace(stamp, r"([T ]\d{2})(?=$|Z|[+-])", "$1:00")
        stamp = F.regexp_replace(stamp, r"(:\d{2}(?:\.\d+)?[+-]\d{2})(\d{2})$", "$1:$2")
        stamp = F.regexp_replace(stamp, r"(:\d{2}(?:\.\d+)?[+-]\d{2})$", "$1:00")
        return F.coalesce(F.when(t.rlike(ISO), stamp.try_cast("timestamp")),
                          F.when(t.rlike(r"^\d{8}$"), F.try_to_timestamp(t, F.lit("yyyyMMdd"))),
                          in_formats(t, [YMD, DMY, MDY, DMY_DASH]))

    return let(clean(c), read)


def relative_units(c, as_of, whole_days: bool = False) -> Column:
    """'about 3 weeks ago' in minutes, hours, days, weeks, months (30 d) or years (365 d)."""
    now = moment(as_of)
    units = [("minute", 0 if whole_days else 1 / 1440), ("hour", 0 if whole_days else 1 / 24),
             ("day", 1), ("week", 7), ("month", 30), ("year", 365)]

    def read(t):
        out = F.when(t.contains("today"), now).when(t.contains("yesterday"), _back(now, F.lit(1)))
        for word, days in units:
            pattern = rf"(\d+)\s*{word}"
            n = _number(t, pattern)
            if days == 0:
                value = now
            elif days < 1:
                most = F.lit(MAX_DAYS * (1440 if word == "minute" else 24))
                step = F.make_dt_interval(F.lit(0), F.lit(0), F.least(n, most)) if word == "minute" \
                    else F.make_dt_interval(F.lit(0), F.least(n, most))
                value = F.when(n <= most, now - step)
            else:
                value = _back(now, (n.cast("long") * days).try_cast("int"))
            out = out.when(t.rlike(pattern), value)
        return out

    text = F.regexp_replace(collapse(F.lower(F.coalesce(col(c), F.lit("")))), "posted|about|approx", "")
    stamp = let(text, read)
    return stamp.cast("date") if whole_days else stamp


def first_number_days(c, as_of) -> Column:
    """First integer is a number of days, whatever unit follows it."""
    today = moment(as_of).cast("date")
    return let(F.lower(F.coalesce(col(c), F.lit(""))), lambda t: (
        F.when(t.contains("yesterday"), F.date_sub(today, 1))
        .when(t.rlike(r"\d"), let(_number(t, r"(\d+)"), lambda n: F.when(
            n <= MAX_DAYS, F.date_sub(today, F.least(n, F.lit(MAX_DAYS))))))))


def leading_date(c) -> Column:
    """First ten characters as yyyy-MM-dd."""
    return in_formats(F.substring(col(c), 1, 10), [YMD]).cast("date")


def any_timestamp(c) -> Column:
    """Timestamp, or text in ISO, month-name or numeric form (day first), to UTC; unreadable text becomes null."""
    text = collapse(F.coalesce(col(c).cast("string"), F.lit("")))
    return F.coalesce(col(c).try_cast("timestamp"), in_formats(text, [MON_D_Y, MONTH_D_Y, D_MON_Y, DMY, DMY_DASH, YMD_SLASH]))


def day_text(c) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")
