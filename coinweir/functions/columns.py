"""Column expressions. All are built-in functions, so they stay in generated code.

Times are zone-less (`timestamp_ntz`). Month arithmetic goes through `date`, which does
not depend on the session zone, instead of `date_trunc`, which does.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    """The feed writes "" where it means NULL."""
    return F.nullif(text, F.lit(""))


def wall_time(text: Column) -> Column:
    """ISO-8601 text as zone-less time in the text's own offset; raises on junk.

    The offset is dropped, not applied: raw folders are dated the same way, and staging
    partitions must stay in step with them.
    """
    return text.cast("timestamp_ntz")


def lit_time(moment: datetime | date | str | None) -> Column:
    """A zone-less time literal; None means the current UTC time, fixed once here."""
    if moment is None:
        moment = datetime.now(timezone.utc)
    if isinstance(moment, datetime) and moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(str(moment)).cast("timestamp_ntz")


def month_start(moment: Column) -> Column:
    return F.trunc(moment.cast("date"), "month").cast("timestamp_ntz")


def year_key(moment: Column) -> Column:
    """`2026`, always four digits; NULL for NULL."""
    return F.lpad(F.year(moment.cast("date")).cast("string"), 4, "0")


def month_key(moment: Column) -> Column:
    """`02`, always two digits; NULL for NULL."""
    return F.lpad(F.month(moment.cast("date")).cast("string"), 2, "0")


def month_text(moment: Column) -> Column:
    """`2026-02`; NULL for NULL."""
    return F.concat(year_key(moment), F.lit("-"), month_key(moment))


def partition_number(year: Column, month: Column) -> Column:
    """Partition keys as one comparable number, YYYYMM."""
    return year.cast("int") * 100 + month.cast("int")


def hours_crossed(earlier: Column, later: Column) -> Column:
    """Hour boundaries between two zone-less times (10:59 to 12:01 crosses two)."""
    days = F.datediff(later.cast("date"), earlier.cast("date")).cast("bigint")
    return days * 24 + F.hour(later) - F.hour(earlier)


def major_units(minor: Column) -> Column:
    """Minor units as a double. A decimal literal here would change the type."""
    return minor / F.lit(100.0)


def clock_micros(moment: Column) -> Column:
    """Microseconds since 1970 on the zone-less clock, whatever the session zone is."""
    days = F.datediff(moment.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = days * 86400 + F.hour(moment) * 3600 + F.minute(moment) * 60
    fraction = F.extract(F.lit("SECOND"), moment) * 1000000
    return seconds * 1000000 + fraction.cast("bigint")


def category_label(category: Column) -> Column:
    """`eating_out` as `Eating out`: only the first letter is raised."""
    words = F.replace(category, F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substring(words, 1, 1)), F.substr(words, F.lit(2)))


def iso_text(moment: Column) -> Column:
    """ISO-8601 text for presentation; microseconds appear only when there are any."""
    whole = F.replace(F.substring(moment.cast("string"), 1, 19), F.lit(" "), F.lit("T"))
    micros = F.rpad(F.substring(moment.cast("string"), 21, 6), 6, "0")
    return F.when(F.length(moment.cast("string")) > 19, F.concat(whole, F.lit("."), micros)).otherwise(whole)


RAW_SUFFIX = ".json"
#: What names of raw files end in: they may be compressed.
RAW_SUFFIXES = (RAW_SUFFIX, RAW_SUFFIX + ".gz")


def path_id(path: Column) -> Column:
    """Transaction id from a raw file's path, YYYY/MM/DD/<id>.json or .json.gz; empty for other files."""
    name = F.substring_index(path, "/", -1)
    found = F.when(F.lit(False), "")
    for suffix in RAW_SUFFIXES:
        found = found.when(name.endswith(suffix), F.substring(name, F.lit(1), F.length(name) - len(suffix)))
    return F.when(path.isNotNull(), found.otherwise(""))


def path_date(path: Column) -> Column:
    """Date from a raw file's path; NULL when the folders are not a date."""
    end = F.substring_index(path, "/", -4)
    dated = end.rlike(r"\A[^/]{4}/[^/]{2}/[^/]{2}/[^/]*(" + "|".join(map(re.escape, RAW_SUFFIXES)) + r")\z")
    return F.when(dated, F.translate(F.substring(end, 1, 10), "/", "-").try_cast("date"))


def path_month(path: Column) -> Column:
    """First day of the month a staging partition path names; NULL when it names none."""
    year = F.regexp_extract(path, r"transaction_year=(\d{4})", 1)
    month = F.regexp_extract(path, r"transaction_month=(\d{2})", 1)
    return F.concat_ws("-", year, month, F.lit("01")).try_cast("date")
