"""Readable label of a Quartz schedule, as one column expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Quartz day numbers and names.
DAY_LABELS = {
    "1": "Sun", "2": "Mon", "3": "Tue", "4": "Wed", "5": "Thu", "6": "Fri", "7": "Sat",
    "MON": "Mon", "TUE": "Tue", "WED": "Wed", "THU": "Thu", "FRI": "Fri", "SAT": "Sat", "SUN": "Sun",
}


def _day_label(token: Column) -> Column:
    labels = F.create_map(*[F.lit(part) for pair in DAY_LABELS.items() for part in pair])
    return F.coalesce(F.try_element_at(labels, token), token)


def _clock(hours: Column, minutes: Column) -> Column:
    hour = F.when(hours.rlike("^[0-9]+$"), hours).try_cast("bigint")
    minute = F.when(minutes.rlike("^[0-9]+$"), minutes).try_cast("bigint")
    on_dial = F.when(hour % 12 == 0, F.lit(12)).otherwise(hour % 12)
    two_digits = F.when(minute < 10, F.concat(F.lit("0"), minute.cast("string"))).otherwise(minute.cast("string"))
    half = F.when(hour < 12, " AM").otherwise(" PM")
    twelve_hour = F.concat(on_dial.cast("string"), F.lit(":"), two_digits, half)
    return F.coalesce(twelve_hour, F.concat(hours, F.lit(":"), minutes))


def schedule_label(expression: Column) -> Column:
    fields = F.split(F.regexp_replace(expression, r"^\s+|\s+$", ""), r"\s+")
    day_of_month, day_of_week = F.get(fields, F.lit(3)), F.get(fields, F.lit(5))
    at = F.concat(F.lit(" at "), _clock(F.get(fields, F.lit(2)), F.get(fields, F.lit(1))))

    bounds = F.split(day_of_week, "-")
    day_range = F.concat(_day_label(F.get(bounds, F.lit(0))), F.lit("-"), _day_label(F.get(bounds, F.lit(1))))
    day_list = F.array_join(F.transform(F.split(day_of_week, ","), _day_label), ", ")
    wildcard = ("*", "?")
    return (
        F.when(F.coalesce(expression, F.lit("")) == "", "No schedule")
        .when(F.size(fields) < 6, expression)
        .when(day_of_week.isin(*wildcard) & day_of_month.isin(*wildcard), F.concat(F.lit("Daily"), at))
        .when(day_of_week.isin(*wildcard), F.concat(F.lit("Day "), day_of_month, F.lit(" of month"), at))
        .when(F.size(bounds) == 2, F.concat(day_range, at))
        .when(F.size(bounds) > 2, expression)
        .otherwise(F.concat(day_list, at))
    )
