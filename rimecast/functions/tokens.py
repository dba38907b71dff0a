"""Text forms of steps, members, requests and output paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def step_token(step: Column) -> Column:
    """DDHH0000."""
    return F.concat(F.lpad(F.floor(step / 24).cast("string"), 2, "0"), F.lpad((step % 24).cast("string"), 2, "0"), F.lit("0000"))


def parse_step(text: Column) -> Column:
    """Hours from ``60m`` (whole hours only, else NULL), ``2h`` or a number, which is cut off."""
    minutes = F.regexp_extract(text, r"^\s*([+-]?\d+)m$", 1).try_cast("int")
    hours = F.regexp_extract(text, r"^\s*([+-]?\d+)h$", 1)
    return (
        F.when(text.endswith("m"), F.when(minutes % 60 == 0, F.floor(minutes / 60).cast("int")))
        .when(text.endswith("h"), hours.try_cast("int"))
        .otherwise(text.try_cast("double").try_cast("int"))
    )


def field_step(end_step: Column, step: Column) -> Column:
    """The step of a field: the end of its interval, or else its step, whichever can be read first."""
    return F.coalesce(parse_step(end_step), parse_step(step))


def member_kind(member: Column) -> Column:
    """cf for the control member, pf for others, NULL for what isn't three digits."""
    return F.when(member == "000", "cf").when(member.rlike(r"^\d{3}$"), "pf")


def member_number(member: Column) -> Column:
    return F.when(member_kind(member) == "pf", member.try_cast("int"))


def step_range(first: Column, last: Column, count: Column) -> Column:
    """``k`` or ``a/to/b/by/1``; NULL if the steps have gaps."""
    return F.when(count == 1, first.cast("string")).when(last - first + 1 == count, F.concat(first.cast("string"), F.lit("/to/"), last.cast("string"), F.lit("/by/1")))


def filter_expression(parts: dict[str, Column]) -> Column:
    """``k=v`` pairs, comma-joined; NULL values are left out."""
    return F.concat_ws(",", *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in parts.items()])


def output_path(root: str, model: Column, date: Column, time: Column, member: Column, step: Column) -> Column:
    return F.concat_ws("/", F.lit(root), model, date, time, member, F.concat(F.lit("lfff"), step_token(step), F.lit(".ptype.grib2")))
