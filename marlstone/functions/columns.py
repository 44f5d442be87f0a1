"""Small column functions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as browsers' scripts see it.
SPACE = r"(?U)[\s ﻿]"


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def origin(url: str | Column) -> Column:
    """Scheme, host and port, as they are written; empty where there are none."""
    return F.regexp_extract(url, r"^([A-Za-z]+://[^/?#]*)", 1)


def filled(c: Column) -> Column:
    """Neither null nor empty."""
    return c.isNotNull() & (c != "")


def not_blank(c: Column) -> Column:
    return c.isNotNull() & (F.regexp_replace(c, f"{SPACE}+", "") != "")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]+$", "")


def item_id(n: Column) -> Column:
    """fi- and the number, with four digits at least."""
    return F.format_string("fi-%04d", n.cast("long"))


def item_number(i: Column) -> Column:
    return F.regexp_extract(i, r"^fi-(\d{4,})$", 1).try_cast("bigint")


def batch_number(n: Column) -> Column:
    return F.format_string("%02d", n.cast("int"))


def percent(done: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(F.least(done, total) / total * 100)).otherwise(0).cast("int")


def least_share(goal: Column, share: float) -> Column:
    """A share of a goal as a whole number, half rounded up, 1 at least."""
    return F.greatest(F.lit(1), F.floor(F.round(goal * share, 9) + 0.5).cast("int"))


def share_cap(goal: Column, share: float, headroom: int = 1) -> Column:
    """A share of a goal, with headroom, rounded up, 1 at least."""
    return F.greatest(F.lit(1), F.ceil(F.round(goal * share * headroom, 9)).cast("int"))


def bar(n: Column, goal: int, width: int = 20) -> Column:
    full = F.least(F.lit(width), F.round(n / F.lit(goal) * width)).cast("int")
    return F.rpad(F.repeat(F.lit("#"), full), width, ".")


def today() -> Column:
    """The current day in UTC, as text."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd")


def svg_slice(html: Column) -> Column:
    """The inline graphic inside a control's markup."""
    return F.nullif(F.regexp_extract(html, "(?s)<svg.*</svg>", 0), F.lit(""))
