"""Text clean-up, format checks and date helpers used by mapping specs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sediment.functions.registry import lookup, register

# Accepted formats.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_PATTERN = r"^\+?[1-9][0-9]{7,14}$"
ZIP_PATTERN = r"^[0-9]{5}(-[0-9]{4})?$"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


@register("trim")
def trim(c: Column) -> Column:
    return F.trim(c)


@register("upper")
def upper(c: Column) -> Column:
    return F.upper(c)


@register("lower")
def lower(c: Column) -> Column:
    return F.lower(c)


@register("standardize_names")
def standardize_names(c: Column) -> Column:
    return F.trim(F.upper(c))


@register("proper_case")
def proper_case(c: Column) -> Column:
    """First letter of each blank-separated word in upper case, the rest in lower case."""
    return F.initcap(c)


@register("remove_special_chars")
def remove_special_chars(c: Column) -> Column:
    """Keep letters and digits of any script, blanks, apostrophes and hyphens."""
    return F.regexp_replace(c, r"[^\p{L}\p{N} '-]", "")


@register("clean_phone")
@register("standardize_phone")
def clean_phone(c: Column) -> Column:
    """Digits, with a leading plus sign if there was one."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    return F.when(F.startswith(c, F.lit("+")), F.concat(F.lit("+"), digits)).otherwise(digits)


@register("clean_address")
def clean_address(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


@register("standardize_zip")
def standardize_zip(c: Column) -> Column:
    """``12345`` or ``12345-6789``; digits alone are split, short ones padded, others give NULL."""
    digits = F.regexp_replace(F.trim(c), "[^0-9]", "")
    size = F.length(digits)
    return (
        F.when(size == 9, F.concat_ws("-", F.substring(digits, 1, 5), F.substring(digits, 6, 4)))
        .when((size >= 3) & (size <= 5), F.lpad(digits, 5, "0"))
        .otherwise(F.lit(None).cast("string"))
    )


@register("concat")
def concat(*columns: Column, separator: str = " ") -> Column:
    return F.concat_ws(separator, *columns)


@register("current_date")
def current_date(as_of: Column | None = None) -> Column:
    return F.current_date() if as_of is None else as_of.cast("date")


@register("current_timestamp")
def current_timestamp(as_of: Column | None = None) -> Column:
    return F.current_timestamp() if as_of is None else as_of.cast("timestamp")


@register("epoch_seconds_between")
def epoch_seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end. Zone-less timestamps pass through ``timestamp`` first."""
    return end.cast("timestamp").cast("long") - start.cast("timestamp").cast("long")


def chain(c: Column, operations: Sequence[str]) -> Column:
    """Apply named transforms in list order."""
    for name in operations:
        c = lookup(name)(c)
    return c


def matches(c: Column, pattern: str) -> Column:
    return c.rlike(pattern)


def email_valid(c: Column) -> Column:
    return matches(c, EMAIL_PATTERN)


def email_domain(c: Column) -> Column:
    """Part after the first ``@`` in lower case; NULL where there is none."""
    return F.nullif(F.lower(F.split_part(c, F.lit("@"), F.lit(2))), F.lit(""))


def truncate(c: Column, max_length: int) -> Column:
    return F.substring(c, 1, max_length)


def parse_timestamp(c: Column, pattern: str = TIMESTAMP_FORMAT) -> Column:
    """NULL instead of an error for text that does not fit; the session zone must be the data's."""
    return F.try_to_timestamp(c, F.lit(pattern))


def out_of_bounds(c: Column, minimum: float | None, maximum: float | None) -> Column:
    """True where a present value lies outside the closed range."""
    outside = F.lit(False)
    if minimum is not None:
        outside = outside | (c < F.lit(minimum))
    if maximum is not None:
        outside = outside | (c > F.lit(maximum))
    return F.coalesce(outside, F.lit(False))
