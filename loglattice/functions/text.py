"""Number and word formatting for written insights, and the check of numbers in written text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from loglattice import constants as C


def thousands(value: Column) -> Column:
    return F.format_string("%,d", value.cast("bigint"))


def short(value: Column, digits: int = 2) -> Column:
    """A rounded number without trailing zeros."""
    return F.regexp_replace(F.format_string(f"%.{digits}f", F.round(value.cast("double"), digits)), r"\.?0+$", "")


def seconds(value: Column) -> Column:
    return F.concat(F.format_string("%.3f", F.round(value, 3)), F.lit("s"))


def share(percent: Column) -> Column:
    """A percentage that never shows a real share as zero."""
    small = F.when((percent > 0) & (percent < 0.01), F.lit("<0.01%"))
    return F.coalesce(small, F.concat(short(percent), F.lit("%")))


def counted(n: Column, singular: str, plural: str | None = None) -> Column:
    """A number with its noun in the right form."""
    return F.concat(thousands(n), F.when(n == 1, F.lit(f" {singular}")).otherwise(F.lit(f" {plural or singular + 's'}")))


def listed(parts: Column) -> Column:
    """``a``, ``a and b`` or ``a, b and c``."""
    n = F.size(parts)
    head = F.array_join(F.slice(parts, F.lit(1), F.greatest(n - 1, F.lit(0))), ", ")
    return F.when(n > 1, F.concat(head, F.lit(" and "), F.element_at(parts, -1))).otherwise(F.array_join(parts, ""))


def number_texts(text: Column) -> Column:
    """Every number in a text, without thousands separators and final stops."""
    found = F.regexp_extract_all(text, F.lit(C.NUMBER), F.lit(0))
    return F.transform(found, lambda s: F.regexp_replace(F.rtrim(s, F.lit(".")), ",", ""))


def allowed_numbers(facts: Column) -> Column:
    """Numbers a text may contain, at two places: each fact as it is or cut to one or three places,
    and the small numbers that belong to the wording. Negative facts allow nothing."""
    real = F.filter(facts, lambda v: v.isNotNull() & (v >= 0))
    forms = F.flatten(
        F.transform(real, lambda v: F.array(F.round(v, 2), F.round(F.round(v, 1), 2), F.round(F.round(v, 3), 2)))
    )
    return F.concat(forms, F.array(*[F.lit(float(n)) for n in C.STRUCTURAL_NUMBERS]))


def is_grounded(text: Column, facts: Column, scope_key: Column | None = None) -> Column:
    """Whether every number in a text is among the facts.

    The scope key, such as a service name with digits, is taken out of the text first; leave it
    away to have its digits checked like any other number.
    """
    checked = F.coalesce(text, F.lit(""))
    if scope_key is not None:
        checked = F.replace(checked, scope_key, F.lit(""))
    numbers = F.transform(number_texts(checked), lambda s: F.round(s.try_cast("double"), 2))
    missing = F.array_except(F.filter(numbers, lambda n: n.isNotNull()), allowed_numbers(facts))
    return F.size(missing) == 0
