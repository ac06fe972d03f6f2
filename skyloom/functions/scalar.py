"""Unit conversion, wind, labels and name helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Zero Celsius in Kelvin, fixed value.
ZERO_CELSIUS_K = 273.15
# A template variable, a run that separates words, and the name of an empty title, fixed values.
VARIABLE_PATTERN = r"\$\{?(\w+)\}?"
SEPARATOR_PATTERN = "[^A-Za-z0-9]+"
EMPTY_SLUG = "panel"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nested_field(obj: Column | str, name: str) -> Column:
    """Sub-field of a nested object."""
    return _col(obj).getField(name)


def kelvin_to_celsius(kelvin: Column | str) -> Column:
    return _col(kelvin) - F.lit(ZERO_CELSIUS_K)


def temperature_label(kelvin: Column | str) -> Column:
    """Celsius first, Kelvin in brackets, two decimals each, half away from zero."""
    kelvin = _col(kelvin)

    def two_decimals(value: Column) -> Column:
        # The subtraction leaves noise near the 13th decimal that must not decide a half.
        return F.round(F.round(value, 6), 2)

    text = F.format_string("%.2f C (%.2f K)", two_decimals(kelvin_to_celsius(kelvin)), two_decimals(kelvin))
    return F.when(kelvin.isNotNull(), text)


def wind_speed(u: Column | str, v: Column | str) -> Column:
    u, v = _col(u), _col(v)
    return F.sqrt(u * u + v * v)


def wind_direction(u: Column | str, v: Column | str) -> Column:
    """Degrees in [0, 360) the wind blows from; null when calm."""
    u, v = _col(u), _col(v)
    return F.when((u != 0) | (v != 0), F.pmod(F.degrees(F.atan2(-u, -v)), F.lit(360.0)))


def normalize_query_text(text: Column | str) -> Column:
    """Line breaks to blanks, outer blanks removed."""
    return F.trim(F.regexp_replace(_col(text), "\n", " "))


def slugify(title: Column | str) -> Column:
    """Title to identifier: variables lose ``$`` and ``{}``, other runs become one ``_``."""
    bare = F.regexp_replace(_col(title), VARIABLE_PATTERN, "$1")
    words = F.regexp_replace(bare, SEPARATOR_PATTERN, "_")
    slug = F.lower(F.regexp_replace(words, "^_+|_+$", ""))
    return F.when(slug == "", EMPTY_SLUG).otherwise(slug)


def tail_position(percentile: Column | str) -> Column:
    """Horizontal position of a percentile on a tail axis: ``1 / (1 - p/100)``."""
    return F.lit(1.0) / (F.lit(1.0) - _col(percentile) / F.lit(100.0))


def tail_axis(percentile: Column | str) -> Column:
    return F.log10(tail_position(percentile))
