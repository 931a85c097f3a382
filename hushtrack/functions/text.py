"""Text forms and identifiers.

Identifiers are digests of text, so numbers must print the way the existing ids were made:
shortest round-trip decimals, ``0.0005`` rather than ``5.0E-4``, ``1e-05`` rather than ``1.0E-5``.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hushtrack.functions.time import MICROS_PER_SECOND, micros


# The expressions below take SQL text rather than Columns: each is one parsed expression, where
# composing it from functions would cost dozens of calls into the JVM per use.


def epoch_seconds_text(us: str) -> str:
    """``1704412120.0``, ``1704067207.179575``: seconds with the fraction's zeros trimmed."""
    fraction = f"rtrim('0', lpad(cast(abs({us}) % {MICROS_PER_SECOND} as string), 6, '0'))"
    return (
        f"concat(if({us} < 0, '-', ''), abs({us}) div {MICROS_PER_SECOND}, '.', "
        f"if({fraction} = '', '0', {fraction}))"
    )


def degrees_text(value: str) -> str:
    """Shortest decimal text of a coordinate; null and zero both print as ``0.0``."""
    plain = f"cast({value} as string)"
    mantissa = f"regexp_replace(substring_index({plain}, 'E', 1), '[.]0$', '')"
    exponent = f"lpad(substring_index({plain}, 'E-', -1), 2, '0')"
    return f"""case when {value} is null or {value} = 0.0d then '0.0'
        when abs({value}) >= 1e-3d then {plain}
        when abs({value}) >= 1e-4d
        then concat(if({value} < 0, '-', ''), '0.000', regexp_replace({mantissa}, '[-.]', ''))
        else concat({mantissa}, 'e-', {exponent}) end"""


def gap_id(ssvid: str, us: str, lat: str, lon: str) -> str:
    """Identifier of a gap: digest of the message that starts it."""
    return f"md5(concat_ws('|', {ssvid}, {epoch_seconds_text(us)}, {degrees_text(lat)}, {degrees_text(lon)}))"


def instant_text(ts: Column) -> Column:
    """``2024-01-01 00:00:07.179575+00``, fraction left out when zero; null prints ``NULL``."""
    us = micros(ts)
    fraction = F.pmod(us, F.lit(MICROS_PER_SECOND))
    text = F.concat(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
        F.when(fraction == 0, F.lit("")).otherwise(
            F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))
        ),
        F.lit("+00"),
    )
    return F.coalesce(text, F.lit("NULL"))


def event_id(vessel_id: Column, start: Column, end: Column) -> Column:
    """Identifier of a published gap event."""
    return F.md5(
        F.concat_ws("|", F.lit("gaps"), vessel_id, instant_text(start), instant_text(end))
    )


@F.pandas_udf(T.StringType())
def _composed(text: pd.Series) -> pd.Series:
    """Unicode normal form C, which Spark has no built-in for."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def port_id(iso3: Column, label: Column) -> Column:
    """Lower-case ``iso3-label`` without blanks, in Unicode normal form C."""
    # Text in ASCII is in normal form already; only other labels are worked on in Python.
    ascii_only = F.rlike(label, F.lit(r"^[\x00-\x7F]*$"))
    composed = F.when(ascii_only, label).otherwise(_composed(F.when(~ascii_only, label)))
    return F.lower(F.concat(iso3, F.lit("-"), F.regexp_replace(composed, " ", "")))


def grid_code(lon: Column, lat: Column) -> Column:
    """Signed fixed-width code of the 0.01 degree cell, e.g. ``lon:+012.30_lat:-004.00``."""

    def snap(value: Column) -> Column:
        # Hundredths; adding zero turns a negative zero into zero, which is the same cell.
        return F.round(value, 2) + F.lit(0.0)

    return F.format_string("lon:%+07.2f_lat:%+07.2f", snap(lon), snap(lat))


def json_string(parsed: Column, path: str) -> Column:
    """Text at a path of a parsed JSON value; null if there is something other than text."""
    found = F.try_variant_get(parsed, path, "variant")
    is_text = F.schema_of_variant(found) == "STRING"
    return F.when(is_text, F.try_variant_get(parsed, path, "string"))
