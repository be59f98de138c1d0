"""Scalar building blocks; every one is a built-in Spark expression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhouse.functions.schemas import CHANGE_OPS, TRACE_ELEMENT

MICROS_PER_HOUR = 3_600_000_000


def event_time(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a timestamp; text that is no timestamp becomes NULL, not an error."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def whole_hours(start: Column, end: Column) -> Column:
    """Complete hours from ``start`` to ``end``, cut toward zero."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    return F.when(micros < 0, -F.floor(-micros / F.lit(MICROS_PER_HOUR))).otherwise(
        F.floor(micros / F.lit(MICROS_PER_HOUR))
    )


def is_error(status: Column) -> Column:
    """NULL status stays NULL."""
    return status >= 400


def response_label(status: Column) -> Column:
    return F.when(status < 400, F.lit("OK")).otherwise(F.lit("Error"))


# Fixed value: every character that counts as white space between words.
WHITE_SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]+"


def word_count(text: Column) -> Column:
    """Number of words between white space; leading and trailing space makes no word."""
    words = F.filter(F.split(text, WHITE_SPACE), lambda w: w != "")
    return F.size(words)


def estimate_tokens(text: Column) -> Column:
    """Ten tokens a word, fifty at least."""
    return F.greatest(F.lit(50), word_count(text) * 10)


def op_name(op: Column) -> Column:
    branches = [(op == code, name) for code, name in CHANGE_OPS.items()]
    return reduce(
        lambda built, branch: built.when(branch[0], branch[1]),
        branches[1:],
        F.when(branches[0][0], branches[0][1]),
    )


def trace_steps(trace: Column) -> Column:
    """The request trace as an array of steps; NULL where the text is no JSON array."""
    return F.from_json(trace, TRACE_ELEMENT)


def trace_length(trace: Column) -> Column:
    return F.coalesce(F.size(trace_steps(trace)), F.lit(0))


def mask_text(text: Column) -> Column:
    """Keep the shape of a text: capitals become X, all other letters and their marks x, digits n."""
    small = F.regexp_replace(text, r"[\p{L}\p{M}&&[^\p{Lu}\p{Lt}]]", "x")
    return F.regexp_replace(F.regexp_replace(small, r"[\p{Lu}\p{Lt}]", "X"), r"\p{N}", "n")


def mask_ip(ip: Column) -> Column:
    """Drop the host part of an address: an IPv4's last number, all but three groups of an IPv6.

    What is neither is masked as text.
    """
    prefix = F.regexp_extract(ip, r"^[0-9A-Fa-f]{1,4}(:[0-9A-Fa-f]{1,4}){0,2}(?=:)", 0)
    return (
        F.when(ip.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), F.regexp_replace(ip, r"\.[0-9]+$", ".0"))
        .when(ip.rlike(r"^[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*(%.*)?$"), F.concat(prefix, F.lit("::")))
        .otherwise(mask_text(ip))
    )


def pseudonym(text: Column, key: str) -> Column:
    """A keyed hash: without the caller's secret key, guesses at the text cannot be tried."""
    return F.sha2(F.concat(F.lit(key), F.sha2(F.concat(F.lit(key), text), 256)), 256)
