"""Scalar expressions; all built-in, so they stay inside code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanledger import constants as C


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def interval_text(at: Column, origin: str = C.HASH_ORIGIN) -> Column:
    """Text of ``at - origin`` as days and time of day: ``45049 days 10:11:12.5``, ``1 day``, ``00:00:00``.

    Zero parts are left out, trailing zeros of the fraction too, and before the origin both parts carry a minus.
    """
    zero = ntz(origin)
    negative = at < zero
    mirrored = F.when(negative, zero + (zero - at)).otherwise(at)
    days = F.date_diff(mirrored.cast("date"), zero.cast("date"))
    clock = F.substring(mirrored.cast("string"), 12, 15)
    sign = F.when(negative, F.lit("-")).otherwise(F.lit(""))
    day_part = F.when(
        days != 0, F.concat(sign, days.cast("string"), F.when((days == 1) & ~negative, " day").otherwise(" days"))
    )
    clock_part = F.when((clock != "00:00:00") | (days == 0), F.concat(sign, clock))
    return F.when(at.isNotNull(), F.concat_ws(" ", day_part, clock_part))


def entity_hash(key: Column, created: Column) -> Column:
    """sha256 over key text and creation-time distance; NULL creation time counts as a fixed date."""
    text = F.concat(key.cast("string"), interval_text(F.coalesce(created, ntz(C.HASH_MISSING_CREATE))))
    return F.unhex(F.sha2(text, 256))


def code_score(code: Column, scores: Mapping[str, int]) -> Column:
    """Code to score; an unlisted code gives NULL."""
    score = None
    for value, points in scores.items():
        score = (F.when if score is None else score.when)(code == value, F.lit(points))
    return score


def contact_weight(no_duplicate: Column, trust: Column, quality: Column, source: Column, kind: Column, rank: Column):
    """Decimal digits by importance; the rank is added as is, so it may carry into the digits above."""
    return (
        no_duplicate.cast("long") * C.WEIGHT_NO_DUPLICATE
        + trust * C.WEIGHT_TRUST
        + quality * C.WEIGHT_QUALITY
        + source * C.WEIGHT_SOURCE
        + kind * C.WEIGHT_TYPE
        + rank
    )


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def iso_day_of_week(day: Column) -> Column:
    """Monday 1 .. Sunday 7."""
    return F.weekday(day) + 1


def row_digest(columns: Sequence[str]) -> Column:
    """md5 of the row text: a total, evenly spread tie-break."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]))
