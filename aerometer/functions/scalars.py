"""Column-level helpers: safe casts, text defaults, bands, units and encodings."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerometer import constants as K


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: Column | str, type_: str, default=None) -> Column:
    """Cast, giving `default` (null unless set) for null or unparsable input."""
    out = as_col(c).try_cast(type_)
    return out if default is None else F.coalesce(out, F.lit(default).cast(type_))


def number_cast(c: Column | str, type_: str) -> Column:
    """safe_cast that also takes a whole number written as 1.0 or 1e3 for an integer type."""
    c = as_col(c)
    if type_ not in ("int", "bigint"):
        return safe_cast(c, type_)
    wide = c.try_cast("decimal(38,6)")
    return F.coalesce(c.try_cast(type_), F.when(wide == F.floor(wide), wide.try_cast(type_)))


def text_or(c: Column | str, default: str) -> Column:
    """Trimmed text; only null takes the default, an empty text stays empty."""
    return F.coalesce(F.trim(as_col(c)), F.lit(default))


def normalise_callsign(c: Column | str) -> Column:
    """Null or empty becomes UNKNOWN; anything else is trimmed, so an all-blank text ends empty."""
    c = as_col(c)
    return F.when(c.isNull() | (c == ""), F.lit("UNKNOWN")).otherwise(F.trim(c))


def operator_code(callsign: Column | str, n: int = 3, unknown: str = "Unknown") -> Column:
    c = as_col(callsign)
    known = (F.length(c) >= n) & (c != "UNKNOWN")
    return F.when(known, F.substring(c, 1, n)).otherwise(F.lit(unknown))


def bool_tag(c: Column | str) -> Column:
    return F.initcap(as_col(c).cast("string"))


def bool_num(c: Column | str) -> Column:
    return as_col(c).cast("double")


def in_air(on_ground: Column | str, null_on_ground: str = "air") -> Column:
    """Airborne flag. A null ground flag counts as 'air', as 'ground', or as neither ('drop')."""
    c = as_col(on_ground)
    if null_on_ground == "air":
        return ~F.coalesce(c, F.lit(False))
    if null_on_ground == "ground":
        return F.coalesce(~c, F.lit(False))
    if null_on_ground == "drop":
        return ~c
    raise ValueError(f"null_on_ground must be air, ground or drop, not {null_on_ground!r}")


def utc_text(ts: Column, fmt: str) -> Column:
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), fmt)


def epoch_iso(c: Column | str) -> Column:
    """Epoch seconds as ISO-8601 UTC text; zero or null means now."""
    ts = F.coalesce(F.timestamp_seconds(F.nullif(as_col(c), F.lit(0))), F.current_timestamp())
    return utc_text(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def zero_pad(c: Column | str, width: int = 6) -> Column:
    """Left-pad with zeros without cutting longer values."""
    text = as_col(c).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def pct(a: Column | str, b: Column | str, dp: int = 2) -> Column:
    """Percentage a of b; zero when b is zero or null."""
    share = F.try_divide(as_col(a) * F.lit(100.0), as_col(b).cast("double"))
    return F.coalesce(F.round(share, dp), F.lit(0.0))


def or_zero(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(0.0))


def metres_to_feet(c: Column | str) -> Column:
    return as_col(c) * F.lit(K.FEET_PER_METRE)


def ms_to_kmh(c: Column | str) -> Column:
    return as_col(c) * F.lit(K.KMH_PER_MS)


def metres_to_km(c: Column | str) -> Column:
    return as_col(c) / F.lit(1000.0)


def ms_to_knots(c: Column | str) -> Column:
    return as_col(c) * F.lit(K.KNOTS_PER_MS)


def band(c: Column | str, edges: Sequence[float], labels: Sequence[str],
         closed: str = "left") -> Column:
    """Step function: labels[i] for values below edges[i] ('left') or up to and including it
    ('right'); the last label beyond the last edge; null stays null."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    c = as_col(c)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        below = c < edge if closed == "left" else c <= edge
        out = out.when(below, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def climb_band(c: Column | str, limit: float = K.CLIMB_LIMIT,
               labels: Sequence[str] = tuple(K.CLIMB_LABELS)) -> Column:
    """Climbing above +limit, descending below -limit, level between (both ends level)."""
    c = as_col(c)
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(c > limit, F.lit(labels[0]))
            .when(c < -limit, F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))


def cyclical(c: Column | str, period: float) -> tuple[Column, Column]:
    """(sine, cosine) of a periodic number."""
    angle = as_col(c) * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def log_target(c: Column | str) -> Column:
    return F.log1p(as_col(c))


def unlog(c: Column | str) -> Column:
    return F.expm1(as_col(c))


def half_hour_slot(ts: Column | str) -> Column:
    """Slot 0..47 of the day."""
    ts = as_col(ts)
    return (F.hour(ts) * 2 + F.floor(F.minute(ts) / 30)).cast("int")


def season(month: Column | str) -> Column:
    """Meteorological season: 0 winter, 1 spring, 2 summer, 3 autumn."""
    return F.floor((as_col(month) % 12) / 3).cast("int")


def hash_percent(key: Column | str) -> Column:
    """A stable number 0..99 from the key's text."""
    digest = F.substring(F.md5(as_col(key).cast("string")), 1, 8)
    return (F.conv(digest, 16, 10).cast("bigint") % 100).cast("int")


def cycle_from_body(c: Column | str) -> Column:
    """The cycle number found in a JSON body, null when there is none."""
    found = F.regexp_extract(as_col(c), r'"cycle":\s*"?(\d+)"?', 1)
    return found.try_cast("int")
