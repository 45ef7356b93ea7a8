"""Column expressions. All stay JVM-side; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HIGH, MID, LOW = "고위험", "중위험", "저위험"  # fixed values: risk grades
HIGH_FROM, MID_FROM = 0.7, 0.4  # fixed values: grade thresholds


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- labels -----------------------------------------------------------------

def encode_label(c: Column | str, positive: str = "Yes") -> Column:
    """1 when equal to the positive label, else 0; NULL counts as 0."""
    return F.coalesce((_col(c) == positive).cast("int"), F.lit(0))


def encode_label_ci(c: Column | str, positive: str = "Yes") -> Column:
    """Like :func:`encode_label`, ignoring case and outer blanks."""
    return F.coalesce((F.lower(F.trim(_col(c))) == positive.strip().lower()).cast("int"),
                      F.lit(0))


def map_values(c: Column | str, mapping: Mapping) -> Column:
    """Literal-map lookup; a value outside the map becomes NULL."""
    expr = None
    for key, value in mapping.items():
        hit = _col(c) == key
        expr = F.when(hit, F.lit(value)) if expr is None else expr.when(hit, F.lit(value))
    return expr


def encode_label_map(c: Column | str) -> Column:
    return map_values(c, {"No": 0, "Yes": 1})


# ---- cleaning ---------------------------------------------------------------

def region_of(area: Column | str, width: int = 3) -> Column:
    """First characters of an area code; 'Unknown' when there is none."""
    return F.coalesce(F.substring(_col(area), 1, width), F.lit("Unknown"))


def unknown_flag(c: Column | str, marker: str = "Unknown") -> Column:
    return F.coalesce((_col(c) == marker).cast("int"), F.lit(0))


def lenient_double(c: Column | str) -> Column:
    """Number or NULL; text and NaN both become NULL."""
    return nan_to_null(_col(c).try_cast("double"))


def nan_to_null(c: Column | str) -> Column:
    return F.when(~F.isnan(_col(c)), _col(c))


def clip(c: Column | str, low: float, high: float) -> Column:
    """Limit to [low, high]; NULL stays NULL."""
    x = _col(c)
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def standardize(c: Column | str, mean: float, scale: float) -> Column:
    return (_col(c) - F.lit(mean)) / F.lit(scale)


def destandardize(c: Column | str, mean: float, scale: float) -> Column:
    return _col(c) * F.lit(scale) + F.lit(mean)


# ---- one-hot ----------------------------------------------------------------

def level_flag(c: Column | str, level: str) -> Column:
    return F.coalesce((_col(c) == level).cast("double"), F.lit(0.0))


def decode_levels(encoded: Sequence[str], default: str) -> Column:
    """Name of the first encoded column that holds 1, else ``default``."""
    hits = [F.when(F.col(f"`{name}`") == 1, F.lit(name)) for name in encoded]
    return F.coalesce(*hits, F.lit(default))


def level_text(encoded_name: Column | str) -> Column:
    """Level part of an encoded name, e.g. ``credit_3-Good`` -> ``3-Good``."""
    return F.split(_col(encoded_name), "_", 2)[1]


# ---- decisions --------------------------------------------------------------

def threshold_label(p: Column | str, threshold: float) -> Column:
    """1 when the unrounded probability reaches the threshold; NaN counts as 0."""
    x = nan_to_null(p)
    return F.when(_col(p).isNotNull(), F.coalesce((x >= threshold).cast("int"), F.lit(0)))


def risk_grade(p: Column | str) -> Column:
    """Left-closed grades: p >= 0.7 high, p >= 0.4 mid, else low (NaN is low)."""
    x = nan_to_null(p)
    return (F.when(_col(p).isNull(), F.lit(None).cast("string"))
            .when(x >= HIGH_FROM, HIGH).when(x >= MID_FROM, MID).otherwise(LOW))


def risk_band(p: Column | str) -> Column:
    """Right-closed bands [0, .4], (.4, .7], (.7, 1]; outside [0, 1] is NULL."""
    x = nan_to_null(p)
    return (F.when((x < 0) | (x > 1), F.lit(None).cast("string"))
            .when(x <= MID_FROM, LOW).when(x <= HIGH_FROM, MID).when(x <= 1, HIGH))


def round_half_even(c: Column | str, digits: int = 4) -> Column:
    """Half-even on the scaled double, as array libraries round.

    ``bround`` works on the decimal text instead and differs at some halves.
    """
    scale = F.lit(10.0 ** digits)
    return F.rint(_col(c) * scale) / scale


def hash_order(seed: int | str, key: Column | str) -> Column:
    """Seeded pseudo-random sort key; the same key always gets the same value."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string")))
