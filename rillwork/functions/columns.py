"""Column expressions: missing values, units, snapping, text and small formulas. All run in the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Conversion factors of the source data.
FT_PER_M = 3.28084
IN_PER_M = 39.3701


def missing(c: Column, text: bool = False, zero: bool = False) -> Column:
    """NULL, NaN or blank; zero counts only where asked for."""
    if text:
        return c.isNull() | (F.trim(c) == "")
    x = c.isNull() | F.isnan(c)
    return x | (c == 0) if zero else x


def number(c: Column) -> Column:
    """Text to double, NULL where it isn't a finite number."""
    x = c.try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), None).otherwise(x)


def finite(c: Column) -> Column:
    """NaN and infinity to NULL."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def fill(c: Column, value, text: bool = False, zero: bool = False) -> Column:
    return F.when(missing(c, text, zero), F.lit(value)).otherwise(c)


def feet(metres: Column, digits: int = 2) -> Column:
    return F.round(metres * F.lit(FT_PER_M), digits)


def metres(feet_: Column, digits: int = 3) -> Column:
    return F.round(feet_ / F.lit(FT_PER_M), digits)


def lookup(c: Column, table: dict) -> Column:
    """A small fixed table as a map literal; NULL for other keys."""
    return F.create_map(*[F.lit(v) for kv in table.items() for v in kv])[c]


def snapped(c: Column, tol: float) -> Column:
    """Grid index of a coordinate, rounded half to even; an integer, so it joins safely."""
    return F.bround(c / F.lit(tol), 0).cast("bigint")


def kind_of(code: Column) -> Column:
    """The type prefix of a business key."""
    return F.substring_index(code, "_", 1)


def culvert_branch(code: Column) -> Column:
    """The branch a culvert belongs to: DU_n stands for C_n."""
    return F.when(F.startswith(code, F.lit("DU_")), F.concat(F.lit("C_"), F.substr(code, F.lit(4))))


def has_prefix(c: Column, prefixes: Iterable[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | F.startswith(c, F.lit(p))
    return out


def first_token(c: Column, sep: str) -> Column:
    """First part of a list in a string as a number."""
    return F.split(c, sep)[0].try_cast("double")


def sanitised(c: Column) -> Column:
    """A name of letters, digits and underscores."""
    return F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}]+", "_"), "^_+|_+$", "")


def local_date(c: Column, zone: str) -> Column:
    """Local day of an ISO time in UTC, or of a plain date; NULL where it is neither."""
    stamp = F.try_to_timestamp(F.regexp_replace(F.regexp_replace(c, "T", " "), "Z$", ""))
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}T.*Z$"), F.to_date(F.from_utc_timestamp(stamp, zone))).when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.to_date(stamp))


def nen_id(layer: str, code: Column) -> Column:
    return F.concat_ws(".", F.lit("NL"), F.lit("template"), F.lit(layer), code)


def is_guid(c: Column) -> Column:
    return c.rlike(r"^\{[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\}$")


def suffix_number(c: Column) -> Column:
    """Trailing number of a name, so sub10 sorts behind sub2."""
    return F.regexp_extract(c, r"(\d+)$", 1).try_cast("int")


# Formulas -------------------------------------------------------------------------------------------


def circle_segment_area(diameter: Column, fraction: Column) -> Column:
    r = diameter / 2
    h = fraction * diameter
    theta = 2 * F.acos((r - h) / r)
    return r * r * (theta - F.sin(theta)) / 2


def rectangle_area(width: Column, height: Column, fraction: Column) -> Column:
    return fraction * height * width


def trapezium_area(bottom: Column, slope: Column, bed: Column, top: Column, fraction: Column) -> Column:
    """Open trapezium filled to a fraction of its depth; a missing top is 2 above the bed."""
    b = F.coalesce(bed, F.lit(0.0))
    h = fraction * (F.coalesce(top, b + 2.0) - b)
    return h * (bottom + bottom + 2 * h * slope) / 2


def interpolated(up: Column, down: Column, at: Column, length: Column) -> Column:
    """Level at a distance along a straight slope."""
    return F.when(length > 0, up + (down - up) * at / length).otherwise(up)


def hyetograph(minute: Column, peak: float, duration: float) -> Column:
    """Triangular rain: rises to its peak at half the duration."""
    half = duration / 2
    return F.greatest(F.lit(0.0), F.lit(peak) * (1 - F.abs(minute - F.lit(half)) / F.lit(half)))


def line_width(level: Column) -> Column:
    return F.greatest(F.lit(0.25), F.lit(1.2) - F.lit(0.25) * level)


#: A published polynomial fit of the turbo colour map, lowest power first. The map itself is a
#: table of 256 colours; the fit follows it within about 0.05, and within 0.13 at its two ends.
_TURBO = {
    "r": (0.13572138, 4.61539260, -42.66032258, 132.13108234, -152.94239396, 59.28637943),
    "g": (0.09140261, 2.19418839, 4.84296658, -14.18503333, 4.27729857, 2.82956604),
    "b": (0.10667330, 12.64194608, -60.58204836, 110.36276771, -89.90310912, 27.34824973),
}


def rgb(fraction: Column) -> Column:
    """'R,G,B' of the turbo ramp over 0..1, by its polynomial; NULL for NULL and NaN."""

    def part(powers: tuple[float, ...]) -> Column:
        x = F.least(F.lit(1.0), F.greatest(F.lit(0.0), fraction))
        v = F.lit(powers[-1])
        for p in reversed(powers[:-1]):
            v = v * x + F.lit(p)
        return F.round(255 * F.least(F.lit(1.0), F.greatest(F.lit(0.0), v))).cast("int").cast("string")

    return F.when(fraction.isNotNull() & ~F.isnan(fraction), F.concat_ws(",", *[part(_TURBO[c]) for c in "rgb"]))


def distinct_rgb(k: Column, n: Column, saturation: float = 0.55, value: float = 0.95) -> Column:
    """'R,G,B' of the k-th of n evenly spread hues; parts are cut to whole numbers."""
    hue = k / F.greatest(n, F.lit(1)) % F.lit(1.0) * 6

    def part(shift: int) -> Column:
        # how far a part lies from its own hue decides how much of it is left
        away = (hue + F.lit(shift)) % F.lit(6.0)
        ramp = F.least(F.greatest(F.least(away, 4 - away), F.lit(0.0)), F.lit(1.0))
        return F.floor(255 * value * (1 - saturation * ramp) + F.lit(1e-9)).cast("int").cast("string")

    return F.concat_ws(",", part(5), part(3), part(1))


def guid() -> Column:
    """A new GUID in braces for each row; to be written once, as another run gives others."""
    return F.upper(F.concat(F.lit("{"), F.uuid(), F.lit("}")))


def interpolated_at(offsets: Column, values: Column, x: Column) -> Column:
    """Value of a profile (ascending offsets, values) at x, straight between its neighbours and constant beyond its ends; NULL beside a NULL or NaN."""
    pairs = F.arrays_zip(offsets.alias("o"), values.alias("v"))
    low = F.element_at(F.filter(pairs, lambda p: p["o"] <= x), -1)
    high = F.get(F.filter(pairs, lambda p: p["o"] >= x), F.lit(0))
    span = high["o"] - low["o"]
    between = F.when(span > 0, low["v"] + (high["v"] - low["v"]) * (x - low["o"]) / span).otherwise(low["v"])
    return finite(F.when(F.size(offsets) > 0, F.when(low.isNull(), F.element_at(values, 1)).when(high.isNull(), F.element_at(values, -1)).otherwise(between)))


def mean_of(values: Column) -> Column:
    """Mean of the finite values of an array; NULL if there are none."""
    ok = F.filter(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return F.when(F.size(ok) > 0, F.aggregate(ok, F.lit(0.0), lambda a, v: a + v) / F.size(ok))


#: Road classes narrower than a major road, and sizes in metres.
MINOR_ROADS = ("residential", "unclassified")
MINOR_WIDTH, MINOR_PAIRED_WIDTH, SHOULDER_OUT, SHOULDER_IN = 8.0, 4.0, 3.0, 1.2


def road_width(kind: Column, lanes: Column, one_way: Column, paired: Column, default_lanes: Column, lane: float = 3.6) -> Column:
    """Width of a road by its class, lanes, direction and whether it is one of a pair of carriageways."""
    n = F.coalesce(first_token(lanes, ";"), default_lanes)
    single = F.coalesce(F.lower(one_way).isin("yes", "true", "1", "-1"), F.lit(False))
    shoulders = F.when(kind.isin("motorway", "trunk"), F.when(single, SHOULDER_OUT + SHOULDER_IN).otherwise(2 * SHOULDER_OUT)).otherwise(0.0)
    return F.when(kind.isin(*MINOR_ROADS), F.when(F.coalesce(paired, F.lit(False)), MINOR_PAIRED_WIDTH).otherwise(MINOR_WIDTH)).otherwise(n * lane + shoulders)


def boundary_value(kind: Column, area: Column, velocity: float, coef: float, bed: Column, depth: Column) -> Column:
    """Discharge through an area, or the water level at bed plus depth."""
    return F.when(kind == "level", bed + depth).otherwise(F.lit(velocity * coef) * area)


def zw_text(bottom: Column, top_width: Column, bed: Column, top: Column) -> Column:
    """'levels|widths' of a two-level profile; a top below the bed is an error, a missing one 2 above it."""
    t = F.coalesce(top, bed + 2.0)
    text = F.concat(F.format_string("%.3f %.3f", bed, t), F.lit("|"), F.format_string("%.3f %.3f", bottom, top_width))
    return F.when(t < bed, F.raise_error(F.lit("profile top below its bed"))).otherwise(text)
