"""Great-circle distance, ellipsoidal geodesics and grid cells.

The longer formulas are SQL expressions: Spark reads them in one piece, and ``_let`` names intermediates in a
lambda variable, so that a result stays one small expression however often a plan refers to it.
"""

import itertools
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from phenolith.schema import EARTH_RADIUS_KM

# The WGS-84 ellipsoid, in km.
ELLIPSOID_MAJOR_KM = 6378.137
ELLIPSOID_MINOR_KM = 6356.7523142
ELLIPSOID_FLATTENING = 1 / 298.257223563


def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    return F.expr(f"""
        2.0D * {EARTH_RADIUS_KM!r}D * asin(sqrt(least(1.0D,
            pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)
            + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))))""")


# --- grid cells ----------------------------------------------------------------------------------


def cell_y(lat: str, size: float) -> Column:
    return F.expr(f"cast(floor({lat} / {float(size)!r}D) as int)")


def cell_x(lon: str, size: float) -> Column:
    return F.expr(f"cast(pmod(floor(({lon} + 180) / {float(size)!r}D), {round(360 / size)}) as int)")


def reachable_cells(lat: str, lon: str, radius_km: float, size: float) -> Column:
    """All grid cells that a circle touches, as array of structs ``(cell_y, cell_x)``.

    Longitudes wrap; a circle that holds a pole touches every column of its rows. ``size`` divides 360.
    """
    columns = round(360 / size)
    if abs(columns * size - 360) > 1e-9:
        raise ValueError("the cell size must divide 360 degrees")
    angle = radius_km / EARTH_RADIUS_KM
    # A hair wider than the circle, so that rounding never loses a cell on the rim.
    rows_half, size_text = f"{math.degrees(angle) + 1e-9!r}D", f"{float(size)!r}D"
    half = f"(degrees(asin(least(1.0D, {math.sin(angle)!r}D / cos(radians({lat}))))) + 1e-9D)"
    low = f"floor(({lon} + 180 - {half}) / {size_text})"
    high = f"floor(({lon} + 180 + {half}) / {size_text})"
    # One sequence with bounds by row: a constant one of all columns would be folded to an array of up to 368,640 numbers, which every plan and task would carry.
    whole = f"abs({lat}) + {rows_half} >= 90 or {high} - {low} >= {columns - 1}"
    xs = f"sequence(case when {whole} then 0L else {low} end, case when {whole} then {columns - 1}L else {high} end)"
    ys = f"sequence(floor(({lat} - {rows_half}) / {size_text}), floor(({lat} + {rows_half}) / {size_text}))"
    return F.expr(f"""
        flatten(transform({ys}, y -> transform({xs}, x ->
            named_struct('cell_y', cast(y as int), 'cell_x', cast(pmod(x, {columns}) as int)))))""")


# --- ellipsoid (Vincenty) ------------------------------------------------------------------------

_FLAT = f"{ELLIPSOID_FLATTENING!r}D"
_MINOR = f"{ELLIPSOID_MINOR_KM!r}D"
_RATIO = f"{(ELLIPSOID_MAJOR_KM ** 2 - ELLIPSOID_MINOR_KM ** 2) / ELLIPSOID_MINOR_KM ** 2!r}D"
_names = itertools.count()


def _let(values: dict[str, str], body) -> str:
    """SQL for ``body`` over named intermediates, each computed once."""
    name = f"v{next(_names)}"
    fields = ", ".join(f"'{n}', {v}" for n, v in values.items())
    return f"element_at(transform(array(named_struct({fields})), {name} -> {body(*[f'{name}.{n}' for n in values])}), 1)"


def _iterate(start: str, rounds: int, step) -> str:
    name = f"v{next(_names)}"
    return f"aggregate(sequence(1, {rounds}), {start}, ({name}, i{name}) -> {step(name)})"


def _series_a(q: str) -> str:
    return f"(1 + {q} / 16384 * (4096 + {q} * (-768 + {q} * (320 - 175 * {q}))))"


def _series_b(q: str) -> str:
    return f"({q} / 1024 * (256 + {q} * (-128 + {q} * (74 - 47 * {q}))))"


def _delta_sigma(b: str, ss: str, cs: str, c2m: str) -> str:
    return (
        f"({b} * {ss} * ({c2m} + {b} / 4 * ({cs} * (2 * {c2m} * {c2m} - 1) "
        f"- {b} / 6 * {c2m} * (4 * {ss} * {ss} - 3) * (4 * {c2m} * {c2m} - 3))))"
    )


def _lambda_gain(sa: str, sig: str, ss: str, cs: str, c2m: str, c2a: str) -> str:
    """Difference between the longitude on the auxiliary sphere and on the ellipsoid."""
    return _let(
        {"cc": f"{_FLAT} / 16 * {c2a} * (4 + {_FLAT} * (4 - 3 * {c2a}))"},
        lambda cc: f"(1 - {cc}) * {_FLAT} * {sa} * ({sig} + {cc} * {ss} * ({c2m} + {cc} * {cs} * (2 * {c2m} * {c2m} - 1)))")


def _sphere(su1: str, cu1: str, su2: str, cu2: str, lam: str, body) -> str:
    """Angle between two points of the auxiliary sphere at a longitude difference, and the azimuth terms."""
    def with_sides(sl, cl):
        return _let({
            "ss": f"sqrt(pow({cu2} * {sl}, 2) + pow({cu1} * {su2} - {su1} * {cu2} * {cl}, 2))",
            "cs": f"{su1} * {su2} + {cu1} * {cu2} * {cl}", "sl": sl}, with_angle)

    def with_angle(ss, cs, sl):
        return _let({
            "ss": ss, "cs": cs, "sig": f"atan2({ss}, {cs})",
            "sa": f"case when {ss} = 0 then 0.0D else try_divide({cu1} * {cu2} * {sl}, {ss}) end"}, with_azimuth)

    def with_azimuth(ss, cs, sig, sa):
        c2a = f"(1 - {sa} * {sa})"
        return _let({
            "ss": ss, "cs": cs, "sa": sa, "sig": sig, "c2a": c2a,
            "c2m": f"case when {c2a} = 0 then 0.0D else {cs} - try_divide(2 * {su1} * {su2}, {c2a}) end"}, body)

    return _let({"sl": f"sin({lam})", "cl": f"cos({lam})"}, with_sides)


def ellipsoid_distance(lat1: str, lon1: str, lat2: str, lon2: str, iterations: int = 8) -> Column:
    """Ellipsoidal distance in km (inverse problem) with a fixed number of iterations.

    Points at exactly opposite ends of the globe do not converge, as with any use of this method.
    """
    u1, u2 = (f"atan((1 - {_FLAT}) * tan(radians({x})))" for x in (lat1, lat2))

    def solve(su1, cu1, su2, cu2, width):
        lam = _iterate(width, iterations, lambda lam: _sphere(
            su1, cu1, su2, cu2, lam,
            lambda ss, cs, sa, sig, c2a, c2m: f"{width} + {_lambda_gain(sa, sig, ss, cs, c2m, c2a)}"))
        return _sphere(su1, cu1, su2, cu2, lam, length)

    def length(ss, cs, sa, sig, c2a, c2m):
        arc = _let({"q": f"{c2a} * {_RATIO}"}, lambda q: (
            f"{_MINOR} * {_series_a(q)} * ({sig} - {_delta_sigma(_series_b(q), ss, cs, c2m)})"))
        return f"case when {ss} = 0 then 0.0D else {arc} end"

    return F.expr(_let({
        "su1": f"sin({u1})", "cu1": f"cos({u1})", "su2": f"sin({u2})", "cu2": f"cos({u2})",
        "width": f"radians({lon2}) - radians({lon1})"}, solve))


def ellipsoid_destination(lat: str, lon: str, bearing: float, km: str, iterations: int = 8) -> Column:
    """Struct ``(lat, lon)`` of the point reached from a start, bearing and distance (direct problem)."""
    sin_b, cos_b = f"{math.sin(math.radians(bearing))!r}D", f"{math.cos(math.radians(bearing))!r}D"

    def from_start(tu, km, lon):
        cu = f"(1 / sqrt(1 + {tu} * {tu}))"
        return _let({"tu": tu, "cu": cu, "su": f"{tu} * {cu}", "sa": f"{cu} * {sin_b}", "km": km, "lon": lon}, with_start)

    def with_start(tu, cu, su, sa, km, lon):
        q = f"((1 - {sa} * {sa}) * {_RATIO})"
        return _let({
            "cu": cu, "su": su, "sa": sa, "lon": lon, "c2a": f"1 - {sa} * {sa}", "b": _series_b(q),
            "s1": f"atan2({tu}, {cos_b})", "base": f"{km} / ({_MINOR} * {_series_a(q)})"}, with_terms)

    def with_terms(cu, su, sa, lon, c2a, b, s1, base):
        def step(sig):
            terms = {"ss": f"sin({sig})", "cs": f"cos({sig})", "c2m": f"cos(2 * {s1} + {sig})"}
            return f"{base} + " + _let(terms, lambda ss, cs, c2m: _delta_sigma(b, ss, cs, c2m))

        def arrive(sig, ss, cs, c2m):
            side = f"({su} * {ss} - {cu} * {cs} * {cos_b})"
            lat2 = f"atan2({su} * {cs} + {cu} * {ss} * {cos_b}, (1 - {_FLAT}) * sqrt({sa} * {sa} + {side} * {side}))"
            lam = f"atan2({ss} * {sin_b}, {cu} * {cs} - {su} * {ss} * {cos_b})"
            east = f"{lon} + degrees({lam} - {_lambda_gain(sa, sig, ss, cs, c2m, c2a)})"
            return f"named_struct('lat', degrees({lat2}), 'lon', pmod({east} + 180, 360.0D) - 180)"

        sig = _iterate(base, iterations, step)
        return _let({"sig": sig}, lambda sig: _let({
            "sig": sig, "ss": f"sin({sig})", "cs": f"cos({sig})", "c2m": f"cos(2 * {s1} + {sig})"}, arrive))

    return F.expr(_let({"tu": f"(1 - {_FLAT}) * tan(radians({lat}))", "km": km, "lon": lon}, from_start))
