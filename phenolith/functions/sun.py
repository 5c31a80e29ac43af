"""Length of the day from the public NOAA solar equations."""

from pyspark.sql import DataFrame

# Depression of the sun's centre at sunrise and at civil dawn, in degrees from zenith.
SUNRISE_ZENITH = 90.833
CIVIL_ZENITH = 96.0
FULL_DAY_SECONDS = 86400

# Each line may use the ones before it; Spark turns them into a chain of projections.
_SOLAR_TERMS = [
    "(unix_date({day}) + 2440587.5D - 2451545.0D) / 36525.0D as _t",
    "radians(greatest(least({lat}, 89.8D), -89.8D)) as _phi",
    "pmod(280.46646D + _t * (36000.76983D + 0.0003032D * _t), 360.0D) as _l0",
    "radians(357.52911D + _t * (35999.05029D - 0.0001537D * _t)) as _m",
    "0.016708634D - _t * (0.000042037D + 0.0000001267D * _t) as _e",
    "radians(125.04D - 1934.136D * _t) as _om",
    "21.448D - _t * (46.8150D + _t * (0.00059D - _t * 0.001813D)) as _sec",
    "sin(_m) * (1.914602D - _t * (0.004817D + 0.000014D * _t)) + sin(2 * _m) * (0.019993D - 0.000101D * _t)"
    " + sin(3 * _m) * 0.000289D as _ctr",
    "radians(23.0D + (26.0D + _sec / 60.0D) / 60.0D + 0.00256D * cos(_om)) as _eps",
    "radians(_l0) as _l2",
    "radians(_l0 + _ctr - 0.00569D - 0.00478D * sin(_om)) as _lam",
    "pow(tan(_eps / 2.0D), 2) as _y",
    "asin(sin(_eps) * sin(_lam)) as _dec",
    "4.0D * degrees(_y * sin(2 * _l2) - 2 * _e * sin(_m) + 4 * _e * _y * sin(_m) * cos(2 * _l2)"
    " - 0.5D * _y * _y * sin(4 * _l2) - 1.25D * _e * _e * sin(2 * _m)) as _eq",
    f"cos(radians({SUNRISE_ZENITH}D)) / (cos(_phi) * cos(_dec)) - tan(_phi) * tan(_dec) as _rise",
    f"cos(radians({CIVIL_ZENITH}D)) / (cos(_phi) * cos(_dec)) - tan(_phi) * tan(_dec) as _civil",
    "case when abs(_rise) <= 1 then degrees(acos(_rise)) end as _ha",
    "cast((720.0D + 4.0D * (-{lon} - _ha) - _eq) * 60.0D as bigint) as _sunrise",
    "cast((720.0D + 4.0D * (-{lon} + _ha) - _eq) * 60.0D as bigint) as _sunset",
]


def with_daylight(df: DataFrame, out: str = "daylight", lat: str = "lat", lon: str = "lon",
                  day: str = "day", civil_rule: bool = True) -> DataFrame:
    """Add whole seconds from sunrise to sunset.

    A place without civil dusk on that day counts as a full day (``civil_rule``); a place with civil
    dusk but without sunrise gives null.
    """
    length = f"pmod(_sunset - _sunrise, {FULL_DAY_SECONDS}L)"
    if civil_rule:
        length = f"case when abs(_civil) > 1 then {FULL_DAY_SECONDS}L else {length} end"
    terms = [t.format(lat=lat, lon=lon, day=day) for t in _SOLAR_TERMS]
    return df.selectExpr("*", *terms).selectExpr(*df.columns, f"{length} as {out}")
