"""Scalar columns: dates, seasons, group keys, categories, ids."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from phenolith.schema import (
    EQUALITY_KEY_SEPARATOR,
    MINIMUM_YEAR,
    RANDOM_CATEGORY,
    RECORD_SUFFIX,
    SOURCE_KEY_SEPARATOR,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- dates ---------------------------------------------------------------------------------------


def parse_date(text="date_string") -> Column:
    """``YYYYMMDD`` to date, null when the text is no date."""
    return F.try_to_date(_col(text), "yyyyMMdd")


def date_key(day="obs_date") -> Column:
    """``YYYYMMDD`` of a date, null before the first supported year."""
    day = _col(day)
    return F.when(F.year(day) >= MINIMUM_YEAR, F.date_format(day, "yyyyMMdd"))


def month_name(day="obs_date") -> Column:
    return F.date_format(_col(day), "MMMM")


def season(day="obs_date") -> Column:
    """1 spring (Mar-May), 2 summer, 3 autumn, 4 winter (Dec-Feb)."""
    month = F.month(_col(day))
    return F.when(month.between(3, 11), F.floor(month / 3).cast("int")).otherwise(F.lit(4))


def season_of_month(month) -> Column:
    """Season of a month number; a number outside 1..12 is an error."""
    month = _col(month)
    return F.when(
        month.between(1, 12),
        F.when(month.between(3, 11), F.floor(month / 3).cast("int")).otherwise(F.lit(4)),
    ).otherwise(F.raise_error(F.lit("month should be between 1 and 12")).cast("int"))


def reading_date(year="year", month="mo", day="da") -> Column:
    """Date of a station reading kept as three text columns."""
    return F.make_date(_col(year).cast("int"), _col(month).cast("int"), _col(day).cast("int"))


# --- tokens and keys -----------------------------------------------------------------------------


def s2_token(level: int, tokens="s2_tokens") -> Column:
    """Token of one level; null when the array is short or the entry is empty."""
    token = F.try_element_at(_col(tokens), F.lit(level + 1))
    return F.when(token != "", token)


def season_region_key(day="obs_date", tokens="s2_tokens", level: int = 2) -> Column:
    """``year-season-token``; December and January of one calendar year share a key."""
    return F.concat_ws("-", F.year(_col(day)), season(day), s2_token(level, tokens))


def month_region_key(day="obs_date", tokens="s2_tokens", level: int = 2) -> Column:
    return F.concat_ws("-", F.date_format(_col(day), "yyyy-MM"), s2_token(level, tokens))


def equality_key(category="category", latitude="latitude", longitude="longitude", day="obs_date") -> Column:
    """Category, position to four decimals and date."""
    return F.concat_ws(
        EQUALITY_KEY_SEPARATOR,
        _col(category),
        F.format_string("%.4f", _col(latitude)),
        F.format_string("%.4f", _col(longitude)),
        F.date_format(_col(day), "yyyyMMdd"),
    )


def station_key(lat="lat", lon="lon") -> Column:
    """Stations at one position (six decimals) are one station; null for an empty position."""
    lat, lon = _col(lat), _col(lon)
    return F.when((lat != 0) & (lon != 0), F.format_string("%.6f|%.6f", lat, lon))


def source_key(usage, source_type, target_id) -> Column:
    return F.concat_ws(SOURCE_KEY_SEPARATOR, _col(usage), _col(source_type), _col(target_id))


def source_key_parts(key="source_key") -> Column:
    parts = F.split(_col(key), "-\\|-")
    return F.struct(
        F.try_element_at(parts, F.lit(1)).alias("usage_id"),
        F.try_element_at(parts, F.lit(2)).alias("source_type"),
        F.try_element_at(parts, F.lit(3)).alias("target_id"),
    )


def eco_region(realm="eco_realm", biome="eco_biome", num="eco_num") -> Column:
    return F.struct(*[_col(c).cast("string").alias(n) for c, n in
                      ((realm, "realm"), (biome, "biome"), (num, "num"))])


def coordinates(latitude="latitude", longitude="longitude") -> Column:
    return F.struct(_col(latitude).alias("latitude"), _col(longitude).alias("longitude"))


def split_list(text, trim: bool = False) -> Column:
    """``a,b,c`` to an array. Blanks around a value stay unless ``trim`` is set."""
    parts = F.split(_col(text), ",")
    return F.transform(parts, lambda part: F.trim(part)) if trim else parts


# --- categories ----------------------------------------------------------------------------------


def category_kind(category="category") -> Column:
    """``random`` and ``protected_area`` by containment in any case, else ``occurrence``."""
    lowered = F.lower(_col(category))
    return (
        F.when(lowered.contains("random"), "random")
        .when(lowered.contains("protected_area"), "protected_area")
        .otherwise("occurrence")
    )


def valid_category(category="category") -> Column:
    """Non-empty, no slash, no blank; the two special kinds need a dash."""
    c = _col(category)
    plain = c.isNotNull() & (c != "") & ~c.contains("/") & ~c.contains(" ")
    return F.coalesce(plain & ((category_kind(c) == "occurrence") | c.contains("-")), F.lit(False))


def category_id(category="category") -> Column:
    """Second dash-separated part for random and protected-area categories, else null."""
    c = _col(category)
    return F.when(category_kind(c) != "occurrence", F.try_element_at(F.split(c, "-"), F.lit(2)))


def category_path(category, version, suffix: str = RECORD_SUFFIX) -> Column:
    """Relative output path of a category and version; null when a needed id is empty."""
    c, v = _col(category), _col(version)
    kind, part = category_kind(c), F.nullif(category_id(c), F.lit(""))
    end = F.lit(suffix)
    return (
        F.when(kind == "random", F.concat(F.lit("random/"), v, F.lit("/"), part, end))
        .when(kind == "protected_area", F.concat(F.lit("protected_areas/"), part, F.lit("/"), v, end))
        .otherwise(F.concat(F.lit("occurrences/"), c, F.lit("/"), v, end))
    )


def random_batch_id(category="category", example_id="example_id") -> Column:
    """0 unless the category is a random one; else the number in the id, null when it is unusable."""
    part = F.try_element_at(F.split(_col(example_id), "-"), F.lit(2))
    number = F.when((part != "") & (part != "0"), part.try_cast("int"))
    return F.when(F.lower(_col(category)).contains("random"), number).otherwise(F.lit(0))


def routing_category(category="category", example_id="example_id") -> Column:
    """``random-<batch>`` for random points, else the category itself."""
    batch = random_batch_id(category, example_id)
    return F.when(batch == 0, _col(category)).otherwise(F.concat(F.lit("random-"), batch.cast("string")))


def label_presence(category="category") -> Column:
    """True for anything but the exact random category."""
    return _col(category) != RANDOM_CATEGORY


def is_presence(category="category") -> Column:
    """Case-insensitive variant of the label, used when counting files."""
    return F.lower(_col(category)) != RANDOM_CATEGORY


# --- numbers and hashes --------------------------------------------------------------------------


def is_close(a, b, rel_tol: float = 1e-9, abs_tol: float = 0.0) -> Column:
    a, b = _col(a), _col(b)
    return F.abs(a - b) <= F.greatest(rel_tol * F.greatest(F.abs(a), F.abs(b)), F.lit(float(abs_tol)))


def seeded_md5(seed, key="example_id") -> Column:
    """Hex md5 of seed and id: the one source of reproducible random order."""
    return F.md5(F.concat(F.lit(f"{seed}|"), _col(key)))


def md5_percent(text) -> Column:
    """md5 of a text as a number, modulo 100.

    The 128-bit number is read in four 32-bit pieces, high piece first. 2**32 leaves 96 modulo 100, so
    each step multiplies the remainder by 96 and adds the next piece.
    """
    digest = F.md5(_col(text))
    pieces = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    return reduce(lambda rest, piece: F.pmod(rest * 96 + piece, F.lit(100)), pieces, F.lit(0).cast("long"))


def hash_partition(percent_eval: int, seed="", key="example_id") -> Column:
    """0 train, 1 eval: md5 of id and seed modulo 100 against the percentage."""
    value = md5_percent(F.concat(_col(key), F.lit(str(seed))))
    return F.when(value >= percent_eval, 0).otherwise(1)
