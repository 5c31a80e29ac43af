"""Nested source documents to flat observations, validation and the reject table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.functions import columns as X
from phenolith.schema import MINIMUM_YEAR, TOKEN_LEVELS, WEATHER_DAYS, WEATHER_LAG_DAYS

OBSERVATION_COLUMNS = [
    "example_id", "category", "latitude", "longitude", "elevation", "obs_date",
    "eco_realm", "eco_biome", "eco_num", "s2_tokens",
]


def parse_documents(documents: DataFrame, tokens_as_list: bool = False) -> DataFrame:
    """Flatten nested documents. Values that cannot be read become null and are judged later."""
    g = "GeoFeatureSet"
    if tokens_as_list:
        ordered, token_count = f"{g}.S2Tokens", f"size({g}.S2Tokens)"
    else:
        # Sorting the entries reads the map once; looking up level by level is for maps with other keys.
        entries = f"array_sort(transform(map_entries({g}.S2Tokens), e -> struct(try_cast(e.key as int) as k, e.value as v)))"
        levels = f"sequence(0, {TOKEN_LEVELS - 1})"
        ordered = f"""element_at(transform(array({entries}), s -> case when transform(s, e -> e.k) = {levels} then transform(s, e -> e.v)
            else transform({levels}, k -> try_element_at({g}.S2Tokens, cast(k as string))) end), 1)"""
        token_count = f"size({g}.S2Tokens)"
    kept = [c for c in documents.columns if c not in (g, "FormattedDate")]
    return documents.selectExpr(
        *kept,
        f"{g} is not null as has_feature_set",
        "FormattedDate as date_string",
        "try_to_date(FormattedDate, 'yyyyMMdd') as obs_date",
        f"try_cast({g}.GeoPoint.latitude as double) as latitude",
        f"try_cast({g}.GeoPoint.longitude as double) as longitude",
        f"try_cast({g}.Elevation as bigint) as elevation",
        f"cast(try_cast({g}.EcoRealm as int) as string) as eco_realm",
        f"cast(try_cast({g}.EcoBiome as int) as string) as eco_biome",
        f"cast(try_cast({g}.EcoNum as int) as string) as eco_num",
        f"case when {token_count} = {TOKEN_LEVELS} then {ordered} end as s2_tokens",
    )


# Reasons to reject a row, in reporting order.
_REJECT_RULES = [
    ("category_empty", "category is null or category = ''"),
    ("latitude_empty", "latitude is null or latitude = 0"),
    ("longitude_empty", "longitude is null or longitude = 0"),
    ("date_length", "date_string is null or length(date_string) <> 8"),
    ("date_unreadable", "length(date_string) = 8 and obs_date is null"),
    ("elevation_missing", "elevation is null"),
    ("eco_empty", "eco_realm is null or eco_biome is null or eco_num is null or '0' in (eco_realm, eco_biome, eco_num)"),
    ("token_count", f"s2_tokens is null or size(s2_tokens) <> {TOKEN_LEVELS}"),
    ("token_empty", "exists(s2_tokens, t -> t is null or t = '')"),
    ("window_before_1950", f"obs_date < date_add(make_date({MINIMUM_YEAR}, 1, 1), {WEATHER_DAYS + WEATHER_LAG_DAYS})"),
]


def reject_rules(columns: list[str]) -> list[tuple[str, str]]:
    """Name and SQL condition of every reason."""
    if "has_feature_set" not in columns:
        return _REJECT_RULES
    # A document without its feature set has nothing else to judge.
    return [("feature_set_missing", "not has_feature_set")] + [
        (name, f"has_feature_set and ({rule})") for name, rule in _REJECT_RULES]


def with_reasons(parsed: DataFrame) -> DataFrame:
    """Add the array of reject reasons; empty for a good row."""
    flags = ", ".join(f"case when {rule} then '{name}' end" for name, rule in reject_rules(parsed.columns))
    return parsed.withColumn("reasons", F.expr(f"array_compact(array({flags}))"))


def valid_observations(parsed: DataFrame) -> DataFrame:
    """Rows without any reason, as plain filters that reach the scan where they can.

    The token rules are put in functions that stay in generated code: membership is null, hence no, for
    an array with a null in it.
    """
    rules = [f"not coalesce({r}, false)" for name, r in reject_rules(parsed.columns) if name != "token_empty"]
    return parsed.where(" and ".join([*rules, "not coalesce(array_contains(s2_tokens, ''), true)"]))


def rejected_observations(parsed: DataFrame) -> DataFrame:
    return with_reasons(parsed).where(F.size("reasons") > 0).select("example_id", "reasons")


def filter_year(df: DataFrame, day: str = "obs_date") -> DataFrame:
    """Keep years from the first supported one to the current one."""
    return df.where(F.year(day).between(F.lit(MINIMUM_YEAR), F.year(F.current_date())))


def require_fixed_length(df: DataFrame, lengths: dict[str, int]) -> DataFrame:
    """Keep rows whose arrays have exactly the declared lengths."""
    for name, n in lengths.items():
        df = df.where(F.size(name) == n)
    return df


def with_length_reasons(df: DataFrame, lengths: dict[str, int]) -> DataFrame:
    """Add the array of reasons ``length_<column>`` of arrays that are null or don't have the declared length; empty for a good row."""
    flags = [F.when(~F.coalesce(F.size(name) == n, F.lit(False)), F.lit(f"length_{name}")) for name, n in lengths.items()]
    return df.withColumn("reasons", F.array_compact(F.array(*flags)))


def explode_name_usage_sources(usages: DataFrame, usage_ids: str | None = None) -> DataFrame:
    """One row per usage, source type and target with a positive occurrence count."""
    if usage_ids is not None:
        usages = usages.where(F.col("id").isin(usage_ids.split(",")))
    by_type = usages.select(F.col("id").alias("usage_id"), F.explode("Sources").alias("source_type", "targets"))
    by_target = by_type.select("usage_id", "source_type", F.explode("targets").alias("target_id", "source"))
    return by_target.where(F.col("source.Occurrences") > 0).select(
        "usage_id", "source_type", "target_id",
        X.source_key("usage_id", "source_type", "target_id").alias("source_key"),
    )


def explode_area_dates(areas: DataFrame, dates: str | None = None, date_table: DataFrame | None = None) -> DataFrame:
    """Every area on every requested date; a list of dates is a parameter, a few entries long.

    ``areas`` are parsed rows without a date. The category carries the date, the id is token level 15. A table of dates, some
    hundreds long, becomes one array of the plan by a scalar subquery. Without dates there are no rows.
    """
    if dates is None:
        text = "select *, explode((select collect_list(date_string) from {dates})) as date_string from {areas}"
        exploded = areas.sparkSession.sql(text, areas=areas, dates=date_table)
    else:
        exploded = areas.withColumn("date_string", F.explode(X.split_list(F.lit(dates)))).where("trim(date_string) <> ''")
    return exploded.withColumns({
        "category": F.concat(F.lit("protected_area-"), F.col("date_string")),
        "example_id": X.s2_token(15),
        "obs_date": X.parse_date("date_string"),
    })


def survey_dates(spark, start: str, end: str) -> DataFrame:
    """All Tuesdays and Fridays from start to end, both included, as ``YYYYMMDD``."""
    day = F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    return (
        spark.range(1).select(day.alias("day"))
        .where(F.weekday("day").isin(1, 4))
        .select(F.date_format("day", "yyyyMMdd").alias("date_string"))
    )
