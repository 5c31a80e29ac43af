"""Domain tables derived from the driver's Parquet tables, by integer arithmetic only.

The same rules stand as SQL text in ``phenolith.queries.sql``.
"""

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolith.schema import TOKEN_LEVELS
from phenolith.session import by_shuffle

CALENDAR_EPOCH = "1994-07-01"  # the day on which the formulas of the readings count from 0
CALENDAR_LEAD = 184  # days of readings before the first order
RANDOM_BATCH = 1000
OBSERVATION_ROWS, STATION_ROWS = 100_000, 1_000  # of a task; a station becomes a few thousand readings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=64)
def _scan_tasks(spark: SparkSession, sf_dir: str, name: str) -> int:
    return table(spark, sf_dir, name).rdd.getNumPartitions()


@lru_cache(maxsize=64)
def _rows(spark: SparkSession, sf_dir: str, name: str) -> int:
    return table(spark, sf_dir, name).count()


def _spread(df: DataFrame, key: str, sf_dir: str, name: str, task_rows: int) -> DataFrame:
    """Rows of a given table over all cores, at most about ``task_rows`` in a task: a scan task holds millions of small raw rows, and the columns derived
    from them cost far more than moving them. A table with scan tasks enough is left as it is."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-_rows(df.sparkSession, sf_dir, name) // task_rows))
    return df if _scan_tasks(df.sparkSession, sf_dir, name) >= tasks else df.repartition(tasks, key)


LATITUDE = "case when {k} % 97 = 0 then 0.0D else 25.0D + cast(({k} * 37) % 120 as double) / 10.0D end"
LONGITUDE = "-110.0D + cast(({k} * 53) % 210 as double) / 10.0D"
# A stand-in cell hierarchy; real tokens are input data. Each level halves the cells of the one before.
_ROW = f"cast(floor((latitude + 90.0D) * {2 ** (TOKEN_LEVELS - 1)} / 180.0D) as int)"
_COLUMN = f"cast(floor((longitude + 180.0D) * {2 ** (TOKEN_LEVELS - 1)} / 360.0D) as int)"
# Row and column are computed once, not once a level; a lambda is interpreted, but 17 expressions side by side are too much code to be compiled.
TOKENS = (
    f"element_at(transform(array(named_struct('y', {_ROW}, 'x', {_COLUMN})), c -> transform(array({', '.join(str(TOKEN_LEVELS - 1 - k) for k in range(TOKEN_LEVELS))}), "
    "k -> concat_ws('_', shiftright(c.y, k), shiftright(c.x, k)))), 1)")


def _stored(**columns: str) -> str:
    """Columns that Spark treats as if they had been read, not as expressions to repeat at every later use."""
    return "inline(array(named_struct(" + ", ".join(f"'{n}', {v}" for n, v in columns.items()) + ")))"


def parsed_observations(spark, sf_dir: str) -> DataFrame:
    """One row per order: a third are random points, a few per cent are rejects."""
    day = "date_format(o_orderdate, 'yyyyMMdd')"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return _spread(orders, "o_orderkey", sf_dir, "orders", OBSERVATION_ROWS).selectExpr(
        "*", f"{LATITUDE.format(k='o_custkey')} as latitude", f"{LONGITUDE.format(k='o_custkey')} as longitude",
    ).selectExpr(
        "latitude", "longitude",
        "case when o_custkey % 89 <> 0 then (o_custkey * 13) % 3000 end as elevation",
        "o_custkey % 83 <> 0 as has_feature_set",
        "o_orderkey * 1000 as modified_at",
        "case when o_orderkey % 211 <> 0 then cast(o_orderdate as date) end as obs_date",
        _stored(
            example_id=f"""case when o_orderstatus = 'P' then concat_ws('-', 'r', o_orderkey div {RANDOM_BATCH} + 1, o_orderkey)
                                else concat('o-', o_orderkey) end""",
            category="case when o_orderstatus = 'P' then 'random' else concat('u', o_orderkey % 5) end",
            date_string=f"left({day}, case when o_orderkey % 211 = 0 then 7 else 8 end)",
            eco_realm="cast(o_custkey % 8 + 1 as string)",
            eco_biome="cast(o_custkey % 14 + 1 as string)",
            eco_num="cast(o_custkey % 30 + 1 as string)",
            source_type="cast(o_orderkey % 3 as string)",
            target_id="cast(o_custkey as string)",
            s2_tokens=TOKENS))


def documents(spark, sf_dir: str) -> DataFrame:
    """The same observations as nested source documents."""
    features = f"""case when has_feature_set then named_struct(
        'GeoPoint', struct(latitude, longitude), 'Elevation', cast(elevation as double),
        'EcoRealm', cast(eco_realm as int), 'EcoBiome', cast(eco_biome as int), 'EcoNum', cast(eco_num as int),
        'S2Tokens', map_from_arrays(transform(sequence(0, {TOKEN_LEVELS - 1}), k -> cast(k as string)), s2_tokens),
        'ModifiedAt', modified_at) end"""
    return parsed_observations(spark, sf_dir).selectExpr(
        "category", "example_id", "date_string as FormattedDate", _stored(GeoFeatureSet=features))


def observations(spark, sf_dir: str) -> DataFrame:
    """The valid rows with the columns of the data model."""
    from phenolith.operators.observations import OBSERVATION_COLUMNS, valid_observations

    return valid_observations(parsed_observations(spark, sf_dir)).select(*OBSERVATION_COLUMNS)


def stations(spark, sf_dir: str) -> DataFrame:
    """One station per supplier; every tenth shares the position of the one before it."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey as string) as usaf", "cast(s_suppkey % 10 as string) as wban",
        "25.05D + cast(((s_suppkey - s_suppkey % 10 div 9) * 61) % 120 as double) / 10.0D as lat",
        "-109.95D + cast(((s_suppkey - s_suppkey % 10 div 9) * 97) % 210 as double) / 10.0D as lon")


def readings(spark, sf_dir: str) -> DataFrame:
    """Daily readings of every station from half a year before the first order to the last, missing on days of a large returned shipment of its supplier."""
    # The missing days of a supplier go with its row: a join of readings and shipments would shuffle all readings or send the shipments through the driver.
    outages = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_quantity >= 50").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.collect_set(F.col("l_shipdate").cast("date")).alias("missing"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey").join(by_shuffle(outages), "s_suppkey", "left")
    # One row becomes a few thousand days; the join alone would leave all suppliers in a task, by their bytes.
    tasks = max(spark.sparkContext.defaultParallelism, -(-_rows(spark, sf_dir, "supplier") // STATION_ROWS))
    suppliers = suppliers.repartition(tasks, "s_suppkey")
    span = table(spark, sf_dir, "orders").selectExpr(
        f"date_sub(cast(min(o_orderdate) as date), {CALENDAR_LEAD}) as first", "cast(max(o_orderdate) as date) as last").first()
    # A product with a range of the calendar's days, a few thousand rows: the estimate of its size multiplies, while one of exploded rows is that of the suppliers, by
    # which all readings would pass for a table small enough to broadcast. What follows from the day alone is computed once a day.
    length = (span["last"] - span["first"]).days + 1 if span["first"] else 0
    calendar = spark.range(length).selectExpr(f"date_add(date '{span['first'] or CALENDAR_EPOCH}', cast(id as int)) as day")
    calendar = calendar.selectExpr(
        "day", f"datediff(day, date '{CALENDAR_EPOCH}') + 7000 as n",  # far enough from 0 to stay positive
        "date_format(day, 'yyyy') as year", "date_format(day, 'MM') as mo", "date_format(day, 'dd') as da")
    days = suppliers.select(F.col("s_suppkey").alias("s"), "missing").crossJoin(F.broadcast(calendar))
    return days.where("not coalesce(array_contains(missing, day), false)").drop("missing").selectExpr(
        "*", "cast((s * 7 + n * 3) % 35 + 60 as double) as high", "cast((s * 5 + n) % 35 + 20 as double) as low",
    ).selectExpr(
        "cast(s as string) as stn", "cast(s % 10 as string) as wban",
        "year", "mo", "da",
        "(high + low) / 2.0D as temp", "low as min", "high as max", "cast((s + n) % 7 as double) / 10.0D as prcp")


def areas(spark, sf_dir: str) -> DataFrame:
    """One protected area per part, without date."""
    return table(spark, sf_dir, "part").selectExpr(
        f"{LATITUDE.format(k='p_partkey')} as latitude", f"{LONGITUDE.format(k='p_partkey')} as longitude",
        "(p_partkey * 13) % 3000 as elevation", "cast(p_partkey % 8 + 1 as string) as eco_realm",
        "cast(p_partkey % 14 + 1 as string) as eco_biome", "cast(p_partkey % 30 + 1 as string) as eco_num",
        "p_partkey * 1000 as modified_at").selectExpr("*", _stored(s2_tokens=TOKENS))


def name_usages(spark, sf_dir: str) -> DataFrame:
    """One usage per supplier with three source types of five targets; some counts null or 0, some usages empty."""
    def targets(kind: int) -> str:
        return "map(" + ", ".join(
            f"""cast(s_suppkey * 15 + {kind * 5 + j} as string), named_struct('Occurrences',
                case (s_suppkey + {j}) % 4 when 0 then null when 1 then 0 else {j + 1} end)""" for j in range(5)) + ")"

    sources = "map(" + ", ".join(f"'{kind}', {targets(kind)}" for kind in range(3)) + ")"
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('u', s_suppkey) as id", f"case when s_suppkey % 11 <> 0 then {sources} end as Sources")


def listing(spark, sf_dir: str) -> DataFrame:
    """A file listing: versions of occurrence and area files, and numbered random files with a gap."""
    return table(spark, sf_dir, "documents").selectExpr("""explode(array(
        concat('occurrences/', source, '/', lpad(doc_id, 10, '0'), '.tfrecords'),
        concat('protected_areas/', lang, '/', lpad(doc_id, 10, '0'), '.tfrecords'),
        concat('random/', doc_id % 5, '/', doc_id div 5 + 1 + case when doc_id >= 100 then 1 else 0 end, '.tfrecords'))) as path""")


def eval_runs(spark, sf_dir: str) -> DataFrame:
    """One evaluation per event for one of 18 experiments."""
    part = "cast((event_id * {}) % 1000 as double) / 1000.0D as {}"
    return table(spark, sf_dir, "events").selectExpr(
        "user_id % 18 as experiment_id", "value / 500.0D as accuracy", part.format(7, "auc"),
        part.format(11, "auc_precision_recall"), "value / 250.0D as average_loss",
        part.format(13, "label_mean"), part.format(17, "prediction_mean"))


def scores(spark, sf_dir: str) -> DataFrame:
    """One label and score between 0 and 1 per event; nearly every score is another."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "cast(case when user_id % 3 = 0 then 1 else 0 end as double) as label", "cast((event_id * 7919) % 99991 + 1 as double) / 100000.0D as score")


def elevation_lookup(spark, sf_dir: str) -> DataFrame:
    """One known elevation per customer, about a metre from the place of its orders."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as position", f"{LATITUDE.format(k='c_custkey')} as lat", f"{LONGITUDE.format(k='c_custkey')} as lon",
        "(c_custkey * 7) % 3000 as elevation",
    ).where("lat <> 0").selectExpr("position", "lat + 0.000004D as latitude", "lon - 0.000004D as longitude", "elevation")
