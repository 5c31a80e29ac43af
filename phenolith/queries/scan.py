"""Parsing, validation, sources and listings."""

from pyspark.sql import functions as F

from phenolith import adapters as A
from phenolith.functions import columns as X
from phenolith.operators import observations as O
from phenolith.plans.enrich import union_examples
from phenolith.queries import query
from phenolith.queries.sql import EQUALITY_KEY, MONTH_KEY, ROUTING, SEASON, SEASON_KEY
from phenolith.schema import TOKEN_LEVELS
from phenolith.sources import listings as L
from phenolith.sources import scans as S

DAY = "strftime(obs_date, '%Y%m%d')"


@query(f"""SELECT example_id, category, latitude, longitude, elevation, {DAY} AS obs_date, eco_realm, eco_biome, eco_num,
  array_to_string(s2_tokens, ' ') AS tokens FROM obs""")
def parse_observations(spark, sf):
    good = O.valid_observations(O.parse_documents(A.documents(spark, sf)))
    return good.select(
        "example_id", "category", "latitude", "longitude", "elevation", X.date_key().alias("obs_date"),
        "eco_realm", "eco_biome", "eco_num", F.array_join("s2_tokens", " ").alias("tokens"))


REASONS = """SELECT example_id, concat_ws(',', CASE WHEN NOT has_feature_set THEN 'feature_set_missing' END,
    CASE WHEN has_feature_set AND latitude = 0 THEN 'latitude_empty' END,
    CASE WHEN has_feature_set AND length(date_string) <> 8 THEN 'date_length' END,
    CASE WHEN has_feature_set AND elevation IS NULL THEN 'elevation_missing' END) AS reasons
  FROM parsed"""


@query(f"SELECT * FROM ({REASONS}) WHERE reasons <> ''")
def reject_reasons(spark, sf):
    rejected = O.rejected_observations(O.parse_documents(A.documents(spark, sf)))
    return rejected.select("example_id", F.concat_ws(",", "reasons").alias("reasons"))


@query(f"""SELECT reason, count(*) AS n FROM (
    SELECT unnest(CASE WHEN reasons = '' THEN ['accepted'] ELSE string_split(reasons, ',') END) AS reason FROM ({REASONS}))
  GROUP BY reason""")
def dead_letter_counts(spark, sf):
    judged = O.with_reasons(O.parse_documents(A.documents(spark, sf)))
    reason = F.explode(F.when(F.size("reasons") == 0, F.array(F.lit("accepted"))).otherwise(F.col("reasons")))
    return judged.select(reason.alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(f"""SELECT example_id, year(obs_date)::INTEGER AS year, month(obs_date)::INTEGER AS month, monthname(obs_date) AS month_name,
    ({SEASON})::INTEGER AS season, {SEASON_KEY} AS season_region_key, {MONTH_KEY} AS month_region_key,
    {EQUALITY_KEY} AS equality_key, s2_tokens[5] AS token_4,
    (CASE WHEN category = 'random' THEN split_part(example_id, '-', 2)::INTEGER ELSE 0 END)::INTEGER AS random_batch_id,
    {ROUTING} AS routing_category, eco_realm || '/' || eco_biome || '/' || eco_num AS eco_region,
    {DAY} AS date_key, category <> 'random' AS presence
  FROM obs""")
def scalar_columns(spark, sf):
    region = X.eco_region()
    return A.observations(spark, sf).select(
        "example_id", F.year("obs_date").alias("year"), F.month("obs_date").alias("month"), X.month_name().alias("month_name"),
        X.season().alias("season"), X.season_region_key().alias("season_region_key"), X.month_region_key().alias("month_region_key"),
        X.equality_key().alias("equality_key"), X.s2_token(4).alias("token_4"), X.random_batch_id().alias("random_batch_id"),
        X.routing_category().alias("routing_category"),
        F.concat_ws("/", region["realm"], region["biome"], region["num"]).alias("eco_region"),
        X.date_key().alias("date_key"), X.label_presence().alias("presence"))


@query("""SELECT CASE WHEN category = 'random' THEN 'random' ELSE 'occurrence' END AS kind, category, count(*) AS n
  FROM obs GROUP BY ALL""")
def category_kind(spark, sf):
    return A.observations(spark, sf).groupBy(X.category_kind().alias("kind"), "category").agg(F.count("*").alias("n"))


@query(f"""SELECT routing_category, CASE WHEN routing_category LIKE 'random%' THEN split_part(routing_category, '-', 2) END AS category_id,
    CASE WHEN routing_category LIKE 'random%' THEN 'random/1700000000/' || split_part(routing_category, '-', 2) || '.tfrecords'
         ELSE 'occurrences/' || routing_category || '/1700000000.tfrecords' END AS path,
    true AS valid, count(*) AS n
  FROM (SELECT {ROUTING} AS routing_category FROM obs) GROUP BY routing_category""")
def category_path(spark, sf):
    per_category = A.observations(spark, sf).groupBy(X.routing_category().alias("routing_category")).agg(F.count("*").alias("n"))
    return per_category.select(
        "routing_category", X.category_id("routing_category").alias("category_id"),
        X.category_path("routing_category", F.lit("1700000000")).alias("path"),
        X.valid_category("routing_category").alias("valid"), "n")


@query("SELECT *, usage_id || '-|-' || source_type || '-|-' || target_id AS source_key FROM sources")
def explode_name_usage_sources(spark, sf):
    return O.explode_name_usage_sources(A.name_usages(spark, sf))


@query("""SELECT *, usage_id || '-|-' || source_type || '-|-' || target_id AS source_key FROM sources WHERE usage_id IN ('u1', 'u3')""")
def explode_sources_of_usages(spark, sf):
    """The same for named usages only."""
    return O.explode_name_usage_sources(A.name_usages(spark, sf), "u1,u3")


@query("""SELECT example_id FROM obs WHERE year(obs_date) - 48 >= 1950""")
def filter_year(spark, sf):
    """Observations moved 48 years back: those of too early a year go."""
    moved = A.observations(spark, sf).withColumn("obs_date", F.add_months("obs_date", -48 * 12))
    return O.filter_year(moved).select("example_id")


@query("""SELECT example_id FROM obs WHERE length(example_id) % 2 = 0""")
def require_fixed_length(spark, sf):
    """Rows whose list of tokens was cut don't have the declared length."""
    short = F.when(F.length("example_id") % 2 == 0, F.col("s2_tokens")).otherwise(F.slice("s2_tokens", 1, 3))
    rows = A.observations(spark, sf).withColumn("s2_tokens", short)
    return O.require_fixed_length(rows, {"s2_tokens": TOKEN_LEVELS}).select("example_id")


@query("SELECT example_id, latitude, longitude FROM obs")
def coordinates(spark, sf):
    return A.observations(spark, sf).select("example_id", X.coordinates().alias("p")).select("example_id", "p.*")


VALID = "has_feature_set AND latitude <> 0 AND length(date_string) = 8 AND elevation IS NOT NULL"


@query(f"""SELECT p.example_id, s.usage_id AS category, p.source_type, p.target_id
  FROM (SELECT * FROM parsed WHERE {VALID}) p JOIN sources s ON p.source_type = s.source_type AND p.target_id = s.target_id""")
def scan_occurrences_by_source(spark, sf):
    sources = O.explode_name_usage_sources(A.name_usages(spark, sf))
    found = S.scan_occurrences_by_source(A.parsed_observations(spark, sf), sources)
    return O.valid_observations(found).select("example_id", "category", "source_type", "target_id")


@query(f"""SELECT s.usage_id, s.source_key, count(*) AS n FROM (SELECT * FROM parsed WHERE {VALID}) p
  JOIN (SELECT *, usage_id || '-|-' || source_type || '-|-' || target_id AS source_key FROM sources) s
    ON p.source_type = s.source_type AND p.target_id = s.target_id GROUP BY ALL""")
def occurrence_sources_join(spark, sf):
    """The chain from usages over source keys to occurrences, the key taken apart again on the way."""
    keys = O.explode_name_usage_sources(A.name_usages(spark, sf)).select("source_key", X.source_key_parts().alias("p"))
    found = A.parsed_observations(spark, sf).join(keys.select("source_key", "p.*"), ["source_type", "target_id"])
    return O.valid_observations(found).groupBy("usage_id", "source_key").agg(F.count("*").alias("n"))


def _parts(df, scan, middle):
    first, rest = scan(df, 0, middle), scan(df, middle, 0)
    return first.withColumn("part", F.lit("first")).unionByName(rest.withColumn("part", F.lit("rest")))


@query("""SELECT example_id, 'random' AS category, modified_at, CASE WHEN modified_at < 5000000 THEN 'first' ELSE 'rest' END AS part
  FROM parsed WHERE category = 'random'""")
def scan_random_range(spark, sf):
    """The random points as a closed and an open key range."""
    random = A.parsed_observations(spark, sf).where(F.col("category") == "random")
    return _parts(random.drop("category"), S.scan_random_range, 5_000_000).select("example_id", "category", "modified_at", "part")


@query("""SELECT modified_at, latitude, longitude, CASE WHEN modified_at < 500000 THEN 'first' ELSE 'rest' END AS part FROM areas""")
def scan_area_range(spark, sf):
    return _parts(A.areas(spark, sf), S.scan_key_range, 500_000).select("modified_at", "latitude", "longitude", "part")


@query("""SELECT n // 250 AS range_no, modified_at AS start_key, coalesce(lead(modified_at) OVER (ORDER BY n), 0) AS end_key
  FROM (SELECT modified_at, row_number() OVER (ORDER BY modified_at) - 1 AS n FROM parsed WHERE category = 'random') WHERE n % 250 = 0""")
def keyset_batches(spark, sf):
    return S.keyset_batches(A.parsed_observations(spark, sf).where(F.col("category") == "random"))


@query("""SELECT example_id, modified_at FROM parsed WHERE category = 'random'""")
def order_by_modified(spark, sf):
    random = A.parsed_observations(spark, sf).where(F.col("category") == "random")
    return S.order_by_modified(random.select("example_id", "modified_at"))


AREA_DATES = "(SELECT unnest(['19980106', '19980109', '19980113', '19980116']) AS date_string)"


@query(f"""SELECT 'protected_area-' || date_string AS category, s2_tokens[16] AS example_id, date_string, latitude, longitude, modified_at
  FROM areas, {AREA_DATES} WHERE latitude <> 0""")
def explode_area_dates(spark, sf):
    dates = O.survey_dates(spark, "1998-01-05", "1998-01-18")
    exploded = O.explode_area_dates(A.areas(spark, sf), date_table=dates)
    return O.valid_observations(exploded).select("category", "example_id", "date_string", "latitude", "longitude", "modified_at")


@query("""SELECT strftime(d, '%Y%m%d') AS date_string, count(example_id) AS n
  FROM (SELECT (SELECT min(obs_date) FROM obs) + i::INTEGER AS d FROM range(0, (SELECT max(obs_date) - min(obs_date) + 1 FROM obs)) AS t(i))
  LEFT JOIN obs ON obs_date = d WHERE isodow(d) IN (2, 5) GROUP BY d""")
def survey_dates(spark, sf):
    """Survey days within the span of the observations, with the observations made on them."""
    seen = A.observations(spark, sf)
    span = seen.agg(F.min("obs_date"), F.max("obs_date")).first()
    per_day = seen.groupBy(X.date_key().alias("date_string")).agg(F.count("*").alias("n"))
    days = O.survey_dates(spark, str(span[0]), str(span[1]))
    return days.join(per_day, "date_string", "left").select("date_string", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"""SELECT category, count(*) AS n, sum(elevation)::BIGINT AS elevation FROM (
    SELECT 'protected_area-' || date_string AS category, elevation FROM areas, {AREA_DATES} WHERE latitude <> 0
    UNION ALL SELECT category, elevation FROM obs WHERE category = 'random') GROUP BY category""")
def union_areas_and_random(spark, sf):
    dates = O.survey_dates(spark, "1998-01-05", "1998-01-18")
    areas = O.valid_observations(O.explode_area_dates(A.areas(spark, sf), date_table=dates)).select(*O.OBSERVATION_COLUMNS)
    random = A.observations(spark, sf).where(F.col("category") == "random")
    return union_examples(areas, random).groupBy("category").agg(F.count("*").alias("n"), F.sum("elevation").alias("elevation"))


@query("""SELECT dir || '/' || name AS path FROM (
    SELECT dir, max(name) AS name FROM entries WHERE path LIKE 'occurrences%' OR path LIKE 'protected_areas%' GROUP BY dir
    UNION ALL SELECT dir, name FROM entries WHERE path LIKE 'random%'
      AND dir = (SELECT max(dir) FROM entries WHERE path LIKE 'random%'))""")
def latest_example_files(spark, sf):
    return L.latest_example_files(A.listing(spark, sf))


@query("""SELECT split_part(path, '/', 1) AS parent, max(split_part(path, '/', 2)) AS version FROM listing GROUP BY 1""")
def latest_version(spark, sf):
    return L.latest_per_parent(A.listing(spark, sf))


@query("""SELECT split_part(path, '/', 2) AS usage_id, arg_max(path, name) AS path FROM entries WHERE path LIKE 'occurrences/%' GROUP BY 1""")
def latest_occurrence_file(spark, sf):
    return L.latest_occurrence_files(A.listing(spark, sf))


@query("""SELECT arg_max(path, name) AS path FROM entries WHERE path LIKE 'occurrences/src1%'""")
def latest_occurrence_file_by_prefix(spark, sf):
    """A usage name is a prefix: longer names that start with it count too."""
    return L.latest_occurrence_file(A.listing(spark, sf), "src1", exact=False)


@query("""SELECT arg_max(path, name) AS path FROM entries WHERE path LIKE 'occurrences/src1/%'""")
def latest_occurrence_file_of_usage(spark, sf):
    return L.latest_occurrence_file(A.listing(spark, sf), "src1")


@query("""SELECT 'occurrences/src1/' || max(split_part(path, '/', 3)) AS path FROM listing WHERE path LIKE 'occurrences/src1/%'""")
def latest_version_of_parent(spark, sf):
    """The function itself, with sibling folders whose names begin alike."""
    return spark.createDataFrame([(L.latest_version(A.listing(spark, sf), "occurrences/src1"),)], "path string")


@query("""SELECT version, file_no, path FROM (
    SELECT *, dense_rank() OVER (ORDER BY file_no) AS r FROM (
      SELECT path, split_part(path, '/', 2) AS version, split_part(split_part(path, '/', 3), '.', 1)::INTEGER AS file_no
      FROM listing WHERE path LIKE 'random/%') WHERE version = (SELECT max(split_part(path, '/', 2)) FROM listing WHERE path LIKE 'random/%'))
  WHERE r = file_no""")
def latest_random_dir(spark, sf):
    return L.latest_random_dir(A.listing(spark, sf), until_gap=True)


@query("""SELECT version, file_no, path FROM (
    SELECT path, split_part(path, '/', 2) AS version, split_part(split_part(path, '/', 3), '.', 1)::INTEGER AS file_no FROM listing WHERE path LIKE 'random/%')
  WHERE version = (SELECT max(split_part(path, '/', 2)) FROM listing WHERE path LIKE 'random/%') AND file_no >= 1""")
def latest_random_files(spark, sf):
    """All files of the newest random version, whatever numbers are missing."""
    return L.latest_random_dir(A.listing(spark, sf))
