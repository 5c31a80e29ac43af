"""Counts, groups, duplicates, numbering and splits."""

from pyspark.sql import functions as F

from phenolith import adapters as A
from phenolith.functions import columns as X
from phenolith.operators import elevation as EL
from phenolith.operators import grouping as G
from phenolith.operators import numbering as N
from phenolith.operators import sampling as SP
from phenolith.queries import query
from phenolith.queries.sql import EQUALITY_KEY, MONTH_KEY, SEASON_KEY
from phenolith.session import write_once

BATCH_OF_RANDOM = "split_part(example_id, '-', 2)::INTEGER"


def _random(spark, sf):
    return A.observations(spark, sf).where(F.col("category") == "random")


def _occurrences(spark, sf):
    return A.observations(spark, sf).where(F.col("category") != "random")


@query(f"SELECT {SEASON_KEY} AS season_region_key, count(*) AS n FROM obs GROUP BY 1")
def season_region_counts(spark, sf):
    return G.count_by(A.observations(spark, sf), X.season_region_key().alias("season_region_key"))


@query(f"SELECT {MONTH_KEY} AS month_region_key, count(*) AS n FROM obs GROUP BY 1")
def month_region_counts(spark, sf):
    return G.count_by(A.observations(spark, sf), X.month_region_key().alias("month_region_key"))


@query("""SELECT season_region_key, n, south, north, west, east, strftime(earliest, '%Y%m%d') AS earliest,
  strftime(latest, '%Y%m%d') AS latest FROM extents""")
def group_extent(spark, sf):
    keyed = A.observations(spark, sf).withColumn("season_region_key", X.season_region_key())
    return G.group_extent(keyed, "season_region_key").withColumns({
        "earliest": X.date_key("earliest"), "latest": X.date_key("latest")})


@query("""SELECT season_region_key, n, round(radius_km, 4) AS radius_km, round(box_north, 5) AS box_north, round(box_south, 5) AS box_south,
  round(box_east, 5) AS box_east, round(box_west, 5) AS box_west FROM boxes""")
def geodesic_box(spark, sf):
    keyed = A.observations(spark, sf).withColumn("season_region_key", X.season_region_key())
    box = G.geodesic_box(G.group_extent(keyed, "season_region_key"), 100.0)
    return box.select(
        "season_region_key", "n", F.round("radius_km", 4).alias("radius_km"),
        *[F.round(c, 5).alias(c) for c in ("box_north", "box_south", "box_east", "box_west")])


@query("SELECT count(*) AS n FROM obs")
def count_records(spark, sf):
    return A.observations(spark, sf).agg(F.count("*").alias("n"))


@query("SELECT category, count(*) AS n FROM obs GROUP BY category")
def count_by_category(spark, sf):
    return G.count_by(A.observations(spark, sf), "category").orderBy("n", "category")


@query("SELECT count(*) AS total, count(DISTINCT category) AS distinct_keys FROM obs")
def count_summary(spark, sf):
    return G.count_summary(A.observations(spark, sf), "category")


@query("SELECT strftime(obs_date, '%Y%m%d') AS obs_date, count(*) AS n FROM obs GROUP BY 1")
def count_by_date(spark, sf):
    return G.count_by(A.observations(spark, sf), X.date_key().alias("obs_date"))


@query("SELECT lower(category) <> 'random' AS presence, count(*) AS n FROM obs GROUP BY 1")
def count_presence(spark, sf):
    return G.count_by(A.observations(spark, sf), X.is_presence().alias("presence"))


@query(f"""SELECT files, total, total // files AS per_file, round((total // files) * 0.05::DOUBLE)::BIGINT AS eval_per_file FROM (
    SELECT count(*) AS files, sum(n)::BIGINT AS total FROM (
      SELECT {BATCH_OF_RANDOM} AS file, count(*) AS n FROM obs WHERE category = 'random' GROUP BY 1))""")
def count_per_file(spark, sf):
    return G.count_per_file(_random(spark, sf), X.random_batch_id().alias("file"), 0.05)


@query("SELECT min(example_id) AS first_id FROM obs")
def first_id(spark, sf):
    return G.first_id(A.observations(spark, sf))


@query(f"""SELECT example_id, category, equality_key FROM (
    SELECT *, row_number() OVER (PARTITION BY equality_key ORDER BY example_id) AS rn FROM (SELECT *, {EQUALITY_KEY} AS equality_key FROM obs))
  WHERE rn = 1""")
def dedupe_location_date(spark, sf):
    # Positions are drawn from few customers, so real duplicates occur.
    return G.dedupe_location_date(A.observations(spark, sf)).select(
        "example_id", "category", X.equality_key().alias("equality_key"))


@query("""SELECT category, example_id FROM (
    SELECT category, example_id, row_number() OVER (PARTITION BY category ORDER BY example_id) AS rn FROM obs) WHERE rn <= 101""")
def truncate_per_group(spark, sf):
    return N.truncate_per_group(A.observations(spark, sf).select("category", "example_id"), "category", 100, ["example_id"])


@query("""SELECT category, example_id FROM (
    SELECT category, example_id, row_number() OVER (PARTITION BY category ORDER BY example_id) AS rn FROM obs) WHERE rn <= 1501""")
def truncate_per_group_beyond_threshold(spark, sf):
    """A limit above the engine's threshold for limits per group: rows are numbered, no group is sorted in one task."""
    return N.truncate_per_group(A.observations(spark, sf).select("category", "example_id"), "category", 1500, ["example_id"])


@query("""SELECT example_id, (row_number() OVER (ORDER BY example_id) - 1) // 200 AS batch FROM obs""")
def in_batches(spark, sf):
    return N.in_batches(A.observations(spark, sf).select("example_id"), 200, ["example_id"])


@query("SELECT example_id, month(obs_date)::INTEGER AS month FROM obs")
def diffuse_by_month(spark, sf):
    return N.diffuse_by_month(A.observations(spark, sf)).select("example_id", F.month("obs_date").alias("month"))


@query("SELECT example_id, year(obs_date)::INTEGER AS year FROM obs")
def diffuse_by_year(spark, sf):
    return N.diffuse_by_year(A.observations(spark, sf)).select("example_id", F.year("obs_date").alias("year"))


@query("SELECT example_id, category FROM obs")
def shuffle_rows(spark, sf):
    return N.shuffle_rows(A.observations(spark, sf).select("example_id", "category"), X.seeded_md5(1))


@query("""SELECT category, occurrences, eval_random, eval_occurrence, occurrences * 5 - eval_random AS train_random,
    occurrences - eval_occurrence AS train_occurrence FROM (
    SELECT category, n AS occurrences, round(n * 5 * 0.05::DOUBLE)::BIGINT AS eval_random, round(n * 0.05::DOUBLE)::BIGINT AS eval_occurrence
    FROM (SELECT category, count(*) AS n FROM obs WHERE category <> 'random' GROUP BY 1))""")
def split_quotas(spark, sf):
    counts = _occurrences(spark, sf).groupBy("category").agg(F.count("*").alias("occurrences"))
    return SP.split_quota_columns(counts)


SPLIT_SQL = """
  SELECT example_id, category, split FROM (
    SELECT example_id, category, CASE
        WHEN rn <= CASE WHEN category = 'random' THEN round(occ * 0.1::DOUBLE) ELSE round(occ * 0.1::DOUBLE) END THEN 'eval'
        WHEN rn <= occ THEN 'train' END AS split
    FROM (SELECT example_id, category, (SELECT count(*) FROM obs WHERE category <> 'random') AS occ,
                 row_number() OVER (PARTITION BY category = 'random' ORDER BY md5('7|' || example_id), example_id) AS rn FROM obs))
  WHERE split IS NOT NULL"""


def _split(spark, sf):
    return SP.train_eval_split(A.observations(spark, sf).select("example_id", "category"), multiplier=1, pct=0.1, seed=7)


@query(SPLIT_SQL)
def train_eval_split(spark, sf):
    return _split(spark, sf)


@query("""SELECT example_id, category, split FROM (
    SELECT example_id, category, CASE
        WHEN rn <= CASE WHEN scarce THEN round(total * 0.1::DOUBLE) ELSE round(2 * total * 0.1::DOUBLE) END THEN 'eval'
        WHEN rn <= CASE WHEN scarce THEN total ELSE 2 * total END THEN 'train' END AS split
    FROM (SELECT example_id, category, category = 'u0' AS scarce, (SELECT count(*) FROM obs WHERE category = 'u0') AS total,
                 row_number() OVER (PARTITION BY category = 'u0' ORDER BY md5('7|' || example_id), example_id) AS rn
          FROM obs)) WHERE split IS NOT NULL""")
def train_eval_split_surplus(spark, sf):
    """One usage against all other rows as background: most of the background is left over."""
    rows = A.observations(spark, sf).select("example_id", "category")
    return SP.train_eval_split(rows, multiplier=2, pct=0.1, seed=7, presence=F.col("category") == "u0")


@query(f"SELECT split, category <> 'random' AS presence, count(*) AS n FROM ({SPLIT_SQL}) GROUP BY ALL")
def count_split(spark, sf):
    return _split(spark, sf).groupBy("split", X.label_presence().alias("presence")).agg(F.count("*").alias("n"))


@query("""SELECT example_id FROM (SELECT example_id, row_number() OVER (ORDER BY md5('3|' || example_id), example_id) AS rn FROM obs)
  WHERE rn <= 500""")
def sample_positions(spark, sf):
    return SP.sample_positions(A.observations(spark, sf).select("example_id"), 500, 3)


@query("""SELECT example_id, CASE WHEN h >= 20 THEN 0 ELSE 1 END AS part FROM (
    SELECT example_id, (((('0x' || m[1:8])::BIGINT % 100 * 96 + ('0x' || m[9:16])::BIGINT) % 100 * 96
                        + ('0x' || m[17:24])::BIGINT) % 100 * 96 + ('0x' || m[25:32])::BIGINT) % 100 AS h
    FROM (SELECT example_id, md5(example_id || '42') AS m FROM obs))""")
def hash_partition(spark, sf):
    return A.observations(spark, sf).select("example_id", X.hash_partition(20, 42).alias("part"))


@query(f"""SELECT example_id, {BATCH_OF_RANDOM} AS batch FROM obs WHERE category = 'random'
  AND {BATCH_OF_RANDOM} <= ceil((SELECT count(*) FROM obs WHERE category <> 'random') / 1000.0::DOUBLE)""")
def match_random_to_occurrences(spark, sf):
    rows = SP.match_random_to_occurrences(_random(spark, sf), _occurrences(spark, sf), A.RANDOM_BATCH)
    return rows.select("example_id", X.random_batch_id().alias("batch"))


RANDOM_FILES = f"(SELECT {BATCH_OF_RANDOM} AS file_no, count(*) AS n FROM obs WHERE category = 'random' GROUP BY 1)"


@query(f"""SELECT file_no, n FROM (
    SELECT *, row_number() OVER (ORDER BY md5('5|' || file_no::VARCHAR), file_no) AS rn FROM {RANDOM_FILES})
  WHERE rn <= 1000 // (SELECT sum(n)::BIGINT // count(*) FROM {RANDOM_FILES}) + 1""")
def sample_random_files(spark, sf):
    files = _random(spark, sf).groupBy(X.random_batch_id().alias("file_no")).agg(F.count("*").alias("n"))
    return SP.sample_random_files(files, 1000, 5)


BY_FILE_SQL = f"""
  WITH random AS (SELECT example_id, {BATCH_OF_RANDOM} AS file_no FROM obs WHERE category = 'random'),
  total AS (SELECT count(*) AS n, (count(*) // 10)::BIGINT AS wanted FROM random),
  shares AS (SELECT file_no, count(*) * (SELECT wanted FROM total) // (SELECT n FROM total) AS whole,
      count(*) * (SELECT wanted FROM total) % (SELECT n FROM total) AS rest FROM random GROUP BY file_no),
  quotas AS (SELECT file_no, whole + (row_number() OVER (ORDER BY rest DESC, file_no)
      <= (SELECT wanted FROM total) - (SELECT sum(whole) FROM shares))::BIGINT AS quota FROM shares),
  drawn AS (SELECT r.*, row_number() OVER (PARTITION BY r.file_no ORDER BY md5('9|' || example_id), example_id) <= quota AS evaluated
    FROM random r JOIN quotas q ON r.file_no = q.file_no)
  SELECT example_id, file_no, CASE WHEN evaluated THEN 'eval' ELSE 'train' END AS split FROM (
    SELECT *, row_number() OVER (PARTITION BY evaluated ORDER BY md5('9|' || example_id), example_id) AS rn FROM drawn)
  WHERE evaluated OR rn <= (SELECT n FROM total) // 2"""


def _by_file(spark, sf):
    rows = write_once(_random(spark, sf).select("example_id", X.random_batch_id().alias("file_no")), "random-rows")  # counted, numbered and drawn from
    n = rows.count()
    return SP.split_by_file(rows, n // 10, n // 2, 9)


@query(f"SELECT file_no, split, count(*) AS n FROM ({BY_FILE_SQL}) GROUP BY ALL")
def split_rows_per_file(spark, sf):
    """Evaluation rows spread over the files by largest remainders: the exact counts of both parts in each file."""
    return _by_file(spark, sf).groupBy("file_no", "split").agg(F.count("*").alias("n"))


@query(BY_FILE_SQL)
def split_by_file(spark, sf):
    return _by_file(spark, sf)


@query("""SELECT p.example_id, coalesce(p.elevation, f.elevation)::BIGINT AS elevation FROM parsed p
  LEFT JOIN (SELECT latitude, longitude, arg_min(elevation, position) AS elevation FROM (
      SELECT w.latitude, w.longitude, k.position, k.elevation
      FROM (SELECT DISTINCT latitude, longitude FROM parsed WHERE elevation IS NULL) w
      JOIN (SELECT c_custkey AS position, (c_custkey * 7) % 3000 AS elevation,
                   25.0::DOUBLE + ((c_custkey * 37) % 120)::DOUBLE / 10.0::DOUBLE + 0.000004::DOUBLE AS lat2,
                   -110.0::DOUBLE + ((c_custkey * 53) % 210)::DOUBLE / 10.0::DOUBLE - 0.000004::DOUBLE AS lon2
            FROM customer WHERE c_custkey % 97 <> 0) k
        ON abs(w.latitude - k.lat2) <= 0.00001 AND abs(w.longitude - k.lon2) <= 0.00001)
    GROUP BY latitude, longitude) f ON p.elevation IS NULL AND p.latitude = f.latitude AND p.longitude = f.longitude
  WHERE coalesce(p.elevation, f.elevation) IS NOT NULL""")
def fill_elevation(spark, sf):
    rows = EL.fill_elevation(A.parsed_observations(spark, sf), A.elevation_lookup(spark, sf))
    return rows.select("example_id", "elevation")
