"""Sinks, written to the shared folder and read back."""

from pyspark.sql import functions as F

from phenolith import adapters as A
from phenolith.functions import columns as X
from phenolith.operators import features as FE
from phenolith.operators import observations as O
from phenolith.plans import fit as FIT
from phenolith.plans import teach as T
from phenolith.plans.enrich import PUBLISHED_SCHEMA, run_enrich
from phenolith.queries import query
from phenolith.queries.counting import SPLIT_SQL, _split
from phenolith.queries.feature import enriched
from phenolith.queries.sql import ROUTING
from phenolith.schema import WEATHER_COLUMNS
from phenolith.session import scratch_path, write_once
from phenolith.sinks import catalogue as C
from phenolith.sinks import state as ST
from phenolith.sinks import writers as W

VERSION = "1700000000"


@query(f"""SELECT CASE WHEN c LIKE 'random-%' THEN 'random' ELSE 'occurrences' END AS kind,
    CASE WHEN c LIKE 'random-%' THEN '{VERSION}' ELSE c END AS part_a,
    CASE WHEN c LIKE 'random-%' THEN split_part(c, '-', 2) ELSE '{VERSION}' END AS part_b, count(*) AS n
  FROM (SELECT {ROUTING} AS c FROM obs) GROUP BY ALL""")
def write_by_category(spark, sf):
    root = scratch_path(spark, "by-category")
    for _ in range(2):  # a version that is written again replaces itself
        W.write_by_category(A.observations(spark, sf), root, VERSION)
    back = W.read_by_category(spark, root)
    return back.groupBy(*[F.col(c).cast("string").alias(c) for c in W.LAYOUT]).agg(F.count("*").alias("n"))


@query("""WITH odd AS (SELECT p.*, unnest(CASE WHEN regexp_matches(p.example_id, '7$') THEN [1, 2, 3] ELSE [1] END) AS copy FROM parsed p),
  judged AS (SELECT o.*, m.example_id IS NOT NULL AS found, g.example_id IS NOT NULL AS good FROM odd o
    LEFT JOIN (SELECT DISTINCT example_id FROM matched) m ON o.example_id = m.example_id LEFT JOIN (SELECT DISTINCT example_id FROM obs) g ON o.example_id = g.example_id)
  SELECT reason, count(*) AS n, count(copied) AS ids FROM (
    SELECT CASE WHEN NOT good THEN 'invalid' WHEN copy = 3 OR NOT found THEN 'no_complete_station' ELSE 'written' END AS reason,
      CASE WHEN copy <> 2 THEN example_id END AS copied FROM judged) GROUP BY reason""")
def enrich_accounting(spark, sf):
    """Every parsed row is either written or a reject of the job, once: also where an id stands for three rows, one without id and one far from all stations."""
    root = scratch_path(spark, "accounting")
    copies = F.explode(F.when(F.col("example_id").endswith("7"), F.array(*map(F.lit, (1, 2, 3)))).otherwise(F.array(F.lit(1))))
    odd = A.parsed_observations(spark, sf).withColumn("copy", copies).withColumns({
        "example_id": F.when(F.col("copy") != 2, F.col("example_id")),
        "latitude": F.when((F.col("copy") == 3) & (F.col("latitude") != 0), F.lit(-60.0)).otherwise(F.col("latitude"))})
    # Random rows are routed by their ids; those without one get the category of an occurrence.
    kept = odd.withColumn("category", F.when(F.col("example_id").isNull(), F.lit("u1")).otherwise(F.col("category")))
    run_enrich(kept, A.readings(spark, sf), A.stations(spark, sf), root, VERSION)
    own = ("year", "no_complete_station", "category_unroutable", "no_daylight")
    first = F.element_at("reasons", 1)
    rejects = C.read_version(spark, root, PUBLISHED_SCHEMA, VERSION, rejects=True).select("example_id", F.when(first.isin(*own), first).otherwise("invalid").alias("reason"))
    written = C.read_version(spark, root, PUBLISHED_SCHEMA, VERSION).select("example_id", F.lit("written").alias("reason"))
    return written.unionByName(rejects).groupBy("reason").agg(F.count("*").alias("n"), F.count("example_id").alias("ids"))


@query(f"""WITH every AS (
    SELECT 'first' AS version, CASE WHEN category = 'random' THEN 'random' ELSE 'occurrences' END AS kind, CASE WHEN category <> 'random' THEN category ELSE '' END AS owner, example_id FROM obs
    UNION ALL SELECT 'second', 'occurrences', category, example_id FROM obs WHERE category IN ('u0', 'u3')
    UNION ALL SELECT 'second', 'random', '', example_id FROM obs WHERE category = 'random' AND example_id LIKE '%1'
    UNION ALL SELECT 'first', 'protected_areas', d, s2_tokens[16] FROM areas, (VALUES ('19980106'), ('19980109')) t(d)
    UNION ALL SELECT 'second', 'protected_areas', '19980109', s2_tokens[16] FROM areas),
  newest AS (SELECT kind, owner, max(version) AS version FROM every GROUP BY kind, owner)
  SELECT kind, owner, version, count(*) AS n, count(DISTINCT example_id) AS ids FROM every JOIN newest USING (kind, owner, version) GROUP BY ALL""")
def union_file_sets(spark, sf):
    """Two versions of three kinds, written and published; the second has some of the owners. The newest rows of all owners are read back."""
    root = scratch_path(spark, "file-sets")
    own = ["example_id", "category"]
    obs = write_once(A.observations(spark, sf).select(*own), "observations")  # both versions read them
    areas = O.explode_area_dates(A.areas(spark, sf).withColumn("obs_date", F.lit(None).cast("date")).drop("obs_date"), "19980106,19980109")
    areas = write_once(areas.select(*own, "date_string"), "areas")
    later = obs.where("category in ('u0', 'u3') or (category = 'random' and example_id like '%1')")
    for version, rows in (("first", obs.select(*own).unionByName(areas.select(*own))), ("second", later.select(*own).unionByName(areas.where("date_string = '19980109'").select(*own)))):
        laid = W.with_layout(rows.withColumn("routing_category", X.routing_category()), version).select(*own, *W.LAYOUT)
        attempt = C.new_attempt(version)
        C.stage(laid, root, attempt)
        C.publish(spark, root, attempt, obs.select(*own).schema)
    newest = C.newest_parts(C.parts(spark, root))
    back = C.read_parts(spark, root, obs.select(*own).schema, newest)
    owner, version = F.when(F.col("kind") == "random", "").otherwise(F.col("part_a")), F.when(F.col("kind") == "random", F.col("part_a")).otherwise(F.col("part_b"))
    return back.groupBy("kind", owner.alias("owner"), version.alias("version")).agg(F.count("*").alias("n"), F.count_distinct("example_id").alias("ids"))


@query(f"SELECT split, count(*) AS n, min(example_id) AS first_id FROM ({SPLIT_SQL}) GROUP BY split")
def write_split(spark, sf):
    root = scratch_path(spark, "split")
    W.write_split(_split(spark, sf), root)
    return spark.read.parquet(root).groupBy("split").agg(F.count("*").alias("n"), F.min("example_id").alias("first_id"))


@query(f"SELECT split, category, count(*) AS n FROM ({SPLIT_SQL}) GROUP BY ALL")
def write_shuffled_records(spark, sf):
    root = scratch_path(spark, "shuffled")
    W.write_shuffled(_split(spark, sf), root, 1)
    return spark.read.parquet(root).groupBy("split", "category").agg(F.count("*").alias("n"))


@query(f"SELECT split, count(*) AS n FROM ({SPLIT_SQL}) GROUP BY split")
def write_counts(spark, sf):
    path = scratch_path(spark, "counts")
    W.write_counts(_split(spark, sf), path)
    return spark.read.schema("split string, n long").csv(path)


@query("""SELECT 'usage' AS name, columns, slice_index, round(max_accuracy, 6) AS max_accuracy, round(label_mean, 6) AS label_mean
  FROM grid g JOIN rollup r ON g.experiment_id = r.experiment_id""")
def write_experiment_tsv(spark, sf):
    path = scratch_path(spark, "experiments")
    W.write_experiment_tsv(T.report(spark, A.eval_runs(spark, sf), "usage", VERSION), path)
    schema = (
        "name string, ts string, columns string, days_removed long, slice_index long, shape long, days int, first_day long, days_used long, "
        "max_precision_recall double, max_accuracy double, min_average_loss double, max_auc double, label_mean double, prediction_mean double")
    back = spark.read.schema(schema).option("sep", "\t").csv(path)
    return back.select("name", "columns", "slice_index", F.round("max_accuracy", 6).alias("max_accuracy"), F.round("label_mean", 6).alias("label_mean"))


@query("SELECT feature, token, n, id FROM vocab")
def write_transform_state(spark, sf):
    """Enrich, write by category, choose the newest rows, fit, save, find the newest state and read it."""
    root = scratch_path(spark, "lifecycle")
    parsed = A.parsed_observations(spark, sf)
    run_enrich(parsed, A.readings(spark, sf), A.stations(spark, sf), f"{root}/rows", VERSION)
    rows = FIT.newest_rows(spark, f"{root}/rows")
    FIT.run_fit(rows.select(*O.OBSERVATION_COLUMNS, *WEATHER_COLUMNS), root, VERSION)
    return ST.read_transform_state(spark, ST.latest_transform_state(spark, root)).vocabulary.select("feature", "token", "n", "id")


@query("""SELECT m.category, count(*) AS n, round(avg((m.elevation - c.elevation_min) / (c.elevation_max - c.elevation_min)), 4) AS elevation
  FROM matched m JOIN scaler c ON true GROUP BY m.category""")
def apply_saved_transform(spark, sf):
    """A saved state applied to rows that are read later."""
    root = scratch_path(spark, "state")
    rows = enriched(spark, sf)
    path = ST.write_transform_state(rows, root, VERSION)
    done = FE.apply_transform(rows, ST.read_transform_state(spark, path))
    return done.groupBy("category").agg(F.count("*").alias("n"), F.round(F.avg("elevation"), 4).alias("elevation"))
