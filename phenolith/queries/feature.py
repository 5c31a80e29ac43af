"""Fitting and applying vocabularies, scalers and weather features."""

from pyspark.sql import functions as F

from phenolith import adapters as A
from phenolith.operators import features as FE
from phenolith.operators import models as M
from phenolith.plans.enrich import enrich
from phenolith.queries import query
from phenolith.schema import SCALED_COLUMNS, VOCABULARY_COLUMNS
from phenolith.session import write_once


def enriched(spark, sf):
    """Enriched rows, written once to the shared folder since fit and apply both read them."""
    return write_once(enrich(A.parsed_observations(spark, sf), A.readings(spark, sf), A.stations(spark, sf)), "enriched")


def _total(c):
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)


@query("SELECT feature, token, n, id FROM vocab")
def fit_vocabularies(spark, sf):
    return FE.fit_vocabularies(enriched(spark, sf))


@query("SELECT * FROM scaler")
def fit_minmax(spark, sf):
    return FE.fit_minmax(enriched(spark, sf))


@query("SELECT feature, max(id) AS max_id FROM vocab GROUP BY feature")
def domain_max(spark, sf):
    return FE.domain_max(FE.fit_vocabularies(enriched(spark, sf)))


IDS_SQL = "SELECT t.example_id, {columns} FROM vocab_tokens t JOIN vocab v ON t.feature = v.feature AND t.token = v.token GROUP BY t.example_id".format(
    columns=", ".join(f"max(v.id) FILTER (WHERE v.feature = '{c}') AS {c}" for c in VOCABULARY_COLUMNS))


@query(IDS_SQL)
def string_to_int(spark, sf):
    rows = enriched(spark, sf)
    state = FE.fitted(FE.fit_vocabularies(rows), FE.fit_minmax(rows))
    wide = FE.token_levels(rows).select("example_id", *VOCABULARY_COLUMNS)
    return FE.lookup_vocabulary(wide, state, VOCABULARY_COLUMNS).select("example_id", *VOCABULARY_COLUMNS)


@query(IDS_SQL, name="lookup_vocabulary_by_join")
def lookup_vocabulary_by_join(spark, sf):
    """The same ids by a join for each column, as rows of a stream are looked up."""
    rows = enriched(spark, sf)
    wide = FE.token_levels(rows).select("example_id", *VOCABULARY_COLUMNS)
    vocabulary = write_once(FE.fit_vocabularies(rows), "vocabulary")  # each of 19 joins would number it again
    return FE._lookup_by_column(wide, vocabulary, VOCABULARY_COLUMNS, dict.fromkeys(VOCABULARY_COLUMNS, 0))


@query("""SELECT s.example_id, round(any_value((m.elevation - c.elevation_min) / (c.elevation_max - c.elevation_min)), 4) AS elevation,
    round(sum(min_s), 4) AS min_temp, round(sum(max_s), 4) AS max_temp, round(sum(day_s), 4) AS daylight, round(sum(prcp_s), 4) AS precipitation
  FROM scaled_win s JOIN matched m ON m.example_id = s.example_id JOIN scaler c ON true GROUP BY s.example_id""")
def scale_to_0_1(spark, sf):
    rows = enriched(spark, sf)
    done = FE.scale_to_0_1(rows, FE.fit_minmax(rows).first().asDict())
    return done.select(
        "example_id", *[F.round(F.col(c) if c == "elevation" else _total(c), 4).alias(c) for c in SCALED_COLUMNS])


@query("SELECT example_id, round(min(max_s - min_s), 4) AS lowest, round(max(max_s - min_s), 4) AS highest FROM scaled_win GROUP BY 1")
def temp_difference(spark, sf):
    rows = enriched(spark, sf)
    done = FE.scale_to_0_1(rows, FE.fit_minmax(rows).first().asDict())
    d = done.select("example_id", FE.temp_difference().alias("d"))
    return d.select("example_id", F.round(F.array_min("d"), 4).alias("lowest"), F.round(F.array_max("d"), 4).alias("highest"))


@query("SELECT example_id, round(min((max_s + min_s) / 2), 4) AS lowest, round(max((max_s + min_s) / 2), 4) AS highest FROM scaled_win GROUP BY 1")
def avg_temp(spark, sf):
    rows = enriched(spark, sf)
    done = FE.scale_to_0_1(rows, FE.fit_minmax(rows).first().asDict())
    d = done.select("example_id", FE.avg_temp().alias("d"))
    return d.select("example_id", F.round(F.array_min("d"), 4).alias("lowest"), F.round(F.array_max("d"), 4).alias("highest"))


@query("SELECT example_id, count(*)::INTEGER AS days, sum(max_temp)::DOUBLE AS max_temp FROM win WHERE pos >= 48 GROUP BY 1")
def head_slice(spark, sf):
    """The series without its 48 oldest days."""
    cut = enriched(spark, sf).select("example_id", FE.head_slice("max_temp", 48).alias("s"))
    return cut.select("example_id", F.size("s").alias("days"), _total("s").alias("max_temp"))


def _chunk_sql(value: str, days: int, first: int, name: str) -> str:
    last = 120 // days - 1
    mean = f"sum({value}) FILTER (WHERE pos // {days} = {{k}}) / {days}"
    return (
        f"count(DISTINCT pos // {days}) FILTER (WHERE pos // {days} >= {first})::INTEGER AS {name}_n, "
        f"round({mean.format(k=first)}, 4) AS {name}_first, round({mean.format(k=last)}, 4) AS {name}_last, "
        f"round(sum({value}) FILTER (WHERE pos // {days} >= {first}) / {days}, 4) AS {name}_sum")


def _chunks(c):
    return [
        F.size(c).alias(f"{c}_n"), F.round(F.element_at(c, 1), 4).alias(f"{c}_first"),
        F.round(F.element_at(c, -1), 4).alias(f"{c}_last"), F.round(_total(c), 4).alias(f"{c}_sum")]


CHUNK_SQL = ", ".join([
    _chunk_sql("(max_s + min_s) / 2", 3, 16, "avg_temp"), _chunk_sql("(max_s - min_s)", 3, 16, "temp_difference"),
    _chunk_sql("prcp_s", 3, 8, "precipitation"), _chunk_sql("day_s", 12, 0, "daylight")])


@query(f"SELECT example_id, {CHUNK_SQL} FROM scaled_win GROUP BY example_id")
def chunk_mean_slice(spark, sf):
    rows = enriched(spark, sf)
    done = FE.weather_features(FE.scale_to_0_1(rows, FE.fit_minmax(rows).first().asDict()))
    return done.select("example_id", *[x for c in FE.CHUNKED_FEATURES for x in _chunks(c)])


@query(f"""SELECT i.*, c.* EXCLUDE (example_id) FROM ({IDS_SQL}) i
  JOIN (SELECT example_id, {CHUNK_SQL} FROM scaled_win GROUP BY example_id) c ON c.example_id = i.example_id""")
def preprocess(spark, sf):
    """Fit on all rows, apply to them, derive the weather series."""
    done, _ = FE.preprocess(
        enrich(A.parsed_observations(spark, sf), A.readings(spark, sf), A.stations(spark, sf)), keep=("example_id",))
    return FE.weather_features(done).select(
        "example_id", *VOCABULARY_COLUMNS, *[x for c in FE.CHUNKED_FEATURES for x in _chunks(c)])


@query(f"""SELECT i.example_id, i.eco_biome, i.eco_num,
    ('0x' || left(md5(i.eco_biome::VARCHAR || '_X_' || i.eco_num::VARCHAR), 15))::BIGINT % greatest(b.n, 1) AS bucket
  FROM ({IDS_SQL}) i, (SELECT max(id) FILTER (WHERE feature = 'eco_biome') * max(id) FILTER (WHERE feature = 'eco_num') * 10 AS n FROM vocab) b""")
def crossed_bucket(spark, sf):
    """Hash buckets of the pair of eco ids."""
    done, state = FE.preprocess(
        enrich(A.parsed_observations(spark, sf), A.readings(spark, sf), A.stations(spark, sf)), keep=("example_id",))
    buckets = FE.crossed_bucket_count(state.sizes["eco_biome"] - 1, state.sizes["eco_num"] - 1)
    return done.select("example_id", "eco_biome", "eco_num", FE.crossed_bucket(buckets=buckets).alias("bucket"))


def _chunk_total(value: str, days: int, first: int) -> str:
    return f"sum({value}) FILTER (WHERE pos // {days} >= {first}) / {days}"


VECTOR_TOTAL = " + ".join([
    _chunk_total("(max_s + min_s) / 2", 3, 16), _chunk_total("(max_s - min_s)", 3, 16), _chunk_total("prcp_s", 3, 8), _chunk_total("day_s", 12, 0)])


@query(f"""SELECT i.example_id, 91 AS dense, 2 AS ids, i.s2_token_3, i.s2_token_4, round(c.total + e.elevation, 3) AS total
  FROM ({IDS_SQL}) i JOIN (SELECT example_id, {VECTOR_TOTAL} AS total FROM scaled_win GROUP BY example_id) c ON c.example_id = i.example_id
  JOIN (SELECT m.example_id, (m.elevation - s.elevation_min) / (s.elevation_max - s.elevation_min) AS elevation FROM matched m JOIN scaler s ON true) e ON e.example_id = i.example_id""")
def assemble_vector(spark, sf):
    """The numbers and ids that the network reads, without the label, from the columns that it needs alone: their count, sum and tokens."""
    rows = enriched(spark, sf)
    state = FE.fit(rows)
    done = FE.apply_transform(rows, state, keep=("example_id",))
    needed = FE.select_features(FE.drop_label_columns(done)).columns
    ready = M.model_input(done.select("example_id", *needed), state, label=False)
    return ready.select(
        "example_id", F.size("dense").alias("dense"), F.size("ids").alias("ids"), "s2_token_3", "s2_token_4", F.round(_total("dense"), 3).alias("total"))


@query("""SELECT 'category' AS label, count(*) AS n FROM (SELECT unnest(['eco_biome', 'eco_num', 'elevation', 'min_temp', 'max_temp', 'daylight', 'precipitation']
  || list_transform(range(17), lambda k: 's2_token_' || k::VARCHAR)))""")
def column_difference(spark, sf):
    """What transformed rows have beside the label, by name, with the labels of the rows that it is taken from."""
    rows = enriched(spark, sf)
    done = FE.apply_transform(rows, FE.fit(rows))
    bare = FE.drop_label_columns(done)
    gone = [c for c in done.columns if c not in bare.columns]
    return done.groupBy(F.lit(gone[0]).alias("label")).agg(F.lit(len(bare.columns)).cast("long").alias("n"))


@query("""SELECT feature, max(id) AS buckets, ceil(pow(max(id), 0.25::DOUBLE))::BIGINT AS size FROM vocab GROUP BY feature""")
def embedding_size(spark, sf):
    top = FE.domain_max(FE.fit_vocabularies(enriched(spark, sf)))
    return top.select("feature", F.col("max_id").alias("buckets"), FE.embedding_size("max_id").alias("size"))


@query(f"""SELECT example_id, CASE WHEN eco_biome < 5 THEN eco_biome ELSE 0 END AS eco_biome,
    CASE WHEN eco_num < 20 THEN eco_num ELSE 0 END AS eco_num FROM ({IDS_SQL})""")
def categorical_identity(spark, sf):
    """Ids beyond the bucket count fall to 0."""
    done, _ = FE.preprocess(
        enrich(A.parsed_observations(spark, sf), A.readings(spark, sf), A.stations(spark, sf)), keep=("example_id",))
    return done.select(
        "example_id", FE.categorical_identity("eco_biome", 5).alias("eco_biome"), FE.categorical_identity("eco_num", 20).alias("eco_num"))
