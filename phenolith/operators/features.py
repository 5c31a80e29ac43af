"""Vocabularies, scalers and weather features: fitted on all rows, applied to any rows."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolith.operators.numbering import number_rows
from phenolith.schema import SCALED_COLUMNS, TOKEN_COLUMNS, TOKEN_LEVELS, VOCABULARY_COLUMNS, WEATHER_DAYS
from phenolith.session import by_shuffle, write_once


# --- fitting -------------------------------------------------------------------------------------


def token_levels(df: DataFrame, tokens: str = "s2_tokens") -> DataFrame:
    """The token array as one column per level."""
    return df.selectExpr(
        *[c for c in df.columns if c != tokens],
        *[f"try_element_at({tokens}, {k + 1}) as {TOKEN_COLUMNS[k]}" for k in range(TOKEN_LEVELS)])


def vocabulary_counts(df: DataFrame) -> DataFrame:
    """Frequency of every token of every vocabulary column.

    Rows are first folded to distinct places (token array and eco codes), so only places are multiplied by the
    number of columns.
    """
    places = df.groupBy("s2_tokens", "eco_biome", "eco_num").agg(F.count("*").alias("_n"))
    entries = ", ".join(f"named_struct('feature', '{c}', 'token', {c})" for c in VOCABULARY_COLUMNS)
    long = token_levels(places).selectExpr("_n", f"inline(array({entries}))").where("token is not null")
    return long.groupBy("feature", "token").agg(F.sum("_n").alias("n"))


def fit_vocabularies(df: DataFrame) -> DataFrame:
    """``feature, token, n, id``: ids from 0 by falling count, ties by falling token."""
    return number_rows(vocabulary_counts(df), [F.desc("n"), F.desc("token")], "id", group="feature")


def domain_max(vocabulary: DataFrame) -> DataFrame:
    """Largest id per column, used as its number of buckets."""
    return vocabulary.groupBy("feature").agg(F.max("id").alias("max_id"))


def fit_minmax(df: DataFrame) -> DataFrame:
    """One row with the global minimum and maximum of each scaled column, over all elements of an array."""
    arrays = dict(df.dtypes)
    stats = []
    for c in SCALED_COLUMNS:
        is_array = arrays[c].startswith("array")
        low, high = (F.array_min(c), F.array_max(c)) if is_array else (F.col(c), F.col(c))
        stats += [F.min(low).cast("double").alias(f"{c}_min"), F.max(high).cast("double").alias(f"{c}_max")]
    return df.agg(*stats)


@dataclass(frozen=True)
class FittedTransform:
    """What fitting leaves behind: a vocabulary table and ten numbers."""

    vocabulary: DataFrame
    scaler: dict
    sizes: dict


def fit(df: DataFrame) -> FittedTransform:
    return fitted(fit_vocabularies(df), fit_minmax(df))


def fitted(vocabulary: DataFrame, scaler: DataFrame) -> FittedTransform:
    """Bring the one scaler row and the 19 vocabulary sizes to the driver."""
    sizes = {r["feature"]: r["n"] for r in vocabulary.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    return FittedTransform(vocabulary, scaler.first().asDict(), sizes)


# --- applying ------------------------------------------------------------------------------------


def lookup_vocabulary(df: DataFrame, state: FittedTransform, columns: list[str], oov: str = "zero") -> DataFrame:
    """Replace tokens by ids.

    An unknown token gets 0, the id of the most frequent one, or with ``oov='separate'`` an id of its own after
    the last. The distinct combinations of tokens, places as a rule, meet the vocabulary once in long form, and the rows meet what was
    found once, however many columns there are; Catalyst and AQE choose the joins by what they see. Rows of a stream can't be folded to distinct
    ones without state, so each column is a join of its own with the saved table there.
    """
    if oov not in ("zero", "separate"):
        raise ValueError(f"unknown oov rule {oov}")
    missing = {c: 0 if oov == "zero" else state.sizes.get(c, 0) for c in columns}
    return (_lookup_by_column if df.isStreaming else _lookup_places)(df, state.vocabulary, columns, missing)


def _lookup_by_column(df: DataFrame, vocabulary: DataFrame, columns: list[str], missing: dict) -> DataFrame:
    ids = [f"coalesce(v_{c}.id, {missing[c]}L) as {c}" for c in columns]
    others = [f"o.`{c}`" for c in df.columns if c not in columns]
    joins = [
        f"left join (select token, id from {{vocabulary}} where feature = '{c}') v_{c} on o.{c} = v_{c}.token" for c in columns]
    text = f"select {', '.join(others + ids)} from {{rows}} o {' '.join(joins)}"
    return df.sparkSession.sql(text, rows=df, vocabulary=vocabulary).select(*[F.col(f"`{c}`") for c in df.columns])


def _lookup_places(df: DataFrame, vocabulary: DataFrame, columns: list[str], missing: dict) -> DataFrame:
    pairs = ", ".join(f"named_struct('feature', '{c}', 'token', {c})" for c in columns)
    keyed = df.withColumn("_key", F.struct(*columns))
    found = (
        keyed.select("_key").distinct().select("_key", "_key.*").selectExpr("_key", f"inline(array({pairs}))")
        .join(by_shuffle(vocabulary.select("feature", "token", "id")), ["feature", "token"])
        .groupBy("_key").agg(F.expr("map_from_entries(collect_list(struct(feature, id)))").alias("_ids")))
    ids = {c: F.coalesce(F.try_element_at("_ids", F.lit(c)), F.lit(missing[c]).cast("long")) for c in columns}
    return keyed.join(found, "_key", "left").select(*[ids[c].alias(c) if c in ids else F.col(f"`{c}`") for c in df.columns])


def scaled(c: str, scaler: dict, is_array: bool) -> Column:
    low, high = float(scaler[f"{c}_min"]), float(scaler[f"{c}_max"])
    width = high - low
    if width == 0:  # a constant column scales to 0
        return F.transform(c, lambda x: F.lit(0.0)) if is_array else F.lit(0.0)
    if is_array:
        return F.transform(c, lambda x: (x - low) / width)
    return (F.col(c) - low) / width


def scale_to_0_1(df: DataFrame, scaler: dict, columns: list[str] = SCALED_COLUMNS) -> DataFrame:
    """Scale by the fitted minimum and maximum; the ten numbers are constants of the plan."""
    types = dict(df.dtypes)
    return df.withColumns({c: scaled(c, scaler, types[c].startswith("array")) for c in columns})


def apply_transform(df: DataFrame, state: FittedTransform, oov: str = "zero", keep: tuple = ()) -> DataFrame:
    """Category, ids of all tokens and codes, scaled numbers; other columns go, unless kept. Numbers are scaled after the lookup: as they were read they compress where rows are shuffled."""
    columns = list(dict.fromkeys([*keep, "category", *VOCABULARY_COLUMNS, *SCALED_COLUMNS]))
    found = lookup_vocabulary(token_levels(df).select(*columns), state, VOCABULARY_COLUMNS, oov)
    return scale_to_0_1(found, state.scaler).select(*columns)


def preprocess(df: DataFrame, oov: str = "zero", keep: tuple = ()) -> tuple[DataFrame, FittedTransform]:
    """Fit and apply on the same rows; the rows are written once and read twice."""
    rows = write_once(df, "enriched")
    state = fit(rows)
    return apply_transform(rows, state, oov, keep), state


# --- derived features ----------------------------------------------------------------------------


def temp_difference(max_temp: str = "max_temp", min_temp: str = "min_temp") -> Column:
    """Scaled maximum less scaled minimum per day; the two scales differ, so it can be negative."""
    return F.zip_with(max_temp, min_temp, lambda a, b: a - b)


def avg_temp(max_temp: str = "max_temp", min_temp: str = "min_temp") -> Column:
    return F.zip_with(max_temp, min_temp, lambda a, b: (a + b) / 2)


def head_slice(array: str, drop: int, length: int = WEATHER_DAYS) -> Column:
    """The array without its oldest ``drop`` values."""
    return F.slice(array, drop + 1, length - drop)


def chunk_count(days: int, pct: float | None = None, length: int = WEATHER_DAYS) -> tuple[int, int]:
    """Chunks in the series and how many of the oldest to drop."""
    chunks = length // days
    return chunks, int(chunks * pct + 0.5) if pct else 0


def _table(series: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray | None]:
    """The first ``length`` values of each list as a row, 0 where a list is shorter, and where values are null (None if nowhere)."""
    gone = series.is_null().to_numpy(zero_copy_only=False)
    sizes = series.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = series.flatten()
    numbers = (values.fill_null(0.0) if values.null_count else values).to_numpy(zero_copy_only=False)
    if not (values.null_count or gone.any()) and (sizes == length).all():
        return numbers.reshape(len(series), length), None
    row, place = np.repeat(np.arange(len(series)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = place < length
    out, unknown = np.zeros((len(series), length)), np.repeat(gone[:, None], length, axis=1)
    out[row[inside], place[inside]] = numbers[inside]
    unknown[row[inside], place[inside]] = values.is_null().to_numpy(zero_copy_only=False)[inside]
    return out, unknown


def chunk_mean_slice(array: str | Column, days: int, pct: float | None = None, length: int = WEATHER_DAYS) -> Column:
    """Means of consecutive chunks of days without the oldest share; dropped chunks are never computed.

    The mean of a chunk with a null is null, as are all of a null series, and days beyond the end of a series count as 0. Arrow batches, no state: a lambda a chunk and day took
    most of the time of the network's input.
    """
    chunks, first = chunk_count(days, pct, length)

    @F.arrow_udf("array<double>")
    def means(series: pa.Array) -> pa.Array:
        values, unknown = _table(series, length)
        parts = values[:, first * days : chunks * days].reshape(len(series), chunks - first, days)
        total = np.zeros(parts.shape[:2])
        for day in range(days):  # one after the other, as a sum over rows would go
            total += parts[:, :, day]
        total /= days
        gone = None if unknown is None else unknown[:, first * days : chunks * days].reshape(parts.shape).any(axis=2).ravel()
        ends = pa.array(np.arange(len(series) + 1) * (chunks - first), pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(total.ravel(), pa.float64(), mask=gone))

    return means(F.col(array).cast("array<double>") if isinstance(array, str) else array.cast("array<double>"))


# Days per chunk and dropped share of each weather feature.
CHUNKED_FEATURES = {
    "avg_temp": (3, 0.40),
    "temp_difference": (3, 0.40),
    "precipitation": (3, 0.20),
    "daylight": (12, None),
}


def weather_features(transformed: DataFrame) -> DataFrame:
    """Add the four chunked weather series to transformed rows."""
    df = transformed.withColumns({"avg_temp": avg_temp(), "temp_difference": temp_difference()})
    return df.withColumns({c: chunk_mean_slice(c, days, pct) for c, (days, pct) in CHUNKED_FEATURES.items()})


def crossed_bucket(biome: str = "eco_biome", num: str = "eco_num", buckets: int = 1) -> Column:
    """Hash bucket of the pair of eco ids: 60 bits of the md5 of both, modulo the number of buckets."""
    digest = F.md5(F.concat_ws("_X_", F.col(biome).cast("string"), F.col(num).cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(max(buckets, 1)).cast("long"))


def crossed_bucket_count(biome_buckets: int, num_buckets: int) -> int:
    return biome_buckets * num_buckets * 10


def categorical_identity(c: str, buckets: int) -> Column:
    """The id itself, or 0 outside the buckets."""
    return F.when((F.col(c) >= 0) & (F.col(c) < buckets), F.col(c)).otherwise(F.lit(0).cast("long"))


def embedding_size(buckets) -> Column:
    return F.ceil(F.pow(buckets, F.lit(0.25)))


def select_features(df: DataFrame) -> DataFrame:
    """Only what the model reads of transformed rows: the scaled columns, and the ids of its token levels and eco codes."""
    return df.select(*[c for c in (*SCALED_COLUMNS, "eco_num", "eco_biome", "s2_token_3", "s2_token_4") if c in df.columns])


def drop_label_columns(df: DataFrame, label: str = "category") -> DataFrame:
    return df.drop(label)
