"""Newest enriched files in, fitted transform out."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.operators.observations import with_length_reasons
from phenolith.schema import ENRICHED_SCHEMA, TOKEN_LEVELS, WEATHER_COLUMNS, WEATHER_DAYS
from phenolith.session import write_once
from phenolith.sinks.catalogue import read_newest
from phenolith.sinks.state import write_transform_state


def fixed_shapes() -> dict[str, int]:
    return {"s2_tokens": TOKEN_LEVELS, **{c: WEATHER_DAYS for c in WEATHER_COLUMNS}}


def newest_rows(spark, root: str, kinds: list[str] | None = None) -> DataFrame:
    """Enriched rows of the newest published version of every category (random: of the kind); older versions are not opened."""
    return read_newest(spark, root, ENRICHED_SCHEMA, kinds)


def run_fit(rows: DataFrame, root: str, version: str | None = None) -> str:
    """Check shapes, fit on all rows of the declared shapes, write the state; returns its path.

    The rows are written once and read twice. Rows of another shape are rejects, with a reason per wrong column, in the folder ``rejects`` of the state.
    """
    judged = write_once(with_length_reasons(rows, fixed_shapes()), "enriched")
    path = write_transform_state(judged.where(F.size("reasons") == 0).drop("reasons"), root, version)
    judged.where(F.size("reasons") > 0).write.mode("overwrite").parquet(f"{path}/rejects")
    return path
