"""Registered queries against their SQL in DuckDB on the same tables."""

import importlib.util
import os

import pytest

from phenolith.queries import load

SF = "/root/testdata/sf0.001"
spec = importlib.util.spec_from_file_location("check", os.path.join(os.path.dirname(__file__), "..", "tools", "check.py"))
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)

# Each of these enriches all rows first; the ones left are covered by the check tool at every scale.
SLOW = {
    "domain_max", "embedding_size", "categorical_identity", "string_to_int", "lookup_vocabulary_by_join", "scale_to_0_1", "temp_difference",
    "avg_temp", "head_slice", "apply_saved_transform", "write_shuffled_records", "write_counts", "write_split"}
NAMES = [n for n, q in load().items() if q.sql and n not in SLOW]


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, con, name):
    q = load()[name]
    status, _, _, _, note = check.compare(spark, con, name, q.run, q.sql, SF)
    assert status == "ok", note
