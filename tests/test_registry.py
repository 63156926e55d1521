"""The driver contract, and parity of registered queries with their SQL on the smallest data."""

import os

import pytest

import __spark_entry__ as contract
from workload.check import compare
from workload.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test data is not here")

#: Cover each plan once; `python -m workload.check` runs all of them.
CHECKED = [
    "od_hourly", "od_month_totals", "zones", "companies", "population", "income", "od_quality",
    "gravity_mismatch_large", "mismatch_histogram_truncated", "hourly_distribution",
    "in_out_distribution", "flow_quantile_class", "pending_files", "url_batches",
    "merge_null_safe", "stream_ingest", "day_table", "refresh_days", "stream_and_batch",
    "merge_null_safe_filtered", "upsert_buckets", "refresh_versions", "version_before_refresh", "refresh_typical_day", "refresh_quality",
    "stream_hourly", "stream_late_rows", "zone_functional_type",
    "population_from_documents", "id_value_files", "profile_chain", "rhythm_scaled", "zone_label", "random_sample", "top_origins_holed",
]


def test_every_oracle_has_its_query():
    queries, oracle = contract.queries(), contract.oracle_sql()
    assert set(oracle) <= set(queries)
    assert sorted(set(QUERIES) - set(oracle)) == []


@needs_data
def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["origin", "total_trips"]
    assert 0 < df.count() <= 10


@needs_data
@pytest.mark.parametrize("name", CHECKED)
def test_parity(spark, name):
    for _, verdict, count, _ in compare(spark, SMALL, [name]):
        assert verdict == "ok" and count > 0
