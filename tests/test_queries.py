"""Queries against their SQL oracles on the smallest tables.

``compare.py`` runs all of them; here one query stands for each kind.
"""

import pytest

import __spark_entry__ as entry
from compare import difference, oracle_connection

FOLDER = "/root/testdata/sf0.001"
KINDS = """field_extract_ignore_case blank_to_null safe_int safe_decimal safe_timestamp
record_hash period_match dq_status first_copies trips_staged trips_clean zones_clean
dim_date fct_trips agg_monthly_kpis dq_summary check_relationships check_audit_match
audit_listing raw_capture provenance folder_period same_names file_manifest zone_reload header_contract signature_check period_list""".split()


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", KINDS)
def test_query_equals_oracle(spark, connection, name):
    assert difference(spark, connection, FOLDER, name) == ""


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    plain = {n for n in entry.queries() if not n.startswith("op") and n != "pipeline"}
    assert plain <= set(entry.oracle_sql()) and len(plain) >= 61


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0 and rows.columns[0] == "source_period"
