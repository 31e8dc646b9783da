"""Every registered query against its SQL in DuckDB, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as entry_module
from harness import ROOT, SMALL, bad_shape, compare, duck, plan_text

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    problem, _, _ = compare(spark, con, QUERIES[name], ORACLES[name], SMALL)
    assert problem is None


# the text operators have tests of their own
@pytest.mark.parametrize("name", sorted(n for n in set(QUERIES) - set(ORACLES) if n != "pipeline" and not re.match(r"op\d+_", n)))
def test_query_without_sql_has_rows(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert bad_shape(plan_text(df)) is None
    assert df.collect()


def test_entry(spark):
    assert entry_module.entry(spark).count() == 1


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_scans_are_pruned(spark):
    text = plan_text(QUERIES["calibrate_grid"](spark, SMALL))
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schema and all(set(s.split(":")[0] for s in part.split(",")) <= {"event_type", "value"} for part in schema)
    assert "PushedFilters: [IsNotNull(value)]" in text


def test_sources_name_no_foreign_paths():
    for path in (ROOT / "flowlens").rglob("*.py"):
        assert "localCheckpoint" not in path.read_text()
