from __future__ import annotations

import pytest

import __spark_entry__ as registered
from conftest import SF
from millrace.plans import queries
from millrace.plans.oracle import oracle as all_sql
from millrace.plans.queries import QUERIES
from oracle_check import differences, open_oracle

MIDDLE = "/root/testdata/sf0.01"

# Rows of the derived feed at the middle scale factor.
MEASURED = {"raw_feed_count": 10_986, "clean_count": 4_197, "distinct_event_ids": 3_810}


SAME_TYPE = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(all_sql())
    assert set(QUERIES) <= set(registered.queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    found = registered.queries()[name](spark, SF)
    sql = registered.oracle_sql()[name]
    types = {row[0]: SAME_TYPE[row[1]] for row in oracle.execute(f"DESCRIBE {sql}").fetchall()}
    assert dict(found.dtypes) == types
    expected = oracle.execute(sql)
    columns = [column[0] for column in expected.description]
    assert not differences(found.collect(), expected.fetchall(), found.columns, columns)


@pytest.mark.parametrize("name", sorted(MEASURED))
def test_measured_counts(spark, name):
    assert registered.queries()[name](spark, MIDDLE).first()["n"] == MEASURED[name]


def test_entry(spark):
    assert {row.action for row in registered.entry(spark).collect()} == {"view", "purchase"}


def test_no_query_pairs_all_rows(spark):
    for name in ("clean_events", "dedup_events", "constraint_audit", "rejected_events"):
        plan = registered.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name, rows", [("reject_drift", 40), ("mixed_headers", None)])
def test_feed_is_made_once_for_all_its_deliveries(spark, monkeypatch, name, rows):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    feed = queries.raw_feed(spark, SF)
    monkeypatch.setattr(queries, "raw_feed", lambda *_: feed.mapInArrow(counted, feed.schema))
    found = QUERIES[name](spark, SF).count()
    assert found == rows if rows else found
    assert made.value == feed.count()
