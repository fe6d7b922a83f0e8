"""Plans whose tasks and shuffles do not outgrow their input."""

import re

import pytest
from pyspark.sql import Row

from ledgerlens import session
from ledgerlens.operators import history
from ledgerlens.plans import catalog, fixtures
from ledgerlens.sources import tables as io
from tests.conftest import SF_SMALL


def _text(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_buckets_follow_the_rows(spark, monkeypatch):
    assert io.bucket_count(spark.range(10)) == 8
    assert io.bucket_count(spark.range(10_000_001)) == 21
    monkeypatch.setattr(io, "bucket_count", lambda df: 11)
    df = catalog.bucketed_contracts(spark, catalog.Fixtures(spark, SF_SMALL).contracts)
    assert "11 out of 11" in _text(df.groupBy("environment", "accountcode").count())


@pytest.fixture(scope="module")
def twice(spark):
    """Driver tables with customers and parts listed twice, and keys that match nothing."""
    found = {n: spark.read.parquet(f"{SF_SMALL}/{n}.parquet") for n in ("lineitem", "orders", "customer", "part")}
    again = {"customer": "c_custkey % 5 = 1", "part": "p_partkey % 7 = 2", "orders": "o_orderkey % 11 = 3"}
    found = {n: df.unionAll(df.where(again[n])) if n in again else df for n, df in found.items()}
    found["customer"] = found["customer"].where("c_custkey % 13 <> 4")
    return found


@pytest.mark.parametrize("view", ["contract_lines", "snapshot"])
def test_join_order_gives_the_same_rows(spark, twice, view):
    def run(engine):
        made = dict(twice)
        for name in fixtures._dependency_order([view]):
            text, deps = fixtures.VIEWS[name]
            made[name] = spark.sql(fixtures._text(text, engine), **{d: made[d] for d in deps})
        return made[view]

    ours, plain = run("spark"), run("duckdb")
    assert ours.schema.names == plain.schema.names and plain.count() > 0
    assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()


def test_lines_are_joined_to_no_customer(spark):
    for view in ("contract_lines", "snapshot"):
        plan = catalog.Fixtures(spark, SF_SMALL)[view]._jdf.queryExecution().optimizedPlan().toString()
        joins = re.findall(r"Join Inner, \((.*?)\)\n", plan)
        assert joins and not any("l_" in j and "c_custkey" in j for j in joins), joins
        assert all(("o_custkey" in j) == ("c_custkey" in j) for j in joins), joins


def test_settings_keep_what_the_owner_set(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(name)
    catalog.QUERIES["LOAD-0"](spark, SF_SMALL)
    assert spark.conf.get(name) == session.TASK_CONF[name]
    spark.conf.set(name, "9000")
    session.small_tasks(spark)
    assert spark.conf.get(name) == "9000"
    spark.conf.unset(name)


@pytest.mark.parametrize("query", ["ACS-11", "ACS-14", "ADC-14"])
def test_steps_read_stored_lines(spark, query):
    assert "lineitem.parquet" not in _text(catalog.QUERIES[query](spark, SF_SMALL))


def test_code_lists_are_broadcast(spark):
    fx = catalog.Fixtures(spark, SF_SMALL)
    summary = spark.createDataFrame([Row(accountid="a", environment="NL", accountcode="1")])
    groups = history.history_groups(fx.contracts, summary, fx["contracteventtypes"], fx["itemclassifications"])
    assert groups._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast") >= 2
