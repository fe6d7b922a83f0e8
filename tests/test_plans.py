"""Plan-shape checks: no cross products or nested-loop joins, no Python UDFs,
pushed-down filters, no windows in the fused summary, bounded broadcasts."""

import pytest

import __spark_entry__ as entry
from ledgerlens.plans import catalog
from tests.conftest import SF_SMALL

# these write data while being built
SKIP = {"SRC-2", "SNK-1", "SNK-2", "SNK-3", "SNK-4", "LAL-ALL-dest", "NAD-6", "ADC-ALL"} | {
    n for n in catalog.QUERIES if n.startswith(("LOAD-ALL-", "JOB-"))}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SKIP))
def test_no_cross_products_or_python(spark, name):
    p = plan_of(entry.queries()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, f"{name}: {bad}"


def test_fused_summary_has_no_window(spark):
    p = plan_of(entry.queries()["ACS-ALL"](spark, SF_SMALL))
    assert "Window" not in p


def _nodes(node):
    """Walk an executed (adaptive) plan, descending into query stages."""
    yield node
    name = node.nodeName()
    if "QueryStage" in name or name == "AdaptiveSparkPlan":
        inner = node.plan() if "QueryStage" in name else node.executedPlan()
        yield from _nodes(inner)
        return
    if name == "ReusedExchange":
        yield from _nodes(node.child())
        return
    children = node.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def executed(df):
    """The final adaptive plan, after all rows were computed."""
    df._jdf.queryExecution().executedPlan().executeCollect()
    root = df._jdf.queryExecution().executedPlan()
    assert "isFinalPlan=true" in root.toString()
    return root


def test_no_window_over_an_account_month(spark):
    for name in ("ASM-ALL", "ACS-ALL"):
        names = [n.nodeName() for n in _nodes(executed(catalog.QUERIES[name](spark, SF_SMALL)))]
        assert "Window" not in names and not any("RoundRobin" in n or n == "Repartition" for n in names), name


def hot_account(spark):
    """Contracts of which one account holds a third of the lines, on few days."""
    from pyspark.sql import functions as F

    from ledgerlens.plans.fixtures import Fixtures

    fx = Fixtures(spark, SF_SMALL)
    one = fx.accounts.orderBy("environment", "accountcode").first()
    third = F.pmod(F.hash("contractnumber", "itemcode", "quantity"), F.lit(3)) == 0
    lines = fx.contracts.withColumns({
        "environment": F.when(third, F.lit(one["environment"])).otherwise(F.col("environment")),
        "accountcode": F.when(third, F.lit(one["accountcode"])).otherwise(F.col("accountcode")),
        "eventdate": F.when(third, F.to_date(F.concat(F.lit("2023-0"), F.pmod(F.length("item"), F.lit(9)) + 1, F.lit("-10")))).otherwise(F.col("eventdate"))})
    return fx, lines


@pytest.mark.parametrize("job", ["timeline", "history"])
def test_windows_see_days_not_lines(spark, job):
    """With a hot account, each window's input is no longer than the account-days."""
    from ledgerlens.operators import history, summary, timeline
    from ledgerlens.plans.fixtures import AS_OF, LINK_CUTOFF

    fx, lines = hot_account(spark)
    s = summary.contract_summary(lines, fx.accounts, fx.log, AS_OF, LINK_CUTOFF)
    if job == "timeline":
        df = timeline.contract_activity(lines, fx.log, s, fx.accounts, LINK_CUTOFF, checkpoint=False)
    else:
        df = history.contract_history(lines, s, fx["contracteventtypes"], fx["itemclassifications"], AS_OF, checkpoint=False)
    days = lines.select("environment", "accountcode", "eventdate").distinct().count() + 2 * fx.accounts.count()
    windows = [n for n in _nodes(executed(df)) if n.nodeName() == "Window"]
    assert windows
    for w in windows:
        rows = [n.metrics().apply("numOutputRows").value() for n in _nodes(w) if n.metrics().contains("numOutputRows")]
        assert rows and rows[0] <= days < lines.count() / 2, (rows[:1], days)


def test_timeline_reads_the_contracts_once(spark, tmp_path):
    from ledgerlens.operators import timeline
    from ledgerlens.plans.fixtures import LINK_CUTOFF, Fixtures

    fx = Fixtures(spark, SF_SMALL)
    fx.contracts.write.parquet(f"{tmp_path}/contracts")
    catalog.summary_df(spark, SF_SMALL).write.parquet(f"{tmp_path}/summary")
    c, s = spark.read.parquet(f"{tmp_path}/contracts"), spark.read.parquet(f"{tmp_path}/summary")
    plan = timeline.contract_activity(c, fx.log, s, fx.accounts, LINK_CUTOFF)._jdf.queryExecution().toString()
    assert f"{tmp_path}/contracts" not in plan  # read once, when the groups were written


def test_filters_pushed_to_scan(spark):
    df = entry.queries()["SRC-2"](spark, SF_SMALL)
    p = plan_of(df)
    assert "PartitionFilters" in p and "ingestionday" in p
