"""Whole jobs and what they rest on: counted writes, named days, job stores, grouping sets, counted
history rows, rolled-up months, prefix scans, bucketed tables."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens import jobs, session
from ledgerlens.functions.prefix import prefix_scan
from ledgerlens.operators import history, links, loads, monthly, summary, timeline
from ledgerlens.plans import catalog
from ledgerlens.plans.fixtures import AS_OF, INGESTION_DAY, LINK_CUTOFF, Fixtures
from ledgerlens.plans.oracle_loads import CARD_TEMPLATES, PROFILE_PREFIX
from ledgerlens.sources import tables
from tests.conftest import SF_SMALL
from tests.test_plans import _nodes, executed

EMPTY_DAY = dt.date(2031, 5, 6)


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, SF_SMALL)


@pytest.fixture(scope="module")
def read(spark):
    return catalog._Tables(spark, SF_SMALL)


def rows(df):
    return sorted(map(repr, df.collect()))


def runs_of(spark, df, write):
    """How often the rows of ``df`` are produced by ``write(df)``."""
    times = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        times.add(1)
        yield from batches

    write(df.coalesce(1).mapInArrow(pass_on, df.schema))
    return times.value


# --- sinks ---------------------------------------------------------------------------
def test_nonempty_write_runs_the_plan_once(spark, tmp_path):
    df = spark.range(100)
    assert runs_of(spark, df, lambda x: tables.write_if_nonempty(x, tables.write_table, f"{tmp_path}/a")) == 1
    assert spark.read.parquet(f"{tmp_path}/a").count() == 100


def test_empty_write_leaves_what_is_there(spark, tmp_path):
    path = f"{tmp_path}/a"
    assert not tables.write_if_nonempty(spark.range(0), tables.write_table, path) and not os.path.exists(path)
    assert tables.write_if_nonempty(spark.range(3), tables.write_table, path)
    assert not tables.write_if_nonempty(spark.range(9).where("id < 0"), tables.write_table, path)
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmp_path) == ["a"]
    assert tables.write_if_nonempty(spark.range(5), tables.write_table, path) and spark.read.parquet(path).count() == 5


def test_a_named_day_is_replaced_also_by_nothing(spark, tmp_path):
    path, day, other = f"{tmp_path}/log", dt.date(2024, 1, 30), dt.date(2024, 1, 29)
    log = spark.createDataFrame([("a", other), ("b", day), ("c", day)], "k string, date date")
    assert tables.append_log(log, path) == 3
    assert tables.append_log(log.where("k = 'b'"), path, day=day) == 1
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == ["a", "b"]
    assert tables.append_log(log.where("false"), path, day=day) == 0
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == ["a"]
    assert tables.append_log(log.where("false"), path) == 0 and spark.read.parquet(path).count() == 1


def test_link_log_job_runs_the_diff_once(spark, fx, tmp_path):
    snapshot = fx["snapshot"]
    again = {}

    def job(x):
        again["log"] = links.linked_accountant_log(x, fx["previous_accounts"], AS_OF, INGESTION_DAY, dest=f"{tmp_path}/log")

    assert runs_of(spark, snapshot, job) == 1
    assert rows(again["log"]) == rows(links.linked_accountant_log(snapshot, fx["previous_accounts"], AS_OF, INGESTION_DAY))
    assert links.linked_accountant_log(snapshot, fx["previous_accounts"], AS_OF, EMPTY_DAY, dest=f"{tmp_path}/log").count() == 0
    assert not [x for x in os.listdir(f"{tmp_path}/log") if x.startswith("date=")]  # the day's earlier log is gone


# --- stores --------------------------------------------------------------------------
def test_two_jobs_at_once_keep_their_own_files(spark):
    one, two = session.JobStore(spark, "one"), session.JobStore(spark, "two")
    with two:
        with one:
            a, b = one.keep(spark.range(5), "x"), two.keep(spark.range(7), "x")
            assert a.count() == 5 and one.rows == {"x": 5}
        assert not os.path.exists(one.folder.removeprefix("file:")) and b.count() == 7
    assert not os.path.exists(two.folder.removeprefix("file:"))


@pytest.mark.parametrize("job, args, table", [
    (jobs.contract_activity, (LINK_CUTOFF,), "activitydaily_contracts"), (jobs.contract_history, (AS_OF,), "customerprofile_contracthistory"),
    (jobs.load_snapshot_tables, (INGESTION_DAY,), "resellers")])
def test_jobs_leave_no_intermediates(spark, read, tmp_path, job, args, table):
    stores = f"{session.ensure_checkpoint_dir(spark).removeprefix('file:')}/ledgerlens-jobs"
    before = set(os.listdir(stores)) if os.path.exists(stores) else set()
    options = {"cutoff": args[0]} if job is jobs.contract_activity else {}
    assert table in job(read, str(tmp_path), *(() if options else args), **options)
    assert set(os.listdir(stores)) == before
    assert spark.read.parquet(f"{tmp_path}/{table}").count() > 0


def test_empty_days_leave_what_was_published(spark, read, tmp_path):
    dest = str(tmp_path)
    assert jobs.load_raw_tables(read, dest, INGESTION_DAY) == ["appbillingproposal", "opportunities", "monthlyappusage"]
    assert jobs.load_accounts(read, dest, INGESTION_DAY, PROFILE_PREFIX, CARD_TEMPLATES) == ["accounts"]
    before = {t: spark.read.parquet(f"{dest}/{t}").count() for t in os.listdir(dest)}
    assert jobs.load_raw_tables(read, dest, EMPTY_DAY) == [] and jobs.load_snapshot_tables(read, dest, EMPTY_DAY) == []
    assert jobs.load_accounts(read, dest, EMPTY_DAY, PROFILE_PREFIX, CARD_TEMPLATES) == []
    assert {t: spark.read.parquet(f"{dest}/{t}").count() for t in os.listdir(dest)} == before


# --- plans ---------------------------------------------------------------------------
def scans(plan, path):
    return plan.count(f"{path}]") + plan.count(f"{path},")


def test_load_all_scans_the_stored_snapshot_twice(spark, fx):
    with session.JobStore(spark) as store:
        out = loads.load_all(fx["snapshot"], fx["users"], INGESTION_DAY, store=store)
        plans = {n: t._jdf.queryExecution().optimizedPlan().toString() + str(t.inputFiles()) for n, t in out.items()}
        # one scan wrote the grouping sets, the contracts are the other; all else reads the grouped rows
        assert [n for n, p in plans.items() if "/snapshot-" in p] == ["contracts"]
        assert all("/dimensions-" in p for n, p in plans.items() if n != "contracts")
        assert rows(out["itemclassifications"]) == rows(loads.load_item_classifications(loads.load_snapshot(fx["snapshot"], INGESTION_DAY)))


def test_monthly_summary_explodes_once(spark, fx, tmp_path):
    fx.contracts.write.parquet(f"{tmp_path}/contracts")
    fx.accounts.write.parquet(f"{tmp_path}/accounts")
    c, a = (spark.read.parquet(f"{tmp_path}/{t}") for t in ("contracts", "accounts"))
    names = [n.nodeName() for n in _nodes(executed(monthly.monthly_summary(c, a, AS_OF)))]
    assert sum("Scan" in n for n in names) <= 3 and "Window" not in names  # contracts twice (lifetime), accounts
    assert names.count("Generate") == 2 and sum("Join" in n for n in names) == 2


def test_history_stores_and_joins_counts(spark, fx):
    s = catalog.summary_df(spark, SF_SMALL)
    args = fx.contracts, s, fx["contracteventtypes"], fx["itemclassifications"]
    groups = history.history_groups(*args)
    tripled = history.history_groups(fx.contracts.unionByName(fx.contracts).unionByName(fx.contracts), *args[1:])
    assert groups.count() == tripled.count()
    assert groups.agg(F.sum("_n")).first()[0] * 3 == tripled.agg(F.sum("_n")).first()[0]


def test_counted_rows_expand_in_parts(spark):
    counts = [1, 2, 4095, 4096, 4097, 9000]
    out = history._expanded(spark.createDataFrame([(i, n) for i, n in enumerate(counts)], "k int, _n long"))
    assert {r["k"]: r["count"] for r in out.groupBy("k").count().collect()} == dict(enumerate(counts))


def brute_scan(days):
    out = []
    for key in {k for k, *_ in days}:
        own = sorted((r for r in days if r[0] == key), key=lambda r: (r[1] is not None, r[1] or dt.date.min))
        total, most = None, None
        for k, day, v, s in own:
            total = total if v is None else (total or 0) + v
            out.append((k, day, v, s, total, most))
            most = most if s is None else s if most is None else max(most, s)
    return out


@pytest.mark.parametrize("block", [1, 7, 512])
def test_prefix_scan(spark, block):
    rng = random.Random(3)
    days = {}
    for _ in range(600):
        key = rng.choice([None, "a", "b", "b", "b"])
        day = rng.choice([None, *[dt.date(1969, 1, 1) + dt.timedelta(days=rng.randrange(900))] * 40])
        days[key, day] = (key, day, rng.choice([None, 1, 2, -5]), rng.choice([None, "x", "y", "zz"]))
    df = spark.createDataFrame(list(days.values()), "k string, day date, v long, s string")
    got = prefix_scan(df, ["k"], "day", {"total": "v"}, {"most": F.col("s")}, block_days=block)
    assert sorted(map(tuple, got.select("k", "day", "v", "s", "total", "most").collect()), key=repr) == sorted(brute_scan(list(days.values())), key=repr)


def test_a_million_days_spread_over_tasks(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit("one").alias("k"), F.date_add(F.lit("1970-01-01").cast("date"), F.col("id").cast("int") - n // 2).alias("day"),
                               F.lit(1).cast("long").alias("v"))
    out = prefix_scan(df, ["k"], "day", {"total": "v"})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are small
    try:
        assert out.agg(F.sum("total"), F.max("total")).first()[:] == (n * (n + 1) // 2, n)
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < n / 4


def test_bucketed_contracts_need_no_first_exchange(spark, fx):
    c, a, l = summary.prepare_summary_inputs(fx.contracts, fx.accounts, fx.log)
    bucketed = catalog.bucketed_contracts(spark, c)
    first = bucketed.groupBy("environment", "accountcode").agg(F.max("eventdate"))
    assert not [n for n in _nodes(executed(first)) if "Exchange" in n.nodeName()]

    def exchanges(df):
        """Exchanges of rows that no aggregate or scan of another table has made."""
        found = []
        for n in _nodes(executed(df)):
            if "ShuffleExchange" in type(n).__name__ or n.nodeName() == "Exchange":
                below = [x.nodeName() for x in _nodes(n.children().apply(0))]
                found.append("Aggregate" not in " ".join(below) and any("bucketed" in str(x.simpleString(200)).lower() for x in _nodes(n)))
        return found

    assert not any(exchanges(summary.contract_summary(bucketed, a, l, AS_OF, LINK_CUTOFF, prepare=False)))
    assert not [t for t in spark.catalog.listTables("default") if t.name.startswith("ledgerlens_")]


def test_timeline_on_bucketed_contracts(spark, fx):
    bucketed = catalog.bucketed_contracts(spark, fx.contracts)
    groups = bucketed.groupBy("environment", "accountcode", "eventdate", "eventtype").agg(*timeline._daily_features())
    assert not [n for n in _nodes(executed(groups)) if "Exchange" in n.nodeName()]
