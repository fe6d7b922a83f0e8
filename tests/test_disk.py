"""Tables read through several views are joined and stored once, wide rows are shuffled once, and a stored
table leaves no shuffle files."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlens import session
from ledgerlens.operators import history
from ledgerlens.plans import catalog
from ledgerlens.plans.fixtures import AS_OF, Fixtures
from tests.conftest import SF_SMALL
from tests.test_plans import _nodes, executed
from tests.test_scale import _text

DAYS = [dt.date(2023, 1, 5), dt.date(2023, 3, 1), dt.date(2024, 6, 1), None]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_a_stored_table_leaves_no_shuffle_files(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    owner, before = spark.conf.get(name), shuffle_files(spark)
    with session.JobStore(spark) as store:
        kept = store.keep(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
        assert shuffle_files(spark) <= before and spark.conf.get(name) == owner
        assert kept.agg(F.sum("count"), F.count("k")).first()[:] == (1000, 7)


@pytest.mark.parametrize("query", ["CPH-1", "CPH-2", "CPH-3", "CPH-4", "CPH-ALL"])
def test_history_joins_the_lines_once(spark, query):
    assert "lineitem.parquet" not in _text(catalog.QUERIES[query](spark, SF_SMALL))


@pytest.mark.parametrize("query", ["JOB-history", "ADC-15-bucketed"])
def test_jobs_join_the_lines_once(spark, query, monkeypatch):
    """Whatever is written, only the stored lines read the driver's lines."""
    written, keep = [], session.JobStore.keep
    monkeypatch.setattr(session.JobStore, "keep", lambda self, df, name="": written.append((name, _text(df))) or keep(self, df, name))
    catalog.QUERIES[query](spark, SF_SMALL)
    assert [name for name, plan in written if "lineitem.parquet" in plan] == ["contract-lines"]


def test_columns_not_stored_raise(spark):
    with session.JobStore(spark) as store:
        views = Fixtures(spark, SF_SMALL, catalog._HISTORY_LINES, store)
        plain = Fixtures(spark, SF_SMALL)
        read = ["environment", "accountcode", "contracttype", "eventdate", "eventtype", "itemcode", "linepackage", "quantity", "valuepermonth"]
        assert views.contracts.dtypes == plain.contracts.dtypes
        assert Counter(views.contracts.select(*read).collect()) == Counter(plain.contracts.select(*read).collect())
        with pytest.raises(Exception, match="contract_lines.item was not stored"):
            views.contracts.select("item").collect()


def made(spark, copies=1):
    """Contracts with days missing, an account of two ids, one listed twice and one not listed, and codes listed twice."""
    lines = [(e, a, day, event, item, package, q, "C" if q % 2 else " T", float(10 * q))
             for e, a, n in (("NL", "1", 9), (" nl", "1 ", 3), ("BE", "2", 5), ("BE", "9", 2), (None, "1", 2), ("NL", None, 2))
             for q in range(n) for day, event, item, package in
             ((DAYS[q % 4], ("CN", "PI", " CN", "XX")[q % 3], ("A", "B ", "A")[q % 3], (1, 0, None)[q % 3]),) for _ in range(copies)]
    contracts = spark.createDataFrame(lines, "environment string, accountcode string, eventdate date, eventtype string, itemcode string, "
                                             "linepackage int, quantity int, contracttype string, valuepermonth double")
    summary = spark.createDataFrame([("NL", "1", "one"), ("NL", "1", "uno "), ("BE", "2", "two"), ("BE", "2", "two"), ("BE", "9", None)],
                                    "environment string, accountcode string, accountid string")
    events = spark.createDataFrame([("NL", "CN", "new "), ("nl", "PI ", "new"), ("BE", "CN", "nieuw"), ("BE", "CN", "neuf"), ("BE", "PI", "plus")],
                                   "environment string, contracteventtypecode string, contracteventdescription string")
    items = spark.createDataFrame([("NL", "A", "a"), ("NL", "B", "b"), ("NL", "B", "b"), ("BE", "A", "a"), ("BE", "B", "a")],
                                  "environment string, itemcode string, itemdescription string")
    return contracts, summary, events, items


def literal(contracts, summary, events, items):
    """CPH-1 in plain Python: every joined line, sums over its group and over the account's days up to its own."""
    def t(v, up=False):
        return None if v is None else v.strip().upper() if up else v.strip()

    contracts, summary, events, items = (df.collect() for df in (contracts, summary, events, items))
    joined = [(t(s.accountid), t(s.environment, True), t(s.accountcode), c.eventdate, t(e.contracteventdescription), t(i.itemdescription),
               0 if t(c.eventtype) == "PI" else c.linepackage, c.quantity, c.valuepermonth if t(c.contracttype) == "C" else 0.0)
              for c in contracts for s in summary for e in events for i in items
              if s.accountid is not None and None not in (c.environment, c.accountcode)
              and (t(c.environment, True), t(c.accountcode)) == (t(s.environment, True), t(s.accountcode))
              and (t(c.environment, True), t(c.eventtype)) == (t(e.environment, True), t(e.contracteventtypecode))
              and (t(c.environment, True), t(c.itemcode)) == (t(i.environment, True), t(i.itemcode))]

    def at(day):
        return day or dt.date.min

    return Counter((*r[:7], float(sum(x[7] for x in joined if x[1:6] == r[1:6])),
                    sum(x[8] for x in joined if x[1:3] == r[1:3] and at(x[3]) <= at(r[3]))) for r in joined)


_COLUMNS = ["accountid", "environment", "accountcode", "eventdate", "contracteventdescription", "itemdescription", "linepackage",
            "quantity", "summrr"]


@pytest.mark.parametrize("copies", [1, 3])
def test_history_against_plain_joins(spark, copies):
    tables = made(spark, copies)
    base = history.history_base(*tables).select(*_COLUMNS)
    got = Counter(tuple(r) for r in base.collect())
    assert got == literal(*tables) and len(got) > 10
    with session.JobStore(spark) as store:
        whole = history.contract_history(*tables, AS_OF, store=store)
        # steps and current points come from the days, and are those of the expanded rows
        plain = history.history_points(base).unionByName(history.step_points(base)).unionByName(history.current_points(base, AS_OF))
        assert Counter(whole.collect()) == Counter(plain.collect())
        assert list(store.rows) == ["history-days"]


def test_counted_lines_are_shuffled_twice(spark, tmp_path):
    """Once to be counted, once to their account and day; no more for descriptions, ids, quantities and MRR."""
    tables = []
    for i, df in enumerate(made(spark)):
        df.write.parquet(f"{tmp_path}/{i}")
        tables.append(spark.read.parquet(f"{tmp_path}/{i}"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nodes = _nodes(executed(history.history_groups(*tables)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = [n for n in nodes if n.nodeName() == "Exchange" and {"_quantity", "sum"} & {n.output().apply(i).name() for i in range(n.output().size())}
            and {"itemcode", "itemdescription"} & {n.output().apply(i).name() for i in range(n.output().size())}]
    assert len(wide) == 2
