"""NULL dates and packages, accounts published twice, large totals, odd integers, no shared folder."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerlens import session
from ledgerlens.functions.columns import lenient_integer
from ledgerlens.operators import monthly, normalize, summary, timeline
from ledgerlens.plans.fixtures import AS_OF, LINK_CUTOFF, Fixtures
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, SF_SMALL)


def test_fixtures_hold_the_awkward_rows(fx):
    c = fx.contracts
    for column in ("startdate", "finaldate", "eventdate", "contractnumber", "contracttype", "packagecode"):
        assert c.where(F.col(column).isNull()).count() > 0, column
    for column in ("environment", "accountcode", "itemcode", "eventtype", "contracttype"):
        assert c.where(F.col(column) != F.trim(F.col(column))).count() > 0, column
    assert fx.accounts.groupBy("environment", "accountcode").count().where("count > 1").count() > 0
    assert fx.log.where("date is null").count() > 0


def test_lines_without_dates_are_in_no_month(fx):
    lost = fx.contracts.where("startdate is null or finaldate is null")
    assert lost.count() > 0 and monthly.month_assignments(lost, AS_OF).count() == 0


@pytest.mark.parametrize("kind, values", [
    ("bigint", {"9007199254740993": 9007199254740993, "-9007199254740993.9": -9007199254740993, "99999999999999999999": None, "2147483648": 2147483648}),
    ("int", {"2147483648": None, "5.0": 5, " -7.9 ": -7, ".5": 0, "5.": 5, "+12": 12, "1e3": None, "5d": None, "": None, " ": None, ".": None, "-": None,
             "x": None, None: None}),
])
def test_lenient_integers(spark, kind, values):
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    assert {r[0]: r[1] for r in rows.select("v", lenient_integer("v", kind)).collect()} == values
    name = "integers" if kind == "int" else "longs"
    assert [r[0] for r in normalize.cast_columns(rows, **{name: ["v"]}).collect()] == list(values.values())


def test_totals_beyond_int(fx):
    big = fx.contracts.withColumns({"numberofusers": F.lit(2_000_000_000), "numberofadministrations": F.lit(2_000_000_000),
                                    "valuepermonth": F.lit(3e9)})
    s = summary.contract_summary(big, fx.accounts, fx.log, AS_OF, LINK_CUTOFF)
    top = s.agg(F.max("latestmrr"), F.max("latestnumberofusers")).first()
    assert top[0] > 2**31 and top[1] > 2**31
    rows = timeline.contract_activity(big, fx.log, s, fx.accounts, LINK_CUTOFF, checkpoint=False)
    assert rows.agg(F.max("numberofusers")).first()[0] > 2**31


def test_timeline_equals_the_step_chain(spark, fx, tmp_path):
    summary.contract_summary(fx.contracts, fx.accounts, fx.log, AS_OF, LINK_CUTOFF).write.parquet(f"{tmp_path}/s")
    s, c = spark.read.parquet(f"{tmp_path}/s"), fx.contracts
    base = timeline.link_base(s, fx.accounts, fx.log, LINK_CUTOFF)
    steps = timeline.timeline_with_features(timeline.timeline_events(c), timeline.running_features(c))
    flagged = timeline.linked_as_of_event(steps, base)
    links = timeline.link_events(flagged, base)
    keys = ["environment", "accountcode"]
    assert links.count() == links.select(*keys).distinct().count() > 0  # one LINK row for an account
    chain = timeline._final_rows(timeline.backfill_package(timeline.timeline_union(flagged, timeline.overwrite_on_link_date(links, flagged)), c))
    job = timeline.contract_activity(c, fx.log, s, fx.accounts, LINK_CUTOFF)
    assert chain.where("packagecode is null").count() >= 0 and job.count() > 0
    assert job.exceptAll(chain).count() == 0 and chain.exceptAll(job).count() == 0


def test_a_cluster_needs_a_shared_folder():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://host"):
        set_to = []
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=set_to.append)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context))
        assert session.ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context), "hdfs:/x/") == "hdfs:/x" and set_to == ["hdfs:/x/"]
