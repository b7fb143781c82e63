import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, make_bars
from volcast.operators import quality as qa
from volcast.sources.tables import archive_and_gap_files, table


def test_dedupe_hot_copy_group(spark):
    ev = table(spark, SF_SMALL, "events")
    hot = ev.limit(1)
    copies = hot.select("*", F.explode(F.sequence(F.lit(1), F.lit(2000))).alias("_c")).drop("_c")
    dup = ev.unionByName(copies)
    assert dup.count() == ev.count() + 2000
    d = qa.dedupe(dup, ["event_type", "ts"], ["event_id"])
    assert d.count() == ev.count()
    c = qa.duplicate_count(dup, ["event_type", "ts"]).first()
    assert c.n_duplicates == 2000 and c.n_distinct == ev.count()


def test_dedupe_keeps_first_in_order(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 1, 3, "y"), ("b", 2, 9, "z")],
                               "k string, t int, o int, v string")
    got = {(r.k, r.t): (r.o, r.v) for r in qa.dedupe(df, ["k", "t"], ["o"]).collect()}
    assert got == {("a", 1): (3, "y"), ("b", 2): (9, "z")}


def test_overlap_union_has_duplicates(spark):
    ev = table(spark, SF_SMALL, "events")
    u = archive_and_gap_files(ev)
    c = qa.duplicate_count(u, ["event_type", "ts"]).first()
    assert c.n_distinct == ev.count() and c.n_duplicates > 0


def test_gap_report_and_fill_plan(spark):
    rows = [("A", 0, 1.0), ("A", 1, 1.0), ("A", 2502, 1.0), ("A", 2503, 1.0), ("B", 0, 2.0), ("B", 3, 2.0)]
    b = make_bars(spark, rows).withColumnRenamed("bar_time", "event_time")
    g = qa.gap_report(b, 3600).orderBy("symbol").collect()
    assert [(r.symbol, r.gap_s, r.missing_bars) for r in g] == [("A", 2501 * 3600, 2500), ("B", 3 * 3600, 2)]
    p = qa.gap_fill_plan(qa.gap_report(b, 3600), 3600).orderBy("symbol", "page_no").collect()
    assert [(r.symbol, r.page_no, r.n_bars) for r in p] == [("A", 0, 1000), ("A", 1, 1000), ("A", 2, 500), ("B", 0, 2)]
    a0 = p[0]
    start = int(dt.datetime(2024, 1, 1, 2).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert a0.page_start_ms == start and a0.page_end_ms == start + 999 * 3600_000
    assert p[1].page_start_ms == start + 1000 * 3600_000


def test_coverage(spark):
    b = make_bars(spark, [("A", i, 1.0) for i in range(5)] + [("B", 0, 1.0)]).withColumnRenamed("bar_time", "event_time")
    got = {r.symbol: r.n_rows for r in qa.coverage(b).collect()}
    assert got == {"A": 5, "B": 1}


def test_hash_sample_keeps_none_all_and_the_exact_share(spark):
    import hashlib

    import pytest
    d = spark.range(3000)
    assert qa.hash_sample(d, ["id"], 1.0).count() == 3000 and qa.hash_sample(d, ["id"], 0.0).count() == 0
    want = {i for i in range(3000) if int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16) < int(0.01 * 2 ** 60)}
    assert {r.id for r in qa.hash_sample(d, ["id"], 0.01).collect()} == want
    for bad in (-0.1, 1.5):
        with pytest.raises(ValueError):
            qa.hash_sample(d, ["id"], bad)


def test_gaps_do_not_depend_on_the_session_zone(spark):
    """A gapless hourly series over a clock change has no gap in any session zone."""
    base = dt.datetime(2024, 3, 9, 12)
    bars = make_bars(spark, [("A", i, 1.0) for i in range(1)]).limit(0)
    rows = [("A", base + dt.timedelta(hours=i)) for i in range(48)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        d = spark.createDataFrame(rows, "symbol string, event_time timestamp_ntz")
        assert qa.gap_report(d, 3600).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert bars.count() == 0


def test_overlap_pushes_its_ranges_into_the_scan(spark):
    plan = archive_and_gap_files(table(spark, SF_SMALL, "events"))._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.split("\n") if "FileScan" in line]
    assert len(pushed) == 2
    assert all("ts" in line.split("DataFilters: [")[1].split("]")[0] for line in pushed)
