"""Snapshot semantics: lookback bounds, adjacent-date differences, no leakage,
and single-anchor == multi-anchor."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from footfall.operators.anchors import Anchor
from footfall.operators.diffs import adjacent_differences
from footfall.operators.snapshot import history
from footfall.plans.inputs import fixture_inputs
from footfall.plans.normalize import normalize
from footfall.plans.snapshot import create_snapshots
from footfall.sources.fixtures import fixture_anchors
from tests.conftest import SF_SMALL

END = dt.date(2017, 3, 12)


def test_lookback_excludes_both_ends(spark):
    n = 7
    days = [END - dt.timedelta(days=n), END - dt.timedelta(days=n - 1), END - dt.timedelta(days=1), END]
    base = spark.createDataFrame([("s", d, 1.0) for d in days], "store_id string, visit_date date, visitors double")
    kept = sorted(r["visit_date"] for r in history(base, [Anchor(END, 39)], n).collect())
    assert kept == [END - dt.timedelta(days=n - 1), END - dt.timedelta(days=1)]


def test_adjacent_observed_dates(spark):
    d = [dt.date(2017, 1, i) for i in range(1, 5)]
    rows = [("a", d[0], 1.0), ("a", d[1], 4.0), ("a", d[3], 9.0),
            ("b", d[0], 2.0), ("b", d[2], 3.0), ("b", d[3], 7.0)]
    base = spark.createDataFrame(rows, "store_id string, visit_date date, visitors double")
    got = {(r["store_id"], r["visit_date"]): r["diff"] for r in adjacent_differences(base).collect()}
    assert got == {("a", d[1]): 3.0, ("b", d[3]): 4.0}


@pytest.fixture(scope="module")
def snapshot_small(spark):
    inp = fixture_inputs(spark, SF_SMALL)
    return create_snapshots(inp, fixture_anchors()).cache()


def test_label_rows_unchanged_by_feature_joins(spark, snapshot_small):
    labels = create_snapshots(fixture_inputs(spark, SF_SMALL), fixture_anchors(), families=())
    assert snapshot_small.count() == labels.count()
    assert snapshot_small.select("end_date", "store_id", "visit_date").distinct().count() == labels.count()


def test_no_feature_reads_the_future(spark, snapshot_small):
    """Scrambling every visit on or after the anchor must not change features."""
    anchor = [a for a in fixture_anchors()][0]
    inp = fixture_inputs(spark, SF_SMALL)
    v = inp.visits
    inp.visits = v.withColumn("visitors", F.when(F.col("visit_date") >= F.lit(anchor.end_date),
                                                 F.col("visitors") * 7 + 3).otherwise(F.col("visitors")))
    inp.reserve_a = inp.reserve_a.withColumn(
        "reserve_visitors", F.when(F.col("reserve_ts").cast("date") >= F.lit(anchor.end_date),
                                   F.col("reserve_visitors") + 100).otherwise(F.col("reserve_visitors")))
    perturbed = create_snapshots(inp, [anchor])
    feats = [c for c in perturbed.columns if c not in ("visitors", "id")]
    # sums over differently partitioned rows may differ in the last bits: compare at 9 decimals
    a = normalize(snapshot_small.where(F.col("end_date") == F.lit(anchor.end_date))
                  .select(*[f"`{c}`" for c in feats]), 9)
    b = normalize(perturbed.select(*[f"`{c}`" for c in feats]), 9)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_single_anchor_equals_multi_anchor_rows(spark, snapshot_small):
    anchor = fixture_anchors()[3]
    single = normalize(create_snapshots(fixture_inputs(spark, SF_SMALL), [anchor]), 9)
    cols = [f"`{c}`" for c in single.columns]
    multi = normalize(snapshot_small.where(F.col("end_date") == F.lit(anchor.end_date)), 9).select(*cols)
    assert single.select(*cols).exceptAll(multi).count() == 0
    assert multi.exceptAll(single.select(*cols)).count() == 0


def test_training_anchor_grid():
    from footfall.operators.anchors import training_anchors
    start = dt.date(2017, 3, 12)
    train, test = training_anchors(start)
    assert len(train) == 63
    assert train[0] == Anchor(start, 39) and train[57] == Anchor(start - dt.timedelta(days=7 * 57), 39)
    assert [a.horizon for a in train[58:]] == [35, 28, 21, 14, 7]
    assert train[58].end_date == start + dt.timedelta(days=7)
    assert test == Anchor(start + dt.timedelta(days=42), 39)


def test_approx_median_mode_is_bounded_and_exact_for_odd_counts(spark, snapshot_small):
    approx = create_snapshots(fixture_inputs(spark, SF_SMALL), fixture_anchors(), families=("store",),
                              median_mode="approx")
    key = ["end_date", "store_id", "visit_date"]
    cols = []
    for n in (7, 14, 28, 56, 600):
        cols += [f"store_min{n}", f"store_max{n}", f"store_median{n}", f"store_count{n}"]
    a = approx.select(*key, *[F.col(c).alias("a_" + c) for c in cols])
    j = a.join(snapshot_small.select(*key, *cols), key).collect()
    assert len(j) == snapshot_small.count()
    for r in j:
        for n in (7, 14, 28, 56, 600):
            med = r[f"a_store_median{n}"]
            assert r[f"store_min{n}"] - 1e-9 <= med <= r[f"store_max{n}"] + 1e-9
            if r[f"store_count{n}"] % 2 == 1:
                assert med == pytest.approx(r[f"store_median{n}"], abs=1e-9)


def test_known_ahead_reservation_boundaries(spark):
    from footfall.operators.reserve import known_ahead, prepare
    end = dt.date(2017, 3, 12)
    a = Anchor(end, 3)
    ts = lambda d, h=0: dt.datetime.combine(d, dt.time()) + dt.timedelta(hours=h)
    day = lambda k: end + dt.timedelta(days=k)
    rows = [
        ("s", ts(day(-1), 20), ts(day(0), 10), 1.0),   # kept: made the evening before, 14 h lead -> 0 days
        ("s", ts(day(0)), ts(day(1)), 2.0),           # dropped: made on the anchor day
        ("s", ts(day(-5)), ts(day(2)), 3.0),          # kept: last horizon day
        ("s", ts(day(-5)), ts(day(3)), 4.0),          # dropped: visit at end + horizon
        ("s", ts(day(-5)), ts(day(-1)), 5.0),         # dropped: visit before the anchor
    ]
    res = spark.createDataFrame(rows, "store_id string, reserve_ts timestamp_ntz, visit_ts timestamp_ntz, "
                                      "reserve_visitors double")
    got = sorted((r["reserve_visitors"], r["diff_time"]) for r in known_ahead(prepare(res), [a]).collect())
    assert got == [(1.0, 0), (3.0, 7)]


def test_incremental_snapshots_resume(spark, tmp_path):
    from footfall.plans.snapshot import write_snapshots_incremental
    anchors = sorted(fixture_anchors())
    path = str(tmp_path / "snaps")
    inp = fixture_inputs(spark, SF_SMALL)
    first = write_snapshots_incremental(inp, anchors[:3], path, batch_anchors=2)
    assert first == anchors[:3]
    second = write_snapshots_incremental(inp, anchors, path, batch_anchors=4)
    assert second == anchors[3:]
    written = spark.read.parquet(path)
    one_job = create_snapshots(inp, anchors)
    assert written.count() == one_job.count()
    cols = ["end_date", "store_id", "visit_date", "store_mean600", "genre_median56", "air_date_sum"]
    a = normalize(written.select(*cols), 9)
    b = normalize(one_job.select(*cols), 9)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_two_horizons_of_one_date_are_written_apart(spark, tmp_path):
    from footfall.plans.snapshot import write_snapshots_incremental
    inp, end = fixture_inputs(spark, SF_SMALL), fixture_anchors()[0].end_date
    both, path = [Anchor(end, 39), Anchor(end, 14)], str(tmp_path / "snaps")
    with pytest.raises(ValueError, match="two horizons"):
        create_snapshots(inp, both)
    assert write_snapshots_incremental(inp, both[:1], path) == both[:1]
    assert write_snapshots_incremental(inp, both, path) == both[1:]
    rows = spark.read.parquet(path)
    short, long = (rows.where(F.col("horizon") == h).drop("horizon") for h in (14, 39))
    assert 0 < short.count() < long.count()
    keys = ["store_id", "visit_date", "air_date_sum"]
    near = long.where(F.col("visit_date") < F.lit(end + dt.timedelta(days=14)))
    assert near.select(*keys).exceptAll(short.select(*keys)).count() == 0


def test_anchors_frame_literal_table(spark):
    from footfall.operators.anchors import anchors_frame
    df = anchors_frame(spark, fixture_anchors())
    assert df.schema.simpleString() == "struct<end_date:date,horizon:int>"
    assert sorted((r["end_date"], r["horizon"]) for r in df.collect()) == \
        sorted((a.end_date, a.horizon) for a in fixture_anchors())


def test_store_features_are_made_for_label_rows_only(spark, monkeypatch):
    from footfall.operators import features as FE
    from footfall.plans.queries import customer_inputs
    from footfall.plans.snapshot import create_snapshots
    from footfall.sources.fixtures import fixture_anchors
    from tests.conftest import SF_SMALL
    seen, block = [], FE.store_block
    monkeypatch.setattr(FE, "store_block", lambda hist, *a: seen.append(hist) or block(hist, *a))
    out = create_snapshots(customer_inputs(spark, SF_SMALL), fixture_anchors(), families=("store",))
    made = {tuple(r) for r in seen[0].select("end_date", "store_id").distinct().collect()}
    assert made and made <= {tuple(r) for r in out.select("end_date", "store_id").distinct().collect()}
