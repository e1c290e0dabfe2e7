"""What a neighbour search writes: each vector a few times, nothing left but the result."""

import os
from urllib.parse import urlparse

import numpy as np
import pytest

from footfall.operators.models import knn as KN
from footfall.session import drop_written, materialize


@pytest.fixture(scope="module")
def cloud(spark):
    x = np.random.default_rng(2).normal(size=(300, 4))
    return spark.createDataFrame([(i, [float(v) for v in x[i]], i % 3) for i in range(300)], "id long, x array<double>, y long")


def folders(spark):
    return {f for f in os.listdir(urlparse(spark.sparkContext.getCheckpointDir()).path) if f.startswith("rdd-")}


def test_a_search_leaves_only_its_result(spark, cloud):
    train, test = cloud.where("id % 4 != 0"), cloud.where("id % 4 = 0")
    for run in (lambda: KN.knn_neighbours(train, test, k=3, block_size=20, shelf_rows=20),
                lambda: KN.knn_predictions(train, test, KN.knn_classify, k=3, block_size=20, shelf_rows=20)):
        held = folders(spark)
        found = run()
        assert len(folders(spark) - held) == 1 and found.select("qid").distinct().count() == 75


def test_only_written_tables_are_dropped(spark, cloud):
    kept, gone = materialize(cloud.limit(5)), materialize(cloud.limit(7))
    held = folders(spark)
    drop_written(cloud, gone.select("id"))
    assert len(held - folders(spark)) == 1 and kept.count() == 5 and cloud.count() == 300


def test_visits_name_queries_without_their_vectors(spark, cloud, monkeypatch):
    seen, scored = [], KN._scored
    monkeypatch.setattr(KN, "_scored", lambda visits, *a: seen.append(visits.columns) or scored(visits, *a))
    KN.knn_neighbours(cloud, cloud.limit(20), k=3, block_size=20, shelf_rows=20)
    assert len(seen) == 2 and not any("qx" in columns for columns in seen)


def test_shelves_and_groups_grow_with_the_rows_within_bounds():
    assert KN._share(1_000, KN.SHELVES, KN.SHELF_ROWS, 64) == KN.SHELF_ROWS
    assert KN._share(410_000, KN.SHELVES, KN.SHELF_ROWS, 64) == 25_625
    for width in (2, 64, 500):
        rows = KN._share(10 ** 9, KN.GROUPS, KN.GROUP_QUERIES, width)
        assert rows == KN.GROUP_QUERIES or rows * width * 8 <= KN.TASK_BYTES
