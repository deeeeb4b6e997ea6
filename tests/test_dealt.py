"""Steps that deal their rows to as many tasks as there are rows for."""

import pytest
from test_catalog import built, bundle  # noqa: F401

from polycat.plans import detail, quality
from polycat.sources import shared

IMAGES = "car_id string, image_path string, sort_order int, image_type string"


@pytest.fixture
def lake(spark, built, tmp_path):  # noqa: F811
    out = built[0].copy_to(f"file://{tmp_path}/l")
    out.write("car_images", spark.createDataFrame([("car1", "b", 2, "hero"), ("car1", "a", 1, "hero"), ("none", "c", 1, "hero")], IMAGES))
    return out


def test_tasks_follow_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [shared.tasks(spark, n) for n in (0, 1, shared.TASK_ROWS * 1000, shared.TASK_ROWS * 1000 + 1)] == [cores, cores, 1000, 1001]


def test_details_of_many(spark, lake, monkeypatch):
    """A table of many ids gives what a list gives, from tasks whose number follows the rows; ids that are there twice or have no car change nothing."""
    ids = ["car1", "car2", "car2", "absent"]
    want = sorted(map(repr, detail.details(lake, ids, "cn").collect()))
    assert len(want) == 2 and "image_path='a'" in want[0]
    few = detail.details(lake, spark.createDataFrame([(i,) for i in ids], "id string"), "cn")
    assert "REPARTITION_BY_NUM" not in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(detail, "FEW", 0)
    monkeypatch.setattr(shared, "TASK_ROWS", 1)
    many = detail.details(lake, spark.createDataFrame([(i,) for i in ids], "id string"), "cn")
    rows = sum(lake.table(t).where(w).count() for t, w in (("cars", "true"), ("car_specs", "locale = 'cn'"), ("car_images", "true")))
    assert f", {rows}), REPARTITION_BY_NUM" in many._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, many.collect())) == sorted(map(repr, few.collect())) == want


def test_gate_of_many(spark, lake, monkeypatch):
    """Counts and rows are the same from many tasks; a car or a number that is there twice neither doubles images nor counts twice; an image without a car's id is of no car."""
    monkeypatch.setattr(shared, "TASK_ROWS", 1)
    lake.write("cars", lake.table("cars").unionByName(lake.table("cars")))
    expected = spark.createDataFrame([("car1", 2), ("car1", 2), ("unknown", 7)], "car_id string, expected int")
    paths = lambda: sorted(r.image_path for r in lake.table("car_images").collect())
    good = spark.createDataFrame([("car1", "a", 1, "hero"), ("car1", "b", 2, "hero"), ("car2", "c", 1, "hero")], IMAGES)
    assert quality.load_images(lake, good, expected, mode="strict") == 0 and paths() == ["a", "b", "c"]
    ids = [r.id for r in lake.table("car_images").collect()]
    assert len(set(ids)) == 3
    lost = good.unionByName(spark.createDataFrame([(None, "x", 1, "hero")], IMAGES))
    assert quality.load_images(lake, lost, expected, mode="soft") == 4 and paths() == ["a", "b", "c"]
    assert quality.load_images(lake, lost, expected, mode="off") == 0 and paths() == ["a", "b", "c", "x"]
    assert quality.load_images(lake, good.where("car_id = 'car1'"), expected, mode="soft", max_count=0, max_ratio=0.5) == 0  # one of two cars: not above a half
    assert quality.load_images(lake, good.where("car_id = 'car1'"), expected, mode="soft", max_count=0, max_ratio=0.49) == 4
