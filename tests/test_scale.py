"""Steps that fail only on large tables, told from their plans or from how often they run."""

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from calipers.operators import attributes as A
from calipers.operators import corners as C
from calipers.operators import rings as R
from calipers.operators import segments as S
from calipers.operators import silhouette as I
from calipers.operators import tiles as T
from calipers.plans import jobs
from calipers.plans.registry import QUERIES
from calipers.runtime import only, release, settle
from calipers.sources import adapters as V


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan()


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _segments(spark, images=40):
    """Boxes; the rows come out of an explode, so that Spark takes them for far fewer than they are."""
    corners = [(0.0, 0.0, 100.0, 0.0), (100.0, 0.0, 100.0, 50.0), (100.0, 50.0, 0.0, 50.0), (0.0, 50.0, 0.0, 0.0)]
    rows = F.array(*[
        F.struct(F.lit(k).alias("seg_id"), *(F.lit(v).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), c)))
        for k, c in enumerate(corners)
    ])
    return spark.range(images).select(F.col("id").alias("image_id"), F.inline(rows))


def test_segments_are_not_broadcast(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(S, "pointer_roots", lambda parents, group: seen.append(_physical(parents)) or parents.withColumnRenamed("parent", "root"))
    settle = S.settle
    monkeypatch.setattr(S, "settle", lambda df: seen.append(_physical(df)) or settle(df))
    assert S.edges_of(_segments(spark)).count() == 160
    joins = [plan for plan in seen if "Join" in plan]
    assert len(joins) == 2 and not any("Broadcast" in plan for plan in joins)


def test_few_edges_walk_as_one_by_one():
    rng = np.random.default_rng(5)
    for scale in (4, 6, 1000):
        sizes = rng.integers(1, 90, 60)
        bounds = np.cumsum(sizes) - sizes
        edges = rng.integers(0, scale, (sizes.sum(), 4)).astype(float)
        order, entry = R._walks(edges, bounds)
        for a, n in zip(bounds, sizes):
            own, end = R._walk(edges[a: a + n])
            assert (order[a: a + n] == own + a).all() and (entry[a: a + n] == end).all()


def test_the_filter_walks_once(spark, monkeypatch):
    plans = []
    settle = R.settle
    monkeypatch.setattr(R, "settle", lambda df: plans.append(_optimized(df).toString()) or settle(df))
    edges = settle(S.edges_of(_segments(spark)))
    assert R.ring_filter(edges, R.ring_order(edges)).count() == 160
    assert sum(plan.count("MapInPandas") for plan in plans) == 1


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """A folder with a small table of parts, in one file."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(k, f"old widget {k}", "Brand#11", "LARGE" if k % 2 else "PROMO", k % 7 + 8, 900.0 + k) for k in range(12)]
    kinds = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(f"{folder}/part.parquet")
    return folder


def test_pixels_are_made_on_all_cores(spark, parts):
    pixels = V.pixels(spark, parts)
    assert pixels.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert pixels.count() == 12 * V.IMAGE_WIDTH * V.IMAGE_HEIGHT


def test_canopy_query_takes_hulls_once(spark, parts):
    ends = QUERIES["canopy_ends"](spark, parts)
    assert ends.columns[-2:] == ["line_y1", "line_y2"] and ends.count() == 12
    assert _optimized(ends).toString().count("Join") == 1


def test_the_dictionary_is_known_to_be_small(spark):
    names = V.attributes(spark, "")
    assert {tuple(r) for r in names.collect()} == set(V.ATTRIBUTE_NAMES.items())
    assert int(_optimized(names).stats().sizeInBytes()) < 1 << 20


def test_unwanted_attributes_are_left_out_before_the_least_values(spark):
    wanted = spark.createDataFrame([("1", "w", "width"), ("2", None, "width")], "oms_id string, dimension_guid string, dimension_name string")
    feed = spark.createDataFrame([("1", "w", "3"), ("1", "w", "2"), ("1", "image", "x"), ("2", None, "5")], "oms_id string, attribute_id string, attribute_value string")
    found = A.pivot_dimensions(wanted, feed)
    assert sorted(map(tuple, found.collect())) == [("1", "2", None, None), ("2", None, None, None)]
    assert "LeftSemi" in _optimized(found).toString()


def test_pictures_of_few_segments_are_one_cell(spark, monkeypatch):
    """Small and large pictures together give the firsts of the list of all pairs."""
    monkeypatch.setattr(S, "FEW", 10)
    rng = np.random.default_rng(3)
    rows = [(i, k, *map(float, rng.integers(0, 60, 4))) for i, n in enumerate((3, 10, 11, 40)) for k in range(n)]
    df = spark.createDataFrame(rows, "image_id long, seg_id int, x1 double, y1 double, x2 double, y2 double")
    sized = df.join(df.groupBy("image_id").agg(F.count("*").alias("n")), on="image_id")
    want = S.similar_segments(df).groupBy("image_id", "seg_i").agg(F.min("seg_j").alias("j"))
    assert {tuple(r) for r in S.first_similar(sized, held="n").collect()} == {tuple(r) for r in want.collect()}


def _parts(spark, folder, n=60):
    """`part` and `lineitem` of a few rows, as the views read them."""
    size = (F.col("id") % 50 + 1).cast("int")
    kind = F.element_at(F.array(*map(F.lit, ("PROMO", "LARGE", "SMALL", "ECONOMY"))), (F.col("id") % 4 + 1).cast("int"))
    spark.range(1, n + 1).select(
        F.col("id").alias("p_partkey"), F.lit("red widget").alias("p_name"), F.concat(F.lit("Brand#"), F.col("id") % 15 + 10).alias("p_brand"),
        kind.alias("p_type"), size.alias("p_size"), (F.col("id") * 1.5 + 900).alias("p_retailprice"),
    ).write.parquet(f"{folder}/part.parquet")
    spark.range(1, n + 1).select(F.col("id").alias("l_partkey"), (F.col("id") % 7).alias("l_suppkey")).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_rows_of_all_pictures_are_not_broadcast(spark, tmp_path, monkeypatch):
    seen = []
    settle = C.settle
    monkeypatch.setattr(C, "settle", lambda df: seen.append(_physical(df)) or settle(df))
    folder = _parts(spark, tmp_path)
    for name in ("really_front", "annotation_plan"):
        seen.append(_physical(QUERIES[name](spark, folder)))
    joins = [plan for plan in seen if "Join" in plan]
    assert len(joins) > 4 and not any("BroadcastHashJoin" in plan for plan in joins)


def test_measured_pictures_are_not_broadcast(spark, tmp_path):
    folder = _parts(spark, tmp_path)
    assert "Broadcast" not in _physical(V.picture_pixels(spark, folder))
    boxes = jobs.measured_boxes(V.picture_pixels(spark, folder), V.pictures(spark, folder), 0.01)
    assert "BroadcastHashJoin" not in _physical(boxes) and boxes.count() == 60


def test_pixels_are_made_without_a_join_and_filters_do_not_repeat_their_rules(spark, tmp_path):
    pixels = V.pixels(spark, _parts(spark, tmp_path))
    dark = pixels.where((F.col("r") + F.col("g") + F.col("b")) < 600)
    assert "Join" not in _optimized(pixels).toString()
    assert _optimized(dark).toString().count("CASE WHEN") == _optimized(pixels).toString().count("CASE WHEN")


def test_pixels_of_a_row_are_moved_as_one():
    y, x = (c.ravel() for c in np.mgrid[0:20, 0:600])
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(x), 7)), pa.array(x.astype(np.int32)), pa.array(y.astype(np.int32)), pa.array(x * y)], ["image_id", "x", "y", "v"]
    )
    rows = pa.Table.from_batches(list(T._stretches(iter([batch]))))
    assert rows.num_rows == 20 * (3 + 5)  # three tiles, and the columns 0, 255, 256, 511 and 512 for the tiles beside
    assert pc.sum(rows.column("v").combine_chunks().value_lengths()).as_py() == 20 * 605


def test_runs_of_pixels_that_come_in_any_order_and_twice(spark):
    rng = np.random.default_rng(11)
    rows = [(int(im) if im != 2 else None, int(x), int(y), int(level)) for im, x, y, level in zip(*(rng.integers(0, n, 3000) for n in (4, 40, 9, 2)))]
    rows += [(9, x, y, 0) for y in range(5) for x in range(700) if x % 300]
    mask = spark.createDataFrame(rows, "image_id long, x int, y int, level int")
    island = F.col("x") - F.row_number().over(Window.partitionBy("image_id", "y", "level").orderBy("x"))
    want = mask.withColumn("island", island).groupBy("image_id", "y", "level", "island").agg(
        F.min("x").alias("x0"), F.max("x").alias("x1")
    ).drop("island")
    runs = I.mask_runs(mask, "level")
    assert runs.schema.names == want.schema.names and "Window" not in _physical(runs)
    assert want.exceptAll(runs).isEmpty() and runs.exceptAll(want).isEmpty()


def test_pixels_that_come_by_column_are_packed_by_row():
    """Each row of a batch is one run, in whatever order its pixels come; a picture may have no name."""
    x, y = (c.ravel() for c in np.mgrid[0:50, 0:20])
    image = pa.array([None if k % 2 else 7 for k in y], pa.int64())
    batch = pa.RecordBatch.from_arrays([image, pa.array(y.astype(np.int32)), pa.array(x.astype(np.int32))], ["image_id", "y", "x"])
    rows = pa.Table.from_batches(list(T._packed(iter([batch]), ["image_id", "y"])))
    assert sorted(rows.to_pylist(), key=lambda r: r["y"]) == [
        {"image_id": None if k % 2 else 7, "y": k, "x0": 0, "x1": 49} for k in range(20)
    ]


def test_settled_steps_are_removed_when_their_result_is_settled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("calipers.runtime.scratch", lambda spark, name: f"{tmp_path}/{name}-{len(list(tmp_path.iterdir()))}")
    outside = settle(spark.range(50))

    def made():
        first = settle(outside.select((F.col("id") % 5).alias("k")))
        return settle(first.groupBy("k").count()).join(first.distinct().hint("merge"), on="k")

    found = only(made)
    assert sorted(map(tuple, found.collect())) == [(k, 10) for k in range(5)]
    assert outside.count() == 50 and len(list(tmp_path.iterdir())) == 2
    release(outside, found.select("k"))  # what is not a settled frame itself is left
    assert found.count() == 5 and len(list(tmp_path.iterdir())) == 1


def test_settled_rows_take_little_disk(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("calipers.runtime.scratch", lambda spark, name: f"{tmp_path}/{name}")
    rows = settle(spark.range(100_000).select("id", (F.col("id") % 90).cast("double").alias("x1"), F.lit(3.0).alias("y1")))
    assert rows.agg(F.sum("x1")).first()[0] == sum(k % 90 for k in range(100_000))
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < 2_000_000


def _sent(spark, df):
    """Rows of the left side of the first join in the plan."""
    plan = _optimized(df)
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    return spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan.children().head()).count()


def test_few_ends_are_sent_to_several_cells(spark):
    rng = np.random.default_rng(7)
    places = np.concatenate([rng.integers(-900, 900, (150, 4)), rng.integers(0, 5, (50, 4)) * 40]).astype(float)
    rows = [(k % 2, k // 2, *map(float, p)) for k, p in enumerate(places)] + [(0, 400, float("nan"), 1.0, None, 2.0)]
    edges = spark.createDataFrame(rows, "image_id long, edge_id long, ex1 double, ey1 double, ex2 double, ey2 double")
    ends = [(im, e, s, x, y) for im, e, *p in rows[:-1] for s, (x, y) in enumerate((p[:2], p[2:]), 1)]
    want = sorted(
        (a[0], a[1], a[2], b[1], b[2]) for a in ends for b in ends
        if a[0] == b[0] and a[1] > b[1] and (a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2 <= 40**2
    )
    pairs = C.endpoint_pairs(edges, 40.0)
    assert sorted(tuple(r)[:5] for r in pairs.collect()) == want
    assert _sent(spark, pairs) < 3 * len(ends)


def test_a_ring_is_carried_without_the_segments_of_its_edges(spark, monkeypatch):
    seen = []
    settle_ = R.settle
    monkeypatch.setattr(R, "settle", lambda df: seen.append(df.columns) or settle_(df))
    edges = settle(S.edges_of(_segments(spark)))
    ring = R.ring_filter(edges, R.ring_order(edges))
    assert set(edges.columns) | {"pos", "entry"} == set(ring.columns) and ring.count() == 160
    assert seen and not any({"seg1", "seg2"} & set(columns) for columns in seen)


def test_matching_leaves_only_what_it_found(spark, tmp_path, monkeypatch):
    edges = settle(S.edges_of(_segments(spark)))
    monkeypatch.setattr("calipers.runtime.scratch", lambda spark, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    assert C.match_corners(edges, 4).count() == 160 and C.match_corners(edges).count() == 160
    steps = [folder for folder in tmp_path.iterdir() if "cx" in spark.read.parquet(str(folder)).columns and "edge_i" not in spark.read.parquet(str(folder)).columns]
    assert not steps


def test_a_measured_plan_leaves_its_boxes_and_sides(spark, tmp_path, monkeypatch):
    folder = _parts(spark, tmp_path / "tables")
    (tmp_path / "settled").mkdir()
    monkeypatch.setattr("calipers.runtime.scratch", lambda spark, name: f"{tmp_path}/settled/{name}-{uuid.uuid4().hex}")
    plan = QUERIES["measured_plan"](spark, folder)
    assert len(list((tmp_path / "settled").iterdir())) == 2 and plan.count() > 60
