import pytest
from pyspark.sql import functions as F

from calipers.operators import corners as C
from calipers.operators import layout as L
from calipers.plans import jobs
from calipers.plans import registry as Q

CONFIG = L.DrawingConfig()
SF = "/root/testdata/sf0.001"
BOX = "min_x int, max_x int, min_y int, max_y int, min_x_bb int, max_x_bb int, min_y_bb int, max_y_bb int"


def test_config_of_nested_json():
    got = L.DrawingConfig.of({"border_ratio": 0.2, "front": {"depth_angle_deg": 45}, "font_file": "x",
                              "allow_swap_height_depth_product_types": ["Oven"]})
    assert (got.border_ratio, got.depth_angle_deg, got.swap_types) == (0.2, 45, ("Oven",))


def test_front_layout_leans_either_way(spark):
    boxes = spark.createDataFrame([(10, 110, 20, 220, 5, 115, 15, 230)], BOX)
    left = L.front_layout(boxes, CONFIG).first()
    assert tuple(left.height) == (115.0, 220.0, 115.0, 20.0) and tuple(left.width) == (10.0, 230.0, 110.0, 230.0)
    assert left.depth.x1 == 5 and left.depth.y1 == pytest.approx(200) and left.depth.x2 == pytest.approx(-35)
    right = L.front_layout(boxes, L.DrawingConfig(depth_angle_deg=45)).first()
    assert right.height.x1 == 5 and right.depth.x1 == 115 and right.depth.x2 == pytest.approx(155)
    rug = L.front_layout(boxes, CONFIG, rug=True).first()
    assert tuple(rug.depth) == pytest.approx((15.0, 140.0, -5.0, 140.0))


def test_labels_keep_their_distance(spark):
    rows = Q._annotated(spark, SF).collect()
    assert rows
    for r in rows:
        for n in L.ORDER:
            if r[f"{n}_text"] is None:
                continue
            p, left, top = r[f"{n}_label"], r[f"{n}_label_left"], r[f"{n}_label_top"]
            # what is added at the top and left later moves a mark further inside
            assert min(p.x1, p.x2, p.bx1, p.bx2) + left >= 25 and min(p.y1, p.y2, p.by1, p.by2) + top >= 25
            assert max(p.x1, p.x2, p.bx1, p.bx2) + r.add_left + 25 <= r.canvas_w - 1 + (r.add_left - left)
            assert max(p.y1, p.y2, p.by1, p.by2) + r.add_top + 25 <= r.canvas_h - 1 + (r.add_top - top)


def test_label_moves_away_and_empty_line_fails(spark):
    line = "struct<x1:double,y1:double,x2:double,y2:double>"
    df = spark.createDataFrame([((0.0, 0.0, 100.0, 0.0),), ((5.0, 5.0, 5.0, 5.0),)], f"w {line}")
    spot = L.placed_label("w", F.lit(50.0), F.lit(40.0), F.lit(10.0), F.lit(0.0), F.lit(20), CONFIG)
    got = [r[0] for r in df.select(spot).collect()]
    assert (got[0].y1, got[0].y2, got[0].x1) == (-20.0, -20.0, 0.0) and got[1] is None


def test_swap_needs_known_dims(spark):
    line = "struct<x1:double,y1:double,x2:double,y2:double>"
    up, flat = (0.0, 0.0, 0.0, 100.0), (0.0, 0.0, 100.0, 0.0)
    dims = [(10.0, 30.0, 10.0), (10.0, 10.0, 30.0), (0.0, 1.0, 1.0), (10.0, None, 10.0), (10.0, float("nan"), 10.0)]
    df = spark.createDataFrame([(up, flat, *d) for d in dims], f"height {line}, width {line}, w double, h double, d double")
    got = [r[0] for r in df.select(L.should_swap(CONFIG, F.col("w"), F.col("h"), F.col("d"))).collect()]
    assert got == [True, False, False, False, False]


def test_anchor(spark):
    df = spark.createDataFrame([("center", "bottom"), ("left", "top"), ("middle", "top")], "a string, b string")
    spot = L.text_corner(F.lit(100.0), F.lit(50.0), F.lit(40.0), F.lit(10.0), F.col("a"), F.col("b"))
    assert [tuple(r[0]) if r[0] else None for r in df.select(spot).collect()] == [(80.0, 40.0), (100.0, 50.0), None]


def test_side_view_of_a_box(spark):
    ring = [(60, 250), (110, 330), (300, 290), (305, 90), (190, 60), (58, 95)]
    segs = [(*ring[i], *ring[(i + 1) % 6]) for i in range(6)]
    rows = [(1, i, *map(float, s)) for i, s in enumerate(segs)] + [(2, 0, 0.0, 0.0, 50.0, 9.0)]
    df = spark.createDataFrame(rows, "image_id int, seg_id int, x1 double, y1 double, x2 double, y2 double")
    images = spark.createDataFrame([(1, 400, 400), (2, 400, 400), (3, 400, 400)], "image_id int, img_w int, img_h int")
    got = {r.image_id: r for r in jobs.side_layouts(df, images).collect()}
    assert tuple(got[1].height) == pytest.approx((305, 90, 300, 290))
    assert tuple(got[1].width) == pytest.approx((300, 290, 110, 330))
    assert tuple(got[1].depth) == pytest.approx((110, 330, 60, 250))
    assert got[1].center_x == pytest.approx((305 + 300 + 110 + 60) / 4)
    assert {k: r.status for k, r in got.items()} == {1: "ok", 2: "failed", 3: "failed"}


def test_corner_outside_falls_back_to_the_middle(spark):
    seg = "struct<x1:double,y1:double,x2:double,y2:double>"
    a, b = (0.0, 10.0, 100.0, 10.0), (110.0, 14.0, 210.0, 14.0)
    edges = spark.createDataFrame([(1, 0, *a, a, a), (1, 1, *b, b, b)],
                                  f"image_id int, edge_id int, ex1 double, ey1 double, ex2 double, ey2 double, seg1 {seg}, seg2 {seg}")
    pairs = spark.createDataFrame([(1, 1, 1, 0, 2, 116.0)], "image_id int, edge_i int, side_i int, edge_j int, side_j int, d2 double")
    sizes = spark.createDataFrame([(1, 300, 300)], "image_id int, img_w int, img_h int")
    got = C.corner_points(edges, pairs, sizes).first()
    assert (got.x, got.y) == (105.0, 12.0)
