"""Distributed operators against plain statements of the same rule, on pictures that cross tiles,
hold many segments, or exceed the sizes handled in one call."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from calipers.operators import components as K
from calipers.operators import corners as C
from calipers.operators import hull as H
from calipers.operators import rings as R
from calipers.operators import segments as S
from calipers.operators import silhouette as I
from calipers.operators import tiles
from calipers.plans import jobs


def _flood(points):
    left, found = set(points), {}
    while left:
        start = min(left, key=lambda p: (p[1], p[0]))
        todo, part = [start], {start}
        left.discard(start)
        while todo:
            x, y = todo.pop()
            for q in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if q in left:
                    left.discard(q)
                    part.add(q)
                    todo.append(q)
        found[start[1] * 2**32 + start[0]] = part
    return found


@pytest.mark.parametrize("tile", [4, 7, 256])
def test_components_across_tiles(spark, tile):
    rng = random.Random(tile)
    masks = {k: {(x, y) for x in range(40) for y in range(30) if rng.random() < p}
             for k, p in enumerate((0.4, 0.55, 0.7))}
    spiral = {(x, y) for x in range(40) for y in range(30) if y % 4 == 0 or (x == 39 and y % 8 < 4) or (x == 0 and y % 8 >= 4)}
    masks[9] = spiral
    rows = [(k, x, y) for k, m in masks.items() for x, y in m]
    mask = spark.createDataFrame(rows, "image_id int, x int, y int")
    runs = _over_border(tile, mask)
    got = {(r.image_id, r.label): r.area for r in I.component_areas(runs).collect()}
    want = {(k, label): len(part) for k, m in masks.items() for label, part in _flood(m).items()}
    assert got == want


def _over_border(tile, mask):
    """Components of the picture moved so that tile borders run `tile` pixels into it."""
    dx, dy = tiles.TILE - tile, tiles.TILE - tile
    runs = I.labelled_runs(mask.select("image_id", (F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y")))
    back = F.col("label") - F.lit(dy) * F.lit(2**32) - F.lit(dx)
    return runs.select("image_id", (F.col("y") - dy).alias("y"), (F.col("x0") - dx).alias("x0"),
                       (F.col("x1") - dx).alias("x1"), back.alias("label"))


def test_contraction_on_long_paths_and_stars(spark):
    rng = random.Random(5)
    edges = [("p", i, i + 1) for i in range(300)] + [("s", 1000, i) for i in range(200)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "g string, a long, b long")
    nodes = spark.createDataFrame([("p", i) for i in range(305)] + [("s", i) for i in range(200)] + [("s", 1000)],
                                  "g string, node long")
    got = {(r.g, r.node): r.label for r in K.connected_components(nodes, df, "g").collect()}
    assert all(got[("p", i)] == (0 if i <= 300 else i) for i in range(305))
    assert all(got[("s", i)] == 0 for i in [*range(200), 1000])


def test_adaptive_cutoff(spark):
    def picture(k, shade_of):
        return [(k, x, y, s, s, s) for x in range(20) for y in range(10) for s in [shade_of(x, y)]]

    rows = picture(1, lambda x, y: 100 if x < 5 else 255)  # enough at 95
    rows += picture(2, lambda x, y: 100 if (x + y) % 2 == 0 else (248 if x < 5 else 255))  # specks, then a block
    rows += picture(3, lambda x, y: 255)  # all white
    rows += picture(4, lambda x, y: 0 if (x, y) == (2, 2) else 255)  # a speck only
    df = spark.createDataFrame(rows, "image_id int, x int, y int, r int, g int, b int")
    runs = I.adaptive_runs(df, speck_share=0.01).cache()
    got = {r.image_id: r.cutoff for r in runs.select("image_id", "cutoff").distinct().collect()}
    assert got == {1: 95, 2: 98, 3: 100, 4: 100}
    box = {r.image_id: (r.min_x, r.max_x, r.min_y, r.max_y) for r in I.silhouette_boxes(runs).collect()}
    assert box[1] == (0, 4, 0, 9) and box[3] == (0, 19, 0, 9)


def test_smoothing_mirrors_the_edges(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    grid = rng.integers(0, 256, (6, 5))
    rows = [(1, x, y, int(grid[y, x]), int(grid[y, x]), int(grid[y, x])) for y in range(6) for x in range(5)]
    df = spark.createDataFrame(rows, "image_id int, x int, y int, r int, g int, b int")
    pad = np.pad(grid, 1, mode="reflect")
    k = np.array([1, 2, 1])
    want = sum(k[i] * k[j] * pad[i : i + 6, j : j + 5] for i in range(3) for j in range(3))
    got = {(r.x, r.y): r.level for r in I.smoothed(df).collect()}
    assert got == {(x, y): (int(want[y, x]) + 8) >> 4 for y in range(6) for x in range(5)}


def test_hull_of_blocks(spark):
    rng = random.Random(1)
    pts = {(rng.randint(0, 400), rng.randint(0, 1500)) for _ in range(300)}
    runs = spark.createDataFrame([(1, y, x, x) for x, y in pts], "image_id int, y int, x0 int, x1 int")
    got = [(r.x, r.y) for r in H.hull_points(H.convex_hulls(runs)).orderBy("pos").collect()]
    n = len(got)
    assert got[0] == min(pts, key=lambda p: (p[1], p[0]))
    for i in range(n):
        (ax, ay), (bx, by) = got[i], got[(i + 1) % n]
        assert all((bx - ax) * (y - ay) - (by - ay) * (x - ax) >= 0 for x, y in pts)
        cx, cy = got[(i + 2) % n]
        assert (bx - ax) * (cy - by) - (by - ay) * (cx - bx) > 0


def test_canopy_walks(spark):
    ring = [(100, 10), (110, 20), (400, 300), (300, 500), (0, 400), (95, 15)]
    hulls = spark.createDataFrame([(1, ring), (2, [(5, 5)])], "image_id int, points array<struct<x:long,y:long>>")
    ext = spark.createDataFrame([(1, 0, 400), (2, 5, 5)], "image_id int, left_x int, right_x int")
    got = {r.image_id: r for r in H.canopy_ends(hulls, ext, 200, 30).collect()}
    a = got[1]
    assert (a.canopy_right_x, a.canopy_right_y, a.canopy_left_x, a.canopy_left_y) == (110, 20, 95, 15)
    assert (got[2].canopy_left_x, got[2].canopy_left_y) == (5, 3)


def _similar(a, b):
    def side(l, p):
        return ((l[2] - l[0]) * (p[1] - l[1]) - (l[3] - l[1]) * (p[0] - l[0])) / math.hypot(l[2] - l[0], l[3] - l[1])

    t = math.atan2(a[3] - a[1], a[2] - a[0]) - math.atan2(b[3] - b[1], b[2] - b[0])
    if min(abs(t), abs(t + math.pi), abs(t - math.pi)) >= 8 * math.pi / 180:
        return False
    far = 0.0
    for l, s in ((a, b), (b, a)):
        d1, d2 = side(l, s[:2]), side(l, s[2:])
        far = max(far, 0.0 if d1 * d2 <= 0 else max(abs(d1), abs(d2)))
    return far < 30


def _random_segments(n, size, seed):
    rng = random.Random(seed)
    return [tuple(float(rng.randint(-size, size)) for _ in range(4)) for _ in range(n)]


@pytest.mark.parametrize("size", [60, 3000])
def test_similar_segments_and_groups(spark, size):
    segs = [s for s in _random_segments(160, size, size) if s[:2] != s[2:]]
    df = spark.createDataFrame([(1, i, *s) for i, s in enumerate(segs)],
                               "image_id int, seg_id int, x1 double, y1 double, x2 double, y2 double")
    want = {(i, j) for i in range(len(segs)) for j in range(i) if _similar(segs[i], segs[j])}
    pairs = S.similar_segments(df)
    rows = [(r.seg_i, r.seg_j) for r in pairs.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    group = {}
    for i in range(len(segs)):
        first = next((j for j in range(i) if (i, j) in want), None)
        group[i] = i if first is None else group[first]
    got = {r.seg_id: r.edge_id for r in S.segment_groups(df).collect()}
    assert got == group


def _edges(spark, segs, image=1):
    rows = [(image, i, *map(float, s), math.hypot(s[2] - s[0], s[3] - s[1]), math.atan2(s[3] - s[1], s[2] - s[0]),
             tuple(map(float, s)), tuple(map(float, s))) for i, s in enumerate(segs)]
    seg = "struct<x1:double,y1:double,x2:double,y2:double>"
    return spark.createDataFrame(rows, "image_id int, edge_id int, ex1 double, ey1 double, ex2 double, ey2 double, "
                                       f"length double, theta double, seg1 {seg}, seg2 {seg}")


def _greedy(segs):
    ends = [(i, k, s[2 * k - 2], s[2 * k - 1]) for i, s in enumerate(segs) for k in (1, 2)]
    pairs = sorted(((a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2, a[0], b[0], a[1], b[1])
                   for a in ends for b in ends if a[0] > b[0])
    used, want = set(), set()
    for d2, i, j, si, sj in pairs:
        if (i, si) not in used and (j, sj) not in used:
            used |= {(i, si), (j, sj)}
            want.add((i, si, j, sj, d2))
    return want


@pytest.mark.parametrize(("n", "most"), [(7, 256), (90, 256), (90, 8), (300, 16)])
def test_greedy_matching(spark, n, most):
    segs = _random_segments(n, 500, n)
    got = [(r.edge_i, r.side_i, r.edge_j, r.side_j, r.d2) for r in C.match_corners(_edges(spark, segs), most).collect()]
    assert len(got) == len(set(got)) and set(got) == _greedy(segs)


def test_greedy_matching_of_a_crowd_and_an_outlier(spark):
    """All ends but one stand in a thousandth of the picture: the cells are cut there, and only there."""
    rng = random.Random(3)
    near = lambda: rng.randrange(100) / 10
    segs = [(near(), near(), near(), near()) for _ in range(150)] + [(9_000.0, 9_000.0, 3.0, 4.0)] + [(5.0, 5.0, 5.0, 5.0)] * 9
    edges = _edges(spark, segs)
    got = [(r.edge_i, r.side_i, r.edge_j, r.side_j, r.d2) for r in C.match_corners(edges, 24).collect()]
    assert len(got) == len(set(got)) and set(got) == _greedy(segs)
    cells = C._split(C.endpoints(edges), 24).groupBy(*C.CELL).count().collect()
    assert len(cells) > 15 and max(c.level for c in cells) > 8 and sum(c["count"] for c in cells) == 2 * len(segs)
    lost = _edges(spark, segs[:2]).withColumn("ex1", F.lit(None).cast("double"))
    assert C.match_corners(lost).count() == 1 and C.match_corners(edges.limit(0)).count() == 0


def test_reach_grows_in_a_large_cell():
    """A cell of many ends lists its pairs within a growing reach; the result is that of one list."""
    rng = np.random.default_rng(6)
    x, y = rng.integers(0, 90, (2, 700)).astype(float)
    edge, side = np.repeat(np.arange(350), 2), np.tile([1, 2], 350)
    cell = np.repeat([0, 1, 2], [300, 10, 390])
    sure = np.where(cell == 2, np.inf, rng.uniform(0, 20, 700))
    small = C._decided(cell, edge, side, x, y, sure)
    most, C.TOGETHER = C.TOGETHER, 10_000
    whole = C._decided(cell, edge, side, x, y, sure)
    C.TOGETHER = most
    assert sorted(zip(*(v.tolist() for v in small))) == sorted(zip(*(v.tolist() for v in whole)))


def _plain_walk(segs):
    ends = [(s[0], s[1]) for s in segs], [(s[2], s[3]) for s in segs]
    gap = lambda p, q: (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2
    edge, side = max(range(len(segs)), key=lambda i: (gap(ends[0][i], ends[1][i]), -i)), 0
    left, out = set(range(len(segs))), []
    while True:
        out.append((len(out), edge, side + 1))
        left.discard(edge)
        if not left:
            return out
        here = ends[1 - side][edge]
        edge, side = min(((i, k) for i in left for k in (0, 1)), key=lambda e: (gap(here, ends[e[1]][e[0]]), e))


@pytest.mark.parametrize("n, size, rows", [(1, 50, 10_000), (9, 300, 10_000), (75, 400, 7), (400, 12, 50), (600, 5_000, 10_000)])
def test_ring_order_against_plain_walk(spark, n, size, rows):
    segs = _random_segments(n, size, n)
    segs[: n // 3] = [(0, 0, k % 3, k % 2) for k in range(n // 3)]  # crowded, with equal ends
    segs[-1] = (0, 0, 40 * size, 1)
    edges = _edges(spark, segs, 1).unionByName(_edges(spark, segs[: max(1, n // 2)], 2)).unionByName(_edges(spark, segs, 3))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        got = {k: [] for k in (1, 2, 3)}
        for r in R.ring_order(edges.coalesce(1)).collect():
            got[r.image_id].append((r.pos, r.edge_id, r.entry))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = _plain_walk(segs)
    assert sorted(got[1]) == sorted(got[3]) == want and sorted(got[2]) == _plain_walk(segs[: max(1, n // 2)])


def test_ring_order_cost_follows_the_edges():
    import time

    import numpy as np

    def seconds(n):
        start = time.perf_counter()
        R._walk(np.random.default_rng(1).random((n, 4)) * 1_000)
        return time.perf_counter() - start

    seconds(100)
    assert seconds(16_000) < 40 * max(seconds(2_000), 0.01)


def test_segments_without_length_do_not_stop_a_job(spark):
    segs = [(0, 0, 100, 0), (50, 5, 50, 5), (0, 1, 100, 1), (7, 7, 7, 7)]
    pairs = S.similar_segments(_edges(spark, segs).selectExpr("image_id", "edge_id as seg_id", "ex1 as x1", "ey1 as y1", "ex2 as x2", "ey2 as y2"))
    assert [(r.seg_i, r.seg_j) for r in pairs.collect()] == [(2, 0)]


def test_corner_steps_are_dropped(spark):
    # a square whose right lower corner is a small step of two edges, and a stray edge at the end
    segs = [(0, 0, 0, 200), (0, 200, 180, 200), (180, 200, 180, 192), (180, 192, 200, 192), (200, 192, 200, 0),
            (200, 0, 0, 0), (60, 60, 70, 66)]
    edges = _edges(spark, segs)
    kept = R.ring_filter(edges, R.ring_order(edges)).collect()
    assert sorted(r.edge_id for r in kept) == [0, 1, 4, 5]
    assert sorted(r.pos for r in kept) == [0, 1, 2, 3]


def test_renumber_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "RANK_BLOCK", 3)
    ring = spark.createDataFrame([(1, p, str(p)) for p in (0, 2, 3, 7, 8, 11)], "image_id int, pos int, v string")
    got = [(r.pos, r.v) for r in R.renumber(ring).orderBy("pos").collect()]
    assert got == list(enumerate(["0", "2", "3", "7", "8", "11"]))


def test_merge_forest_over_tiles(spark):
    """Random pictures of several tiles: at every cutoff the forest has the components of a plain flood."""
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for image, (w, h) in enumerate([(300, 20), (20, 290), (270, 270), (5, 5)]):
        grey = rng.choice([0, 244, 246, 249, 251, 255], (h, w), p=[0.3, 0.15, 0.1, 0.1, 0.05, 0.3])
        level = np.maximum(95, np.ceil(grey * 100 / 255).astype(int))
        ys, xs = np.nonzero(level < 100)
        rows += [(image, int(x), int(y), *[int(grey[y, x])] * 3) for y, x in zip(ys, xs)]
        for cutoff in range(95, 100):
            own = {(y, x) for y, x in zip(*np.nonzero(level <= cutoff))}
            sizes = []
            while own:
                todo, size = [own.pop()], 0
                while todo:
                    y, x = todo.pop()
                    size += 1
                    for near in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                        if near in own:
                            own.remove(near)
                            todo.append(near)
                sizes.append(size)
            want[image, cutoff] = sorted(sizes)
    pixels = spark.createDataFrame(rows, "image_id int, x int, y int, r int, g int, b int")
    pieces, whole = tiles.forest_runs(I.mask_runs(pixels.select("image_id", "x", "y", I._entry_cutoff().alias("level")).where("level < 100"), "level"),
                                   [95, 96, 97, 98, 99])
    parts = pieces.select("image_id", (F.col("x1") - F.col("x0") + 1).alias("n"), F.posexplode("labels").alias("k", "label")).where("label is not null")
    parts = I._whole(parts.withColumn("cutoff", F.col("k") + 95), whole)
    got = {}
    for r in parts.groupBy("image_id", "cutoff", "label").agg(F.sum("n").alias("n")).collect():
        got.setdefault((r.image_id, r.cutoff), []).append(r.n)
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}


def test_sizes_hold_without_white_pixels(spark):
    """An image whose white pixels have no rows is as large as `sizes` says."""
    rows = [(1, x, y, 0, 0, 0) for x in range(10) for y in range(10)]
    pixels = spark.createDataFrame(rows, "image_id int, x int, y int, r int, g int, b int")
    sizes = spark.createDataFrame([(1, 100, 100, "a"), (2, 3, 2, "b")], "image_id int, img_w int, img_h int, oms_id string")
    got = {r.image_id: r for r in jobs.measured_boxes(pixels, sizes).collect()}
    assert (got[1].max_x, got[1].max_y) == (99, 99)  # 1 % of the picture: measured whole
    assert (got[2].max_x, got[2].max_y_bb, got[2].oms_id) == (2, 1, "b")
    small = spark.createDataFrame([(1, 20, 20)], "image_id int, img_w int, img_h int")
    assert jobs.measured_boxes(pixels, small).first().max_x == 9


def test_smoothing_over_tiles(spark):
    """Pictures of several tiles, some with holes, against a plain filter that mirrors at missing pixels."""
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for image, (w, h, holes) in enumerate([(300, 6, 0), (5, 520, 0), (258, 259, 0.3), (1, 1, 0), (2, 3, 0), (257, 257, 0.05)]):
        value = {(x, y): int(rng.integers(256)) for x in range(w) for y in range(h) if rng.random() >= holes}

        def filtered(of, dx, dy):
            out = {}
            for (x, y), v in of.items():
                back, ahead = of.get((x - dx, y - dy)), of.get((x + dx, y + dy))
                first = back if back is not None else ahead if ahead is not None else v
                second = ahead if ahead is not None else back if back is not None else v
                out[x, y] = 2 * v + first + second
            return out

        rows += [(image, x, y, v, v, v) for (x, y), v in value.items()]
        want |= {(image, x, y): (v + 8) >> 4 for (x, y), v in filtered(filtered(value, 0, 1), 1, 0).items()}
    pixels = spark.createDataFrame(rows, "image_id int, x int, y int, r int, g int, b int").repartition(7)
    got = {(r.image_id, r.x, r.y): r.level for r in I.smoothed(pixels).collect()}
    assert got == want
    plan = I.smoothed(pixels)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2  # one is that of repartition(7)
    assert I.smoothed(pixels.limit(0)).count() == 0


@pytest.mark.parametrize(("n", "size"), [(60, 120), (700, 200)])
def test_first_similar_is_the_least_of_the_pairs(spark, n, size):
    rng = np.random.default_rng(n)
    rows = []
    for image in range(3):
        for seg in range(n):
            x, y, angle, length = rng.uniform(0, size), rng.uniform(0, size), rng.choice([0, 0.05, 1.5, 3.1]) + rng.normal() / 40, rng.uniform(0, 60)
            rows.append((image, seg, x, y, x + length * math.cos(angle), y + length * math.sin(angle)))
        rows += [(image, n, 5.0, 5.0, 5.0, 5.0), (image, n + 1, None, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "image_id int, seg_id int, x1 double, y1 double, x2 double, y2 double").repartition(5)
    want = {(r.image_id, r.seg_i): r.j for r in S.similar_segments(df).groupBy("image_id", "seg_i").agg(F.min("seg_j").alias("j")).collect()}
    assert {(r.image_id, r.seg_id): r.first for r in S.first_similar(df).collect()} == want and len(want) > n


def test_segments_on_one_line(spark):
    """20,000 segments on one line are one group; no list of their 200 million pairs is made."""
    df = spark.range(20_000).selectExpr("1 as image_id", "id as seg_id", "double(id % 977) as x1", "3d as y1", "id % 977 + 9d as x2", "3d as y2")
    got = S.segment_groups(df)
    assert got.select("edge_id").distinct().count() == 1 and got.count() == 20_000
    assert "Join" not in S.first_similar(df)._jdf.queryExecution().executedPlan().toString()
