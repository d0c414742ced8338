import datetime as dt
import json

import pytest

from calipers.operators import attributes as A
from calipers.operators import exports as X
from calipers.operators import snapshots as N
from calipers.plans import jobs
from calipers.sources import feeds

CONFIG = {"DEFAULT": {"width": "w", "height": "h", "depth": "d"}, "Rug": {"width": "l", "height": "h", "depth": "d"}}


@pytest.fixture(scope="module")
def feed(spark):
    rows = [
        ("1", "w", "10 in"), ("1", "h", "2.5"), ("1", "d", "0 in"), ("1", "img", "g1"), ("1", "img", "g2"),
        ("2", "w", "3"), ("2", "w", "1/2"), ("2", "h", ".5"), ("2", "style", " Classic"), ("2", "img", "g3"),
        ("3", "l", "7"), ("3", "h", "none"), ("3", "d", "1"), ("3", "style", "Classic,Modern"),
    ]
    return spark.createDataFrame(rows, "oms_id string, attribute_id string, attribute_value string")


@pytest.fixture(scope="module")
def images(spark):
    rows = [("Lamp", "1", "g1", "FRONT"), ("Lamp", "1", "g2", "SIDE"), ("Lamp", "2", "g3", "SIDE"), ("Rug", "3", "g4", "FRONT"),
            (None, "4", "g5", "FRONT")]
    return spark.createDataFrame(rows, "product_type string, oms_id string, image_guid string, image_type string")


def test_pivot_keeps_every_item(images, feed):
    wide = A.pivot_dimensions(A.dimension_attributes(images, CONFIG), feed)
    got = {r.oms_id: (r.width, r.height, r.depth) for r in wide.collect()}
    assert got == {"1": ("10 in", "2.5", "0 in"), "2": ("1/2", ".5", None), "3": ("7", "none", "1"),
                   "4": (None, None, None)}


def test_lookup_numbers_and_labels(images, feed):
    got = {r.oms_id: r for r in jobs.dimension_lookup(images, feed, CONFIG).collect()}
    assert (got["1"].width_in, got["1"].depth_in, got["1"].depth_text) == (10.0, 0.0, '0"')
    assert got["3"].height_in is None and got["3"].height_text is None


def test_product_multiplies_and_drops(feed):
    got = A.attribute_product(feed, {"w": "w", "img": "img"})
    assert sorted(map(tuple, got.collect())) == [("1", "10 in", "g1"), ("1", "10 in", "g2"), ("2", "1/2", "g3"), ("2", "3", "g3")]


def test_literals_keep_their_blanks(spark, feed):
    items = spark.createDataFrame([("2",), ("3",)], "oms_id string")
    assert A.items_with_values(feed, items, ["Classic"]).count() == 0
    assert [r.oms_id for r in A.items_with_values(feed, items, [" Classic"]).collect()] == ["2"]


def test_styles(feed):
    assert {r.tag: r.tag_freq for r in A.tag_counts(feed, "style").collect()} == {" Classic": 1, "Classic": 1, "Modern": 1}
    assert [r.oms_id for r in A.in_top_styles(feed, "style", 1).collect()] == ["2"]


def test_optional_type_filter(spark, images):
    dims = spark.createDataFrame([("1", 1.0)], "oms_id string, width double")
    assert A.images_with_dimensions(images, dims).count() == 2
    assert A.images_with_dimensions(images, dims, "SIDE").count() == 1


def test_review_record(images, feed):
    dims = A.pivot_dimensions(A.dimension_attributes(images, CONFIG), feed)
    got = {r.oms_id: json.loads(r.record) for r in X.as_json(
        X.review_records(dims, X.chosen_images(images), images, "out")).collect()}
    assert got["1"] == {
        "oms_id": "1", "dimension_image_location": "out/Lamp/1.jpg",
        "dimensions": {"width": "10 in", "height": "2.5", "depth": "0 in"}, "selected_img_guid": "g1",
        "selected_img_type": "FRONT", "all_image_guids": ["g1", "g2"],
    }
    assert got["2"]["dimensions"]["depth"] is None


def test_missing_images(spark, images):
    listing = spark.createDataFrame([("a/g1.jpg", 10), ("a/g2.jpg", 0), ("g4", 5)], "path string, length long")
    assert sorted(r[0] for r in X.missing_images(images, listing).collect()) == ["g2", "g3", "g5"]


def test_lookback(spark):
    days = [dt.date(2021, 4, 1), dt.date(2021, 4, 3), dt.date(2021, 4, 20)]
    table = spark.createDataFrame([(d, str(d)) for d in days], "snapshot_date date, v string")
    start = dt.date(2021, 4, 10)
    assert [r.v for r in N.load_lookback(table, start).collect()] == ["2021-04-03"]
    assert N.load_lookback(table, start, 6).count() == 0  # 4 to 10 April
    assert N.load_lookback(table, start, 7).count() == 1


def test_newest_snapshot(spark):
    paths = ["f/2021-01-05/x", "f/2021-02-01", "f/2021-99-99/x", "f/old-2022-01-01/x", "g/2023-01-01/x"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert N.newest_snapshot(df, "f").first()[0] == dt.date(2021, 2, 1)
    assert N.newest_snapshot(df, "f", "2021-01-31").first()[0] == dt.date(2021, 1, 5)
    assert N.newest_snapshot(df, "h").first()[0] is None


def test_feeds(spark, tmp_path, images, feed):
    (tmp_path / "feed.csv").write_text("1|w|10 in|a|b|c|d\n1|h| 5||||\n")
    got = feeds.read_item_attributes(spark, str(tmp_path / "feed.csv"))
    assert [tuple(r) for r in got.collect()] == [("1", "w", "10 in"), ("1", "h", " 5")]
    (tmp_path / "rows.csv").write_text(
        'omsid,image_url,width,depth,height,canopy,style,taxonomy\n1,u,14.5 in,2,3,0.0,"Classic,Modern",L>C\n')
    row = feeds.read_product_rows(spark, str(tmp_path / "rows.csv")).first()
    assert (row.width, row.canopy, row.style) == ("14.5 in", "0.0", "Classic,Modern")
    dims = A.pivot_dimensions(A.dimension_attributes(images, CONFIG), feed)
    target = feeds.write_dimensions(dims, str(tmp_path), dt.date(2021, 4, 30))
    assert target.endswith("2021-04-30/dimensions")
    back = {r.oms_id: r.width for r in feeds.read_dimensions(spark, target, 1).collect()}
    assert back == {"1": 10.0, "2": 1.0, "3": 7.0, "4": None}
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        feeds.write_dimensions(dims, str(tmp_path), dt.date(2021, 4, 30))
    (tmp_path / "c.json").write_text(json.dumps(CONFIG))
    assert feeds.read_config(spark, str(tmp_path / "c.json")) == CONFIG
    feeds.write_snapshot(feed, str(tmp_path / "snap"), dt.date(2021, 4, 30))
    feeds.write_snapshot(feed.limit(2), str(tmp_path / "snap"), dt.date(2021, 5, 2))
    snap = spark.read.parquet(str(tmp_path / "snap"))
    assert N.load_lookback(snap, dt.date(2021, 5, 10)).count() == 2
    feeds.write_by_product_type(images.na.fill("none"), str(tmp_path / "types"))
    assert (tmp_path / "types" / "product_type=Rug").is_dir()
    listing = feeds.read_image_listing(spark, str(tmp_path / "types"))
    assert listing.columns == ["path", "length"] and listing.count() > 0


def test_dated_path():
    path = feeds.DatedPath("root/<ENV>/<DATE>/items/*")
    day = path.fill("DATE", "2021-04-30")
    assert str(day) == "root/<ENV>/2021-04-30/items/*" and str(path) == "root/<ENV>/<DATE>/items/*"


def test_rows_are_ordered_before_they_are_cut(spark):
    df = spark.createDataFrame([(str(i),) for i in range(50, 0, -1)], "k string")
    assert A.nth_row(df, ["k"], 3).first().k == "11"


def test_native_plan(images, feed):
    plan = jobs.dimension_lookup(images, feed, CONFIG)._jdf.queryExecution().toString()
    assert "EvalPython" not in plan and "CartesianProduct" not in plan


def test_filter_and_columns_reach_the_scan(spark, tmp_path, feed):
    feeds.write_snapshot(feed, str(tmp_path / "s"), dt.date(2021, 4, 30))
    wide = A.attribute_product(spark.read.parquet(str(tmp_path / "s")), {"w": "w", "h": "h"})
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(attribute_id,w)" in plan and "EqualTo(attribute_id,h)" in plan


def test_a_day_written_twice_is_there_once(spark, tmp_path):
    import datetime as dt

    from calipers.sources import feeds

    rows = [("1", "a", "x"), ("2", "a", "y")]
    frame = spark.createDataFrame(rows, "oms_id string, attribute_id string, attribute_value string")
    folder = str(tmp_path / "feed")
    for day in (dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 2)):
        feeds.write_snapshot(frame, folder, day)
    back = spark.read.parquet(folder)
    assert sorted((str(r.snapshot_date), r["count"]) for r in back.groupBy("snapshot_date").count().collect()) == [
        ("2024-01-01", 2), ("2024-01-02", 2)]


def test_kernels_run_from_another_folder(tmp_path):
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import importlib.util, sys\n"
        f"spec = importlib.util.spec_from_file_location('entry', {repo!r} + '/__spark_entry__.py')\n"
        "entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.sql.shuffle.partitions', '2').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "print('rows', entry.queries()['components'](spark, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in out.stdout and out.returncode == 0, out.stderr[-2000:]


def test_sql_functions_are_inlined(spark):
    from calipers.sources import sql

    sql.prepare(spark, "/root/testdata/sf0.001")
    plan = spark.sql("select dimension_value(attribute_value) as v, feet_inches(67.9) as f from item_attributes")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract" in text or "regexp_substr" in text
    assert "dimension_value" not in text and "Python" not in text
    rows = spark.sql("""select dimension_value('a 12.341 in') as a, dimension_value('none') as b, feet_inches(67.9) as c,
        feet_inches(cast('NaN' as double)) as d, inches(12.5D) as e, inches(100D) as f, leading_number(' 16.63 in') as g,
        rug_width('Rug 5 ft. 3 in. x 7 ft.') as h, rug_height('Rug 5 ft. 3 in. x 7 ft.') as i, rug_width('Rug') as j""").first()
    assert tuple(rows) == (12.35, None, "5'7\"", None, '12.5"', '100"', 16.63, 63.0, 84.0, None)


def test_chosen_images_and_review_sink(spark, tmp_path):
    from calipers.sources import feeds

    (tmp_path / "images").mkdir()
    (tmp_path / "images" / "part.csv").write_text("Lamp,7,g1,FRONT\nRug,8,g2,SIDE\n")
    got = sorted(map(tuple, feeds.read_merged_images(spark, str(tmp_path / "images")).collect()))
    assert got == [("Lamp", "7", "g1", "FRONT"), ("Rug", "8", "g2", "SIDE")]
    records = spark.createDataFrame([("7", ["g1"])], "oms_id string, all_image_guids array<string>")
    feeds.write_review(records, str(tmp_path / "review"))
    assert spark.read.json(str(tmp_path / "review")).first().asDict() == {"oms_id": "7", "all_image_guids": ["g1"]}


def test_lookback_from_folder_names(spark, tmp_path, feed):
    folder = str(tmp_path / "snap")
    assert feeds.read_lookback(spark, folder, dt.date(2021, 5, 1)) is None
    for day, rows in ((dt.date(2021, 3, 1), feed), (dt.date(2021, 4, 10), feed.limit(1)), (dt.date(2021, 4, 20), feed.limit(0))):
        feeds.write_snapshot(rows, folder, day)
    (tmp_path / "snap" / "snapshot_date=2021-04-30").mkdir()
    (tmp_path / "snap" / "snapshot_date=2021-04-30" / "part-0.parquet").write_bytes(b"")  # unreadable if it were opened
    assert feeds.snapshot_days(spark, folder)[0] == dt.date(2021, 3, 1)
    got = feeds.read_lookback(spark, folder, dt.date(2021, 4, 29))
    assert [r.snapshot_date for r in got.collect()] == [dt.date(2021, 4, 10)] and len(got.inputFiles()) == 1
    assert feeds.read_lookback(spark, folder, dt.date(2021, 4, 9), 7) is None
    with pytest.raises(LookupError):
        jobs.dimension_job(spark.createDataFrame([], "product_type string, oms_id string"), folder, CONFIG, dt.date(2020, 1, 1), str(tmp_path / "out"))
