"""Views that give the benchmark tables the shapes of the product feeds.

Every view reads whole tables and grows with them. `plans/oracle_views.py` states
the same views as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

IMAGE_WIDTH, IMAGE_HEIGHT = 24, 20
TASKS_PER_CORE, PARTS_PER_TASK = 4, 8192  # of those that make pixels: the larger number of tasks

DIMENSION_CONFIG = {
    "DEFAULT": {"width": "a-width", "height": "a-height", "depth": "a-depth"},
    "PROMO": {"width": "a-length", "height": "a-height", "depth": "a-depth"},
}

ATTRIBUTE_NAMES = {
    "a-width": "Product Width (in.)",
    "a-depth": "Product Depth (in.)",
    "a-height": "Product Height (in.)",
    "a-length": "Product Length (in.)",
    "a-canopy": "Canopy Width (in.)",
    "a-canopy2": "Canopy Depth (in.)",
    "a-style": "Style",
    "a-image": "Product Image",
    "a-group": "Collection",
    "a-thick1": "Thickness",
    "a-thick2": "Thickness (in.)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(value: Column) -> Column:
    return value.cast("string")


def _guid(item: str, picture: str) -> Column:
    return F.md5(F.concat(_text(F.col(item)), F.lit("-"), _text(F.col(picture))))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _text(F.col("p_partkey")).alias("oms_id"),
        F.col("p_type").alias("product_type"),
        F.concat("p_type", F.lit(">"), "p_name").alias("taxonomy"),
    )


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literals, so that their few rows are known to be few when a join is planned."""
    names = F.array(*[
        F.struct(F.lit(k).alias("attribute_id"), F.lit(v).alias("displayname")) for k, v in ATTRIBUTE_NAMES.items()
    ])
    return spark.range(1).select(F.inline(names))


def item_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long attribute table: one pass over `part` for the measures, `lineitem` for the images."""
    size, brand = F.col("p_size"), F.col("p_brand")
    noun = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    price = F.floor("p_retailprice").cast("int")
    values = {
        "a-width": F.concat(_text(size), F.lit(" in")),
        "a-depth": F.when(brand != "Brand#7", F.concat(_text(size % 16 + 1), F.lit(".5 in"))),
        "a-height": F.concat(_text(price % 97 + 1), F.lit(".125")),
        "a-length": F.when(F.col("p_type").isin("PROMO", "LARGE"), _text(size + 3)),
        "a-canopy": F.when(brand == "Brand#11", F.lit("n/a")).otherwise(F.concat(_text(size % 6), F.lit(".25"))),
        "a-group": F.when(brand < "Brand#15", F.concat(F.lit(" "), "p_type")).otherwise(F.col("p_type")),
        "a-thick1": F.when(noun != "rod", F.concat(_text(size % 4), F.lit("/8"))),
        "a-thick2": F.concat(F.lit("0."), _text(size % 9 + 1)),
    }
    pairs = [F.struct(F.lit(k).alias("attribute_id"), v.alias("attribute_value")) for k, v in values.items()]
    pairs.append(F.struct(F.lit("a-style").alias("attribute_id"), F.col("p_type").alias("attribute_value")))
    second = F.when(noun == "widget", F.concat("p_type", F.lit(","), F.split_part("p_name", F.lit(" "), F.lit(1))))
    pairs.append(F.struct(F.lit("a-style").alias("attribute_id"), second.alias("attribute_value")))
    measures = (
        table(spark, sf_dir, "part")
        .select(_text(F.col("p_partkey")).alias("oms_id"), F.inline(F.array(*pairs)))
        .where(F.col("attribute_value").isNotNull())
    )
    pictures = (
        table(spark, sf_dir, "lineitem")
        .select("l_partkey", "l_suppkey")
        .distinct()
        .select(
            _text(F.col("l_partkey")).alias("oms_id"),
            F.lit("a-image").alias("attribute_id"),
            _guid("l_partkey", "l_suppkey").alias("attribute_value"),
        )
    )
    return measures.unionByName(pictures)


def merged_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return pairs.join(parts, pairs.l_partkey == parts.p_partkey).select(
        F.col("p_type").alias("product_type"),
        _text(F.col("l_partkey")).alias("oms_id"),
        _guid("l_partkey", "l_suppkey").alias("image_guid"),
        F.when(F.col("l_suppkey") % 2 == 0, "FRONT").otherwise("SIDE").alias("image_type"),
    )


def image_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly picture predictions; the item key is a number here."""
    pairs = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return pairs.select(
        F.col("l_partkey").alias("oms_id"),
        F.concat(
            F.lit("https://images.example.com/productImages/"),
            _guid("l_partkey", "l_suppkey"),
            F.lit("/svn/p"),
            _text(F.col("l_partkey")),
            F.lit("_1000.jpg"),
        ).alias("image_url"),
        F.when(F.col("l_suppkey") % 2 == 0, "front,white").otherwise("side").alias("prediction_labels"),
    )


def attribute_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("snapshot_date"),
        _text(F.col("o_custkey")).alias("oms_id"),
        F.col("o_orderpriority").alias("attribute_value"),
    )


def feed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object paths of a dated feed; open orders sit outside the dated folders."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        F.when(
            F.col("o_orderstatus") == "O",
            F.concat(F.lit("feed/items/staging-"), day, F.lit("/part-"), _text(F.col("o_orderkey"))),
        )
        .otherwise(F.concat(F.lit("feed/items/"), day, F.lit("/part-"), _text(F.col("o_orderkey"))))
        .alias("path")
    )


def rugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    name = F.concat(
        F.lit("Rug "), _text(size % 12 + 1), F.lit(" ft. "), _text(size % 11), F.lit(" in. x "),
        _text(size % 9 + 2), F.lit(" ft."),
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("omsid"),
        F.when(F.col("p_type") == "SMALL", F.concat(F.lit("Round rug "), _text(size), F.lit(" in.")))
        .otherwise(name).alias("product_name"),
    )


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured boxes of one front picture per item (`_bb`: box of all foreground)."""
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        _text(F.col("p_partkey")).alias("oms_id"),
        F.col("p_type").alias("product_type"),
        (size + 1000).alias("img_w"),
        (size + 800).alias("img_h"),
        (size + 100).alias("min_x"),
        (700 - size * 4).alias("max_x"),
        (size * 3 + 120).alias("min_y"),
        (640 - size).alias("max_y"),
        F.lit(100).alias("min_x_bb"),
        F.lit(710).alias("max_x_bb"),
        F.lit(115).alias("min_y_bb"),
        F.lit(650).alias("max_y_bb"),
    )


def _drawn(part: DataFrame, parts: int, *more: str) -> DataFrame:
    """The pixels of rows (p_partkey, p_type, p_size, p_name and `more`), about `parts` of them; `more` columns are kept."""
    # a few MB of parts are one task or two, and make a thousand times as much: dealt to all cores before they do
    tasks = max(TASKS_PER_CORE * part.sparkSession.sparkContext.defaultParallelism, parts // PARTS_PER_TASK)
    size, halo = F.col("p_size"), F.when(F.col("p_type") == "LARGE", 250).when(F.col("p_type") == "SMALL", 246)
    shades = [
        (size + 40, F.lit(90), size * 3 + 100),  # main
        (size % 20 + 200, F.lit(235), F.lit(240)),  # block
        (size + 40, F.lit(255), F.lit(255)),  # speck
        (halo,) * 3,
        (F.lit(255),) * 3,  # white
    ]
    palette = F.array(*[F.struct(*[c.alias(n) for c, n in zip(rgb, "rgb")]) for rgb in shades])
    dealt = part.where("p_size is not null").select(
        "p_partkey", "p_size", halo.isNotNull().alias("haloed"), palette.alias("palette"), *more
    ).repartition(tasks, "p_partkey")
    grid = dealt.withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(IMAGE_HEIGHT - 1)))).withColumn(
        "x", F.explode(F.sequence(F.lit(0), F.lit(IMAGE_WIDTH - 1)))
    )
    x, y = F.col("x"), F.col("y")
    top = size % 7 + 2
    main = (
        x.between(3, size % 16 + 3)
        & y.between(top, top + 2 + (size * 7) % 9)
        & ~((x == 6) & (y > top + 1))
    )
    block = (size % 2 == 1) & x.between(20, 22) & y.between(14, 16 + size % 3)
    ring = F.col("haloed") & x.between(2, 19) & y.between(1, 15)
    speck = (x == 1) & (y == 1)
    kind = F.when(main, 0).when(block, 1).when(speck, 2).when(ring, 3).otherwise(4)
    # the colours come out of the palette as a row: a filter on them then does not repeat the shape rules above
    return grid.select(
        F.col("p_partkey").alias("image_id"), "x", "y", F.inline(F.array(F.get("palette", kind))), *more
    ).select("image_id", "x", "y", "r", "g", "b", *more)


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One small picture per part: a slotted main shape, faint halos, a detached block, a speck."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_name")
    return _drawn(part, part.count())


def pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Front pictures of several sizes, one per part: 1 to 3 times the small one, a few 12 times (288 x 240)."""
    key = F.col("p_partkey")
    scale = F.when(key % 100 == 7, 12).otherwise(F.col("p_size") % 3 + 1)
    return table(spark, sf_dir, "part").select(
        key.alias("image_id"), _text(key).alias("oms_id"), F.col("p_type").alias("product_type"),
        (scale * IMAGE_WIDTH).alias("img_w"), (scale * IMAGE_HEIGHT).alias("img_h"),
    )


def picture_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pixels of `pictures`: those of the small ones, each a square of pixels."""
    # the scale is joined to the parts, which are far fewer than their pixels
    sizes = pictures(spark, sf_dir).select(F.col("image_id").alias("p_partkey"), (F.col("img_w") / IMAGE_WIDTH).cast("int").alias("k"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_name")
    steps = F.sequence(F.lit(0), F.col("k") - 1)
    wide = _drawn(part.join(sizes.hint("merge"), on="p_partkey"), part.count(), "k").withColumn("dx", F.explode(steps))
    return wide.withColumn("dy", F.explode(steps)).select(
        "image_id", (F.col("x") * F.col("k") + F.col("dx")).alias("x"), (F.col("y") * F.col("k") + F.col("dy")).alias("y"),
        "r", "g", "b",
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short line segments, one per order and line number (the least row where several share them)."""
    least = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("seg_id"))
        .agg(F.min(F.struct("l_partkey", "l_suppkey")).alias("k"))
    )
    part, supp = F.col("k.l_partkey"), F.col("k.l_suppkey")
    even = F.col("seg_id") % 2 == 0
    x1, y1 = part % 90, (supp * 37) % 90
    return least.select(
        "image_id",
        "seg_id",
        x1.cast("double").alias("x1"),
        y1.cast("double").alias("y1"),
        F.when(even, x1 + 3).otherwise((part + 260) % 400 + 100).cast("double").alias("x2"),
        F.when(even, (supp * 37 + 180) % 400 + 100).otherwise(y1 + 2).cast("double").alias("y2"),
    )


def outline_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outline of a box seen from the side: six edges of two pieces each, and for some a stray piece."""
    size = F.col("p_size")
    shift = F.floor("p_retailprice").cast("int") % 10
    flat = F.col("p_brand") < "Brand#12"  # a box seen from the front: two long upright sides
    lone = F.col("p_brand") == "Brand#25"  # only one edge was found
    corners = {
        "a": (F.when(flat, 58).otherwise(60), F.when(flat, 100 + shift).otherwise(250 + shift)),
        "b": (F.when(flat, 60).otherwise(100 + size), F.lit(330)),
        "c": (F.lit(300), F.when(flat, 310).otherwise(290)),
        "d": (F.lit(305), 90 + shift),
        "e": (180 + size, F.lit(60)),
        "f": (F.when(flat, 100).otherwise(58), F.when(flat, 70).otherwise(95)),
    }
    pieces = []
    for n, (start, end) in enumerate(["ab", "bc", "cd", "de", "ef", "fa"]):
        (xs, ys), (xe, ye) = corners[start], corners[end]
        mx, my = F.floor((xs + xe) / 2).cast("int"), F.floor((ys + ye) / 2).cast("int")
        known = (lambda c: c) if n == 0 else (lambda c: F.when(~lone, c))
        pieces.append((2 * n + 1, *map(known, (xs + 1, ys, mx, my))))
        pieces.append((2 * n + 2, *map(known, (xe, ye - 1, mx, my + 1))))
    stray = F.col("p_type") == "LARGE"
    pieces.append((13, F.when(stray, 150 + size), F.when(stray, 200), F.when(stray, 160 + size), F.when(stray, 207)))
    rows = [
        F.struct(
            F.lit(k).alias("seg_id"),
            *[v.cast("double").alias(name) for name, v in zip(("x1", "y1", "x2", "y2"), ends)],
        )
        for k, *ends in pieces
    ]
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_partkey").alias("image_id"), F.inline(F.array(*rows)))
        .where(F.col("x1").isNotNull())
    )


def view_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored pictures per item and view."""
    best = (
        table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.max("l_extendedprice").alias("score"))
    )
    return best.select(
        _text(F.col("l_partkey")).alias("oms_id"),
        _guid("l_partkey", "l_suppkey").alias("image_guid"),
        F.when(F.col("l_suppkey") % 2 == 0, "FRONT").otherwise("SIDE").alias("image_view"),
        "score",
    )


def view_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        _text(F.col("p_partkey")).alias("oms_id"),
        F.col("p_type").alias("product_type"),
        F.when(size % 5 < 2, "SIDE").when(size % 5 < 4, "FRONT").otherwise("neither").alias("image_view"),
    )


def stored_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of an image folder: returned goods have no file, some files are empty."""
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag") != "R")
        .groupBy("l_partkey", "l_suppkey")
        .agg(F.max("l_quantity").alias("top"))
        .select(
            F.concat(F.lit("store/images/"), _guid("l_partkey", "l_suppkey"), F.lit(".jpg")).alias("path"),
            F.when(F.col("top") < 10, 0).otherwise(F.col("top") * 1000).cast("long").alias("length"),
        )
    )


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Temp views under the feed names, for SQL users."""
    for make in (items, attributes, item_attributes, merged_images, image_urls, attribute_snapshots, rugs, boxes,
                 pixels, pictures, picture_pixels, segments, outline_segments, view_candidates, view_labels, stored_images, feed_paths):
        make(spark, sf_dir).createOrReplaceTempView(make.__name__)
