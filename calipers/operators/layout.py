"""Where dimension lines and labels go. One row per picture with struct columns height, width
and depth (x1, y1, x2, y2), center_x, center_y, and img_w, img_h."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.functions.shapes import distance, whole
from calipers.functions.text import feet_inches_label, inches_label

ORDER = ["height", "width", "depth"]


@dataclass(frozen=True)
class DrawingConfig:
    """The published drawing parameters."""

    num_dim_decimal_pts: int = 2
    border_ratio: float = 0.15
    line_margin_ratio: float = 0.05
    line_size_ratio: float = 0.005
    font_size_ratio: float = 0.04
    area_rugs_depth_bar_fraction: float = 0.2
    dims_bar_ends_size_fraction: float = 0.1
    depth_angle_deg: int = 135
    start_depth_height_ratio: float = 0.3
    end_depth_height_ratio: float = 0.1
    swap_types: tuple[str, ...] = ("Electric_Cooktop", "Gas_Cooktop", "Induction_Cooktop")
    min_edge_dist: int = 25
    # Label box around the text, equal-length factor, parallel cosine, swap coefficient.
    text_box: float = 1.2
    length_factor: float = 1.1
    cos_cutoff: float = 0.98
    swap_coeff: float = 0.6

    @staticmethod
    def of(config: Mapping) -> DrawingConfig:
        """From the nested JSON config; unknown keys are ignored."""
        flat = {**config, **config.get("front", {})}
        if "allow_swap_height_depth_product_types" in flat:
            flat["swap_types"] = tuple(flat["allow_swap_height_depth_product_types"])
        return DrawingConfig(**{k: v for k, v in flat.items() if k in DrawingConfig.__dataclass_fields__})


@dataclass(frozen=True)
class Glyphs:
    """Advance widths in 1/1000 of the font size; characters not listed use `other`. Fixed values."""

    widths: Mapping[str, int] = field(default_factory=lambda: {
        " ": 278, '"': 355, "'": 191, ".": 278, "L": 556, "W": 944, "c": 500, "e": 556, "h": 556,
        "i": 222, "k": 500, "n": 556, "s": 500, "t": 278,
    })
    other: int = 556
    line_height: int = 1150


def line_specs(images: DataFrame, config: DrawingConfig) -> DataFrame:
    """Margin and width of lines from the bordered size, font size from the size before the border."""
    bordered = F.greatest("bordered_w", "bordered_h")
    return images.select(
        "*",
        whole(F.lit(config.line_margin_ratio) * bordered).alias("line_margin"),
        whole(F.lit(config.line_size_ratio) * bordered).alias("line_width"),
        whole(F.lit(config.font_size_ratio) * F.greatest("img_w", "img_h")).alias("font_size"),
    )


def _line(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(*[c.cast("double").alias(n) for c, n in ((x1, "x1"), (y1, "y1"), (x2, "x2"), (y2, "y2"))])


def front_layout(boxes: DataFrame, config: DrawingConfig, rug: bool = False) -> DataFrame:
    """Lines of a front view from the box of the large shapes and (`_bb`) of all foreground."""
    c = F.col
    angle = config.depth_angle_deg * math.pi / 180

    def at(ratio: float) -> Column:
        return c("min_y") * F.lit(ratio) + c("max_y") * F.lit(1.0 - ratio)

    upper, lower = at(config.start_depth_height_ratio), at(config.end_depth_height_ratio)
    run = (lower - upper) / F.lit(abs(math.tan(angle)))
    leans_right = angle < math.pi / 2
    if leans_right:
        height_x, low_x, up_x = c("min_x_bb"), c("max_x_bb"), c("max_x_bb") + run
    else:
        height_x, low_x, up_x = c("max_x_bb"), c("min_x_bb"), c("min_x_bb") - run
    depth = _line(low_x, lower, up_x, upper)
    if rug:
        half = (c("max_x") - c("min_x")) * F.lit(0.5 * config.area_rugs_depth_bar_fraction)
        bar_y = c("min_y") * F.lit(0.4) + c("max_y") * F.lit(0.6)
        depth = _line(c("min_x_bb") + half, bar_y, c("min_x_bb") - half, bar_y)
    return boxes.select(
        "*",
        _line(height_x, c("max_y"), height_x, c("min_y")).alias("height"),
        _line(c("min_x"), c("max_y_bb"), c("max_x"), c("max_y_bb")).alias("width"),
        depth.alias("depth"),
        ((c("min_x") + c("max_x")) / 2.0).alias("center_x"),
        ((c("min_y") + c("max_y")) / 2.0).alias("center_y"),
    )


def line_length(name: str) -> Column:
    return distance(*[F.col(f"{name}.{k}") for k in ("x1", "y1", "x2", "y2")])


def is_really_front(config: DrawingConfig) -> Column:
    """Height and depth lines about equally long and parallel: the picture shows the front."""
    h, d = line_length("height"), line_length("depth")
    dx = {n: F.col(f"{n}.x1") - F.col(f"{n}.x2") for n in ("height", "depth")}
    dy = {n: F.col(f"{n}.y1") - F.col(f"{n}.y2") for n in ("height", "depth")}
    cosine = F.abs(F.try_divide(dx["height"] * dx["depth"] + dy["height"] * dy["depth"], h * d))
    alike = F.least(h, d) * F.lit(config.length_factor) >= F.greatest(h, d)
    return F.coalesce(alike & (cosine >= F.lit(config.cos_cutoff)), F.lit(False))


def should_swap(config: DrawingConfig, width: Column, height: Column, depth: Column) -> Column:
    """The measured height/width ratio fits the depth much better than the height.

    Missing, NaN or zero dimensions never swap.
    """
    measured = F.try_divide(line_length("height"), line_length("width"))

    def error(ratio: Column) -> Column:
        return F.try_divide(F.abs(measured - ratio), ratio)

    known = ~(F.isnan(width) | F.isnan(height) | F.isnan(depth))
    fits = error(F.try_divide(depth, width)) <= error(F.try_divide(height, width)) * F.lit(config.swap_coeff)
    return F.coalesce(known & fits, F.lit(False))


#: No picture has coordinates of this size; a line with such an end (or NaN) has no label.
FARTHEST = float(2**31)


def swap_height_depth(layouts: DataFrame, swap: Column) -> DataFrame:
    """Exchange the height and depth lines of the rows for which `swap` holds."""
    return layouts.withColumn("swapped", swap).withColumns({
        "height": F.when(F.col("swapped"), F.col("depth")).otherwise(F.col("height")),
        "depth": F.when(F.col("swapped"), F.col("height")).otherwise(F.col("depth")),
    })


def text_width(text: Column, font_size: Column, glyphs: Glyphs | None = None) -> Column:
    """Width of the widest line of `text` in pixels."""
    glyphs = glyphs or Glyphs()
    table = F.create_map(*[F.lit(v) for pair in glyphs.widths.items() for v in pair])

    def line(s: Column) -> Column:
        one = lambda acc, ch: acc + F.coalesce(F.try_element_at(table, ch), F.lit(glyphs.other))
        return F.aggregate(F.filter(F.split(s, ""), lambda ch: ch != ""), F.lit(0), one)

    return F.array_max(F.transform(F.split(text, "\n"), line)) * font_size / 1000.0


def text_height(text: Column, font_size: Column, glyphs: Glyphs | None = None) -> Column:
    glyphs = glyphs or Glyphs()
    return F.size(F.split(text, "\n")) * F.lit(glyphs.line_height) * font_size / 1000.0


def placed_label(
    line: str, away_x: Column, away_y: Column, text_w: Column, text_h: Column, line_margin: Column,
    config: DrawingConfig,
) -> Column:
    """struct of the moved line (x1, y1, x2, y2) and its text box (bx1, by1, bx2, by2).

    The line moves along its normal, away from (away_x, away_y), far enough for the
    text box. Null for a line whose ends coincide, and for coordinates beyond any picture.
    """
    x1, y1, x2, y2 = (F.col(f"{line}.{k}") for k in ("x1", "y1", "x2", "y2"))
    box_w, box_h = text_w * F.lit(config.text_box), text_h * F.lit(config.text_box)
    margin = F.greatest(F.sqrt(box_w * box_w + box_h * box_h) * F.lit(config.text_box) / 2.0, line_margin)
    mx, my = (x1 + x2) / 2.0, (y1 + y2) / 2.0
    nx, ny = y1 - y2, x2 - x1
    length = F.sqrt(nx * nx + ny * ny)
    # the away point lies on the side of the normal: turn it round
    sign = F.when((away_x - mx) * nx + (away_y - my) * ny > 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    sx, sy = F.try_divide(nx, length) * sign * margin, F.try_divide(ny, length) * sign * margin
    fields = {
        "x1": x1 + sx, "y1": y1 + sy, "x2": x2 + sx, "y2": y2 + sy,
        "bx1": mx + sx - box_w / 2.0, "by1": my + sy - box_h / 2.0,
        "bx2": mx + sx + box_w / 2.0, "by2": my + sy + box_h / 2.0,
    }
    within = F.greatest(*[F.abs(v) for v in fields.values()]) < F.lit(FARTHEST)
    return F.when((length > 0) & within, F.struct(*[v.alias(k) for k, v in fields.items()]))


def grown_canvas(labels: DataFrame, names: list[str], config: DrawingConfig) -> DataFrame:
    """Grow the picture until every placed label keeps its distance from the edges.

    `labels` has placed-label structs under `names`, and canvas_w, canvas_h. The labels
    are taken in order and the border added so far is carried along; after each one
    `<name>_left` and `<name>_top` hold the shift of its coordinates.
    """
    gap = config.min_edge_dist
    d = labels.withColumns({"add_left": F.lit(0).cast("long"), "add_top": F.lit(0).cast("long")})
    for name in names:
        for low, high, size, shift in (("x", "x", "canvas_w", "add_left"), ("y", "y", "canvas_h", "add_top")):
            marks = [F.col(f"{name}.{k}") for k in (f"{low}1", f"{low}2", f"b{high}1", f"b{high}2")]
            least, most = F.least(*marks) + F.col(shift), F.greatest(*marks) + F.col(shift)
            before = F.coalesce(F.when(least < gap, F.ceil(gap - least)), F.lit(0)).cast("long")
            d = d.withColumns({"_before": before, "_most": most}).withColumns({
                size: F.col(size) + F.col("_before"), shift: F.col(shift) + F.col("_before"),
                "_most": F.col("_most") + F.col("_before"),
            })
            after = F.when(
                F.col("_most") + gap > F.col(size) - 1, F.ceil(F.col("_most") + gap - F.col(size) + 1)
            )
            d = d.withColumn(size, F.col(size) + F.coalesce(after, F.lit(0)).cast("long"))
        d = d.withColumns({f"{name}_left": F.col("add_left"), f"{name}_top": F.col("add_top")})
    return d.drop("_before", "_most")


def end_caps(line: Column, dim_name: Column, config: DrawingConfig) -> Column:
    """array of the two cap lines of a rug bar; `line` is a struct in final coordinates."""
    x1, y1, x2, y2 = (line[k] for k in ("x1", "y1", "x2", "y2"))
    dx, dy = F.abs(x1 - x2), F.abs(y1 - y2)
    mid_x, mid_y = (x1 + x2) * 0.5, (y1 + y2) * 0.5
    vertical = F.try_divide(dx, mid_x) < F.try_divide(dy, mid_y)
    across = dy * F.lit(0.5 * config.dims_bar_ends_size_fraction)
    along = dx * F.lit(0.5 * config.dims_bar_ends_size_fraction)
    along = F.when(dim_name == "depth", along * 2.0).otherwise(along)
    caps = [
        F.when(vertical, _line(x - across, y, x + across, y)).otherwise(_line(x, y - along, x, y + along))
        for x, y in ((x1, y1), (x2, y2))
    ]
    return F.array(*caps)


def depth_text_point(line: Column, config: DrawingConfig) -> Column:
    """Left edge and middle of the depth text, from the line in final coordinates."""
    left = F.least(line["x1"], line["x2"])
    y = (line["y1"] + line["y2"]) * 0.5 + F.abs(line["x1"] - line["x2"]) * F.lit(config.dims_bar_ends_size_fraction)
    return F.struct((left * F.lit(0.4)).alias("x"), y.alias("y"))


def text_corner(x: Column, y: Column, w: Column, h: Column, x_align: Column, y_align: Column) -> Column:
    """Top left point of a text anchored at (x, y); null for an unknown alignment."""
    left = F.when(x_align == "center", x - w / 2.0).when(x_align == "right", x - w).when(x_align == "left", x)
    top = F.when(y_align == "center", y - h / 2.0).when(y_align == "bottom", y - h).when(y_align == "top", y)
    return F.when(left.isNotNull() & top.isNotNull(), F.struct(left.alias("x"), top.alias("y")))


def label_texts(dims: DataFrame, config: DrawingConfig, rug: bool = False) -> DataFrame:
    """Adds <dim>_text; `dims` has numeric width, height, depth as <dim>_in."""
    places = config.num_dim_decimal_pts
    texts = {n: inches_label(F.col(f"{n}_in"), places) for n in ORDER}
    if rug:
        texts = {
            "height": F.concat(feet_inches_label(F.col("height_in")), F.lit(" L")),
            "width": F.concat(feet_inches_label(F.col("width_in")), F.lit(" W")),
            "depth": F.concat(texts["depth"], F.lit("\n thickness")),
        }
    return dims.withColumns({f"{n}_text": t for n, t in texts.items()})


def annotate(layouts: DataFrame, config: DrawingConfig) -> DataFrame:
    """Place all three labels and grow the canvas: one row in, one row out, no exchange.

    Needs the layout columns, <dim>_text, font_size, line_margin, canvas_w, canvas_h
    (the bordered size), all in bordered coordinates.
    """
    d = layouts.withColumns({
        f"{n}_label": placed_label(
            n, F.col("center_x"), F.col("center_y"),
            text_width(F.col(f"{n}_text"), F.col("font_size")), text_height(F.col(f"{n}_text"), F.col("font_size")),
            F.col("line_margin"), config,
        )
        for n in ORDER
    })
    return grown_canvas(d, [f"{n}_label" for n in ORDER], config)


def shifted(label: str) -> Column:
    """A placed label in the coordinates it is drawn at (shifted by the border grown up to then)."""
    left, top = F.col(f"{label}_left"), F.col(f"{label}_top")
    moves = {"x1": left, "y1": top, "x2": left, "y2": top, "bx1": left, "by1": top, "bx2": left, "by2": top}
    return F.when(
        F.col(label).isNotNull(), F.struct(*[(F.col(f"{label}.{k}") + m).alias(k) for k, m in moves.items()])
    )
