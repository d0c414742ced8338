"""Components of masks tile by tile.

A mask is cut into square tiles. The runs of one tile are labelled in one call (a
bounded number, and a batch holds many tiles); what remains is the small graph of tile
components that touch across tile borders, which goes to the table algorithm. A
picture of one tile needs no such step, and a huge picture is just many tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calipers.operators.components import component_labels
from calipers.runtime import settle, ship

TILE = 256  # pixels; a tile holds at most 256 * 128 runs
#: Stretches of pixels that are smoothed at a time, cells of the grid for each pixel at most, and rows given back at a time.
STRETCHES, SPARSE, ROWS_BACK = 16_384, 8, 65_536
#: Runs for each pixel of a batch from which its pixels are sorted before they are packed.
FRAGMENTS = 0.25


def run_id() -> Column:
    """Runs numbered by (row, first column); the least one of a component is its first pixel."""
    return F.col("y").cast("long") * 2**32 + F.col("x0")


def _begins(table: pa.Table, key: list[str]) -> np.ndarray:
    """Where a new group begins; rows of a group stand together."""
    new = np.ones(table.num_rows, dtype=bool)
    values = [table.column(c).to_numpy() for c in key]
    new[1:] = np.any([v[1:] != v[:-1] for v in values], axis=0)
    return np.flatnonzero(new)


def whole_groups(
    batches: Iterator[pa.RecordBatch], key: list[str], least: int = 2 * TILE * TILE, alike: bool = False
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The rows of a partition that is sorted by `key`, about `least` at a time, cut where a group ends, with their groups' numbers.

    Numbers that are null are groups of their own each, unless nulls are `alike`.
    """
    rest: list[pa.RecordBatch] = []
    held = 0

    def begins(table: pa.Table) -> np.ndarray:
        return np.flatnonzero(np.append(True, _kept_apart(table, key))) if alike else _begins(table, key)

    def numbered(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        number = np.zeros(table.num_rows, dtype=np.int64)
        number[begins(table)[1:]] = 1
        return table, np.cumsum(number)

    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        held += batch.num_rows
        if held >= least:
            table = pa.Table.from_batches(rest)
            last = int(begins(table)[-1])
            if last:
                yield numbered(table.slice(0, last))
                rest, held = table.slice(last).to_batches(), table.num_rows - last
    if held:
        yield numbered(pa.Table.from_batches(rest))


def _blurred(key: np.ndarray, value: np.ndarray, step: int, column: np.ndarray) -> np.ndarray:
    """Twice the value plus both neighbours at `step` keys; a missing neighbour is the other one, or else the pixel itself.

    The keys ascend; a step to the side stays in the row, as the outermost columns have no neighbour beyond.
    """
    def beside(shift: int, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(key, key + shift), len(key) - 1)
        return (key[at] == key + shift) & inside, value[at]

    there = np.ones(len(key), dtype=bool)
    (has_back, back), (has_ahead, ahead) = (
        beside(-step, column > 0 if step == 1 else there), beside(step, column < TILE + 1 if step == 1 else there)
    )
    first = np.where(has_back, back, np.where(has_ahead, ahead, value))
    second = np.where(has_ahead, ahead, np.where(has_back, back, value))
    return 2 * value + first + second


def _smoothed(tile: np.ndarray, row: np.ndarray, column: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Both steps of the smoothing, on a grid of the box that the pixels of each tile fill.

    The pixels ascend by tile, row and column. Where a pixel comes twice or the boxes are mostly empty, places are searched for.
    """
    width = TILE + 2
    at = (tile * width + row) * width + column
    plain = bool((at[1:] > at[:-1]).all())
    begin = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
    number = np.cumsum(np.append(False, tile[1:] != tile[:-1]))
    top, left = np.minimum.reduceat(row, begin), np.minimum.reduceat(column, begin)
    wide = np.maximum.reduceat(column, begin) - left + 3
    cells = (np.maximum.reduceat(row, begin) - top + 3) * wide
    if not plain or cells.sum() > SPARSE * len(v):
        # a row above or below belongs to another tile only beyond the halo, where no own pixel looks
        return _blurred(at, _blurred(at, v, width, column), 1, column)
    step = wide[number]
    place = (np.cumsum(cells) - cells)[number] + (row - top[number] + 1) * step + column - left[number] + 1
    there, grid = np.zeros(int(cells.sum()), dtype=bool), np.zeros(int(cells.sum()), dtype=np.int64)
    there[place] = True
    for aside in (step, 1):
        grid[place] = v
        has_back, back, has_ahead, ahead = there[place - aside], grid[place - aside], there[place + aside], grid[place + aside]
        first = np.where(has_back, back, np.where(has_ahead, ahead, v))
        second = np.where(has_ahead, ahead, np.where(has_back, back, v))
        v = 2 * v + first + second
    return v


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pixels that follow each other in a row of a tile as one row, as they come; the outermost ones of a tile for its neighbour, too."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
        image = batch.column("image_id").to_numpy(zero_copy_only=False)
        column = x % TILE
        new = np.ones(len(x), dtype=bool)
        new[1:] = (image[1:] != image[:-1]) | (y[1:] != y[:-1]) | (x[1:] != x[:-1] + 1) | (column[1:] == 0)
        begin, every = np.flatnonzero(new), np.arange(len(x))
        for own, rows, ends, beside in (
            (every, begin, np.append(begin, len(x)), 0),
            *((edge, edge, np.arange(len(edge) + 1), side) for edge, side in (
                (np.flatnonzero(column == 0), -1), (np.flatnonzero(column == TILE - 1), 1)
            )),
        ):
            if len(rows):
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), batch.column("v").take(pa.array(own)) if beside else batch.column("v"))
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).take(pa.array(rows)) for c in ("image_id", "y", "x")),
                    pa.array((x[rows] // TILE + beside).astype(np.int32)), lists,
                ], ["image_id", "y", "x", "tx", "v"])


def smooth_tiles(pixels: DataFrame) -> DataFrame:
    """(image_id, x, y, v): sixteen times the mean of v with weights 1 2 1 both ways; the picture is mirrored at its edges.

    Tiles get the pixels next to their border as well (a halo), so one exchange is enough, and a picture of
    any size is many tiles. Pixels that come one after the other in a row are moved and sorted as one. A missing pixel counts as an edge.
    """
    ship(pixels.sparkSession)
    near = F.sequence(*(F.floor((F.col("y") + d) / TILE).cast("int") for d in (-1, 1)))
    kinds = {f.name: f.dataType.simpleString() for f in pixels.schema.fields}
    packed = pixels.select("image_id", "x", "y", F.col("v").cast("long").alias("v")).where("x is not null and y is not null").mapInArrow(
        _stretches, f"image_id {kinds['image_id']}, y {kinds['y']}, x {kinds['x']}, tx int, v array<long>"
    )
    dealt = packed.withColumn("ty", F.explode(near)).where("tx >= 0 and ty >= 0")
    key = ["image_id", "ty", "tx"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, tile in whole_groups(batches, key, STRETCHES):
            lists = table.column("v").combine_chunks()
            n = lists.value_lengths().to_numpy()
            of = np.repeat(np.arange(len(n)), n)
            x0, y0, ty, tx = (table.column(c).to_numpy().astype(np.int64) for c in ("x", "y", "ty", "tx"))
            x = x0[of] + np.arange(len(of)) - (np.cumsum(n) - n)[of]
            y, v, tile = y0[of], lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), tile[of]
            row, column = y - (ty * TILE - 1)[of], x - (tx * TILE - 1)[of]
            order = np.lexsort((column, row, tile)) if _crossed(tile, row, column) else None
            if order is not None:
                of, x, y, v, tile, row, column = (c[order] for c in (of, x, y, v, tile, row, column))
            across = _smoothed(tile, row, column, v)
            own = (row > 0) & (row <= TILE) & (column > 0) & (column <= TILE)
            if not own.all():
                of, x, y, across = of[own], x[own], y[own], across[own]
            image = table.column("image_id").combine_chunks().take(pa.array(of))
            out = pa.table([image, *(pa.array(c.astype(table.schema.field(k).type.to_pandas_dtype())) for k, c in (("x", x), ("y", y))), pa.array(across)],
                           ["image_id", "x", "y", "v"])
            yield from out.to_batches(max_chunksize=ROWS_BACK)

    return dealt.repartition(*key).sortWithinPartitions(*key, "y", "x").mapInArrow(
        run, f"image_id {kinds['image_id']}, x {kinds['x']}, y {kinds['y']}, v long"
    )


def _crossed(tile: np.ndarray, row: np.ndarray, column: np.ndarray) -> bool:
    """Whether stretches overlap, so that their pixels do not ascend by tile, row and column."""
    same = (tile[1:] == tile[:-1]) & (row[1:] == row[:-1])
    return bool((same & (column[1:] < column[:-1])).any())


def _kept_apart(batch: pa.Table | pa.RecordBatch, key: list[str]) -> np.ndarray:
    """Whether each row but the first differs from the one before it in the key; nulls are alike."""
    differs = np.zeros(max(batch.num_rows - 1, 0), dtype=bool)
    for c in key:
        column = batch.column(c)
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if column.null_count:
            column = column.dictionary_encode(null_encoding="encode").indices
        values = column.to_numpy(zero_copy_only=False)
        differs |= values[1:] != values[:-1]
    return differs


def _by_row(batch: pa.RecordBatch, key: list[str], x: np.ndarray) -> np.ndarray:
    """The order of a batch's pixels by key and column; equal keys stand together, in whatever order."""
    codes = [batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False) for c in key]
    number = codes[0].astype(np.int64)
    for code in codes[1:]:  # a batch is bounded, and each number is below its rows
        number = np.unique(number, return_inverse=True)[1] * (int(code.max()) + 1) + code
    return np.lexsort((x, number))


def _packed(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.RecordBatch]:
    """Pixels of a batch that stand one beside the other in a row as one run."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = batch.column("x").to_numpy(zero_copy_only=False)
        new = np.append(True, _kept_apart(batch, key) | (x[1:] != x[:-1] + 1))
        if new.sum() > FRAGMENTS * len(x):  # pixels that do not come row by row: those of a row are brought together first
            batch = batch.take(pa.array(_by_row(batch, key, x)))
            x = batch.column("x").to_numpy(zero_copy_only=False)
            new = np.append(True, _kept_apart(batch, key) | (x[1:] != x[:-1] + 1))
        begin = np.flatnonzero(new)
        first, last = pa.array(begin), pa.array(np.append(begin[1:], len(x)) - 1)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(first) for c in key), batch.column("x").take(first), batch.column("x").take(last)], [*key, "x0", "x1"]
        )


def pixel_runs(mask: DataFrame, *more: str) -> DataFrame:
    """Horizontal runs of a mask: (image_id, y, *more, x0, x1), apart for each value of `more`.

    Pixels that come one after the other are joined before they are moved, so that runs are sorted and not pixels. A pixel
    that comes several times has a place in the row each time: place and x together tell the runs.
    """
    ship(mask.sparkSession)
    key = ["image_id", "y", *more]
    kinds = {f.name: f.dataType.simpleString() for f in mask.schema.fields}
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in key), f"x0 {kinds['x']}", f"x1 {kinds['x']}"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, row in whole_groups(batches, key, alike=True):
            x0, x1 = (table.column(c).to_numpy().astype(np.int64) for c in ("x0", "x1"))
            same = row[1:] == row[:-1]
            twice = np.zeros(int(row[-1]) + 1, dtype=bool)
            twice[row[1:][same & (x0[1:] <= x1[:-1])]] = True
            plain = np.flatnonzero(~twice[row])
            new = np.append(True, (row[plain][1:] != row[plain][:-1]) | (x0[plain][1:] != x1[plain][:-1] + 1))[: len(plain)]
            at, begin = plain[new], np.flatnonzero(new)
            low, high = x0[at], x1[plain[np.append(begin[1:], len(plain)) - 1]] if len(plain) else x1[:0]
            if twice.any():
                rest = np.flatnonzero(twice[row])
                n = (x1 - x0 + 1)[rest]
                x = np.repeat(x0[rest] - np.cumsum(n) + n, n) + np.arange(n.sum())
                of = np.repeat(rest, n)
                order = np.lexsort((x, row[of]))
                x, of = x[order], of[order]
                place = np.arange(len(x)) - np.searchsorted(row[of], row[of])
                order = np.lexsort((x, x - place, row[of]))
                x, of, island = x[order], of[order], (x - place)[order]
                first = np.append(True, (row[of][1:] != row[of][:-1]) | (island[1:] != island[:-1]))
                begin = np.flatnonzero(first)
                at = np.append(at, of[begin])
                low, high = np.append(low, x[begin]), np.append(high, x[np.append(begin[1:], len(x)) - 1])
            kind = table.schema.field("x0").type
            told = table.select(key).take(pa.array(at)).append_column("x0", pa.array(low, kind)).append_column("x1", pa.array(high, kind))
            yield from told.combine_chunks().to_batches(max_chunksize=ROWS_BACK)

    packed = mask.select(*key, "x").where("x is not null").mapInArrow(lambda batches: _packed(batches, key), schema)
    return packed.repartition(*key).sortWithinPartitions(*key, "x0", "x1").mapInArrow(merge, schema)


def _touching(tile: np.ndarray, y: np.ndarray, x0: np.ndarray, x1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of runs in neighbouring rows that overlap; runs sorted by tile, row and column."""
    width = TILE + 2
    row = (tile * (TILE + 1) + y) * width
    below = row + width
    first = np.searchsorted(row + x1, below + x0)
    last = np.searchsorted(row + x0, below + x1, side="right")
    count = np.maximum(last - first, 0)
    a = np.repeat(np.arange(len(y)), count)
    b = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    return a, b


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Let joined runs share the least label, in place; `label` holds the index of each run's root, before and after."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return
        la, lb = la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label[:] = label[label]


def _spread(tile: np.ndarray, y: np.ndarray, x0: np.ndarray, x1: np.ndarray) -> np.ndarray:
    """Index of the first run of each run's component; runs sorted by tile, row and column."""
    label = np.arange(len(y))
    _unite(label, *_touching(tile, y, x0, x1))
    return label


def _grown(
    tile: np.ndarray, y: np.ndarray, x0: np.ndarray, x1: np.ndarray, level: np.ndarray, cutoffs: list[int]
) -> np.ndarray:
    """For each run and cutoff, the index of the first run of its component then, or -1 before it enters.

    The merge forest of the tile: edges are taken by the level at which both ends are there, each once.
    """
    a, b = _touching(tile, y, x0, x1)
    beside = np.flatnonzero((tile[1:] == tile[:-1]) & (y[1:] == y[:-1]) & (x1[:-1] + 1 == x0[1:]))
    a, b = np.append(a, beside), np.append(b, beside + 1)
    both = np.maximum(level[a], level[b])
    label, out, before = np.arange(len(y)), [], np.iinfo(np.int64).min
    for cutoff in cutoffs:
        now = (both > before) & (both <= cutoff)
        _unite(label, a[now], b[now])
        out.append(np.where(level <= cutoff, label, -1))
        before = cutoff
    return np.stack(out, axis=1)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _tile_labels(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for ys, x0s, x1s in batches:
        sizes = ys.str.len().to_numpy()
        y, x0, x1 = (np.concatenate(c.to_list()).astype(np.int64) for c in (ys, x0s, x1s))
        label = _spread(np.repeat(np.arange(len(sizes)), sizes), y % TILE, x0 % TILE, x1 % TILE)
        start = np.cumsum(sizes) - sizes
        yield pd.Series([label[s : s + n] - s for s, n in zip(start, sizes)])


def _tile_forest(cutoffs: list[int]):
    """The labels of each run of a tile at each cutoff, run by run."""
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def labels(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for columns in batches:
            sizes = columns[0].str.len().to_numpy()
            y, x0, x1, level = (np.concatenate(c.to_list()).astype(np.int64) for c in columns)
            found = _grown(np.repeat(np.arange(len(sizes)), sizes), y % TILE, x0 % TILE, x1 % TILE, level, cutoffs)
            start = np.cumsum(sizes) - sizes
            yield pd.Series([
                np.where(own < 0, -1, own - s).ravel() for s, own in ((s, found[s: s + n]) for s, n in zip(start, sizes))
            ])

    return labels


def _in_tiles(runs: DataFrame, *more: str) -> DataFrame:
    """Runs cut at the tile borders, with tile column tx and tile row ty."""
    cut = runs.select(
        "image_id", "y", "x0", "x1", *more, F.floor(F.col("y") / TILE).alias("ty"),
        F.explode(F.sequence(F.floor(F.col("x0") / TILE), F.floor(F.col("x1") / TILE))).alias("tx"),
    )
    return cut.withColumns({
        "x0": F.greatest("x0", F.col("tx") * TILE).cast("int"),
        "x1": F.least("x1", F.col("tx") * TILE + TILE - 1).cast("int"),
    })


def _across_borders(pieces: DataFrame, label: str = "label") -> DataFrame:
    """Pairs of labels of pieces that touch over a tile border: to the right or downwards."""
    inner = lambda c: F.pmod(F.col(c), F.lit(TILE))
    left = pieces.where(inner("x1") == TILE - 1).select(
        "image_id", "y", (F.col("x1") + 1).alias("x0"), F.col(label).alias("a"))
    right = pieces.where(inner("x0") == 0).select("image_id", "y", "x0", F.col(label).alias("b"))
    upper = pieces.where(inner("y") == TILE - 1).select(
        "image_id", "tx", (F.col("y") + 1).alias("y"), F.col("x0").alias("ax0"), F.col("x1").alias("ax1"),
        F.col(label).alias("a"))
    lower = pieces.where(inner("y") == 0).select("image_id", "tx", "y", "x0", "x1", F.col(label).alias("b"))
    sideways = left.join(right.hint("merge"), on=["image_id", "y", "x0"]).select("image_id", "a", "b")
    down = upper.join(lower.hint("merge"), on=["image_id", "tx", "y"]).where("ax0 <= x1 and x0 <= ax1").select("image_id", "a", "b")
    return sideways.unionByName(down).distinct()


def label_runs(runs: DataFrame) -> DataFrame:
    """Runs, cut at tile borders, with the label of their component (4-neighbourhood)."""
    packed = _in_tiles(runs).groupBy("image_id", "ty", "tx").agg(
        F.array_sort(F.collect_list(F.struct("y", "x0", "x1"))).alias("r")
    )
    roots = packed.select("image_id", "tx", "r", _tile_labels("r.y", "r.x0", "r.x1").alias("root"))
    pieces = roots.select(
        "image_id", "tx", F.inline(F.transform("r", lambda p, i: F.struct(
            p["y"].alias("y"), p["x0"].alias("x0"), p["x1"].alias("x1"),
            F.get("r", F.get("root", i)).alias("head"),
        ))),
    ).select(
        "image_id", "tx", "y", "x0", "x1",
        (F.col("head.y").cast("long") * 2**32 + F.col("head.x0")).alias("label"),
    )
    pieces = settle(pieces)
    found = component_labels(_across_borders(pieces), "image_id")
    if found is None:
        return pieces.select("image_id", "y", "x0", "x1", "label")
    whole = found.select("image_id", F.col("node").alias("label"), F.col("label").alias("least"))
    return pieces.join(whole.hint("merge"), on=["image_id", "label"], how="left").select(
        "image_id", "y", "x0", "x1", F.coalesce("least", "label").alias("label")
    )


def forest_runs(runs: DataFrame, cutoffs: list[int]) -> tuple[DataFrame, DataFrame | None]:
    """Components of a mask that grows from cutoff to cutoff, in one labelling pass.

    runs: image_id, y, x0, x1, level (the first cutoff at which the run is there). Gives the runs, cut at
    tile borders, with `labels`: the label of the run's tile component at each cutoff, null before it enters; and, where
    components cross tile borders, (image_id, cutoff, label, least): the label of the whole component.
    """
    packed = _in_tiles(runs, "level").groupBy("image_id", "ty", "tx").agg(
        F.array_sort(F.collect_list(F.struct("y", "x0", "x1", "level"))).alias("r")
    )
    roots = packed.select("image_id", "tx", "r", _tile_forest(cutoffs)("r.y", "r.x0", "r.x1", "r.level").alias("root"))

    def label(i: Column, k: int) -> Column:
        root = F.get("root", i * len(cutoffs) + k)
        head = F.get("r", root)
        return F.when(root >= 0, head["y"].cast("long") * 2**32 + head["x0"])

    pieces = settle(roots.select("image_id", "tx", F.inline(F.transform("r", lambda p, i: F.struct(
        *(p[c].alias(c) for c in ("y", "x0", "x1", "level")),
        F.array(*(label(i, k) for k in range(len(cutoffs)))).alias("labels"),
    )))))
    pairs = F.arrays_zip(F.array(*map(F.lit, cutoffs)).alias("cutoff"), F.col("a"), F.col("b"))
    edges = _across_borders(pieces, "labels").select("image_id", F.inline(pairs)).where("a is not null and b is not null")
    found = component_labels(
        edges.select(F.struct("image_id", "cutoff").alias("image_id"), "a", "b").distinct(), "image_id"
    )
    whole = None if found is None else found.select(
        "image_id.image_id", "image_id.cutoff", F.col("node").alias("label"), F.col("label").alias("least")
    )
    return pieces, whole
