"""Tile pyramids and their pictures: each zoom from the one below, and PNG tiles of coloured cells.

Defined results
  missing value    isn't counted in a mean; a block of missing values only has no cell. Of classes null is a value
  missing centre   a class block without the cell at its middle has no cell at that level
  repeated cells   means count each; of classes each is kept; of a picture the greatest (r, g, b, a) stands
  empty table      no rows, no tiles
  null place       a cell without row or column is left out; a null channel is 0
  negative places  tiles and blocks go down, as floors do
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.columns import nan_to_null

#: FIXED by the file format: its signature, and colour type 6 (red, green, blue, alpha) of 8 bits.
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
PNG_RGBA = 6


def _up(c: str, levels: int) -> Column:
    return F.shiftright(F.col(c).cast("bigint"), levels)  # arithmetic, so it goes down for negative places


def mean_pyramid(cells: DataFrame, levels: int, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, level, row, col, value, n) for levels 1 to levels: the mean of all base cells below, and how many those are.

    The first level is an aggregation that combines in the tasks. It is then dealt by the blocks of the highest level, and each
    further level, made from the one below, is grouped where it stands: two shuffles for any number of levels, the second of a
    quarter of the cells at most. A task's group is one block of the highest level, whose size the lattice bounds.
    """
    x = nan_to_null(F.col(value).cast("double"))
    by = [*keys, "__top_row", "__top_col"]
    first = cells.select(*keys, _up("row", 1).alias("row"), _up("col", 1).alias("col"), x.alias("__x")).dropna(subset=["row", "col", "__x"])
    first = first.groupBy(*keys, "row", "col").agg(F.sum("__x").alias("__sum"), F.count("*").alias("n"))
    at = first.select(*keys, _up("row", levels - 1).alias("__top_row"), _up("col", levels - 1).alias("__top_col"), "row", "col", "__sum", "n").repartition(*by)
    out = None
    for level in range(1, levels + 1):
        if level > 1:
            at = at.groupBy(*by, _up("row", 1).alias("__r"), _up("col", 1).alias("__c")).agg(F.sum("__sum").alias("__sum"), F.sum("n").alias("n")).withColumnsRenamed({"__r": "row", "__c": "col"})
        one = at.select(*keys, F.lit(level).alias("level"), "row", "col", (F.col("__sum") / F.col("n")).alias(value), "n")
        out = one if out is None else out.unionByName(one)
    return out


def class_pyramid(cells: DataFrame, levels: int, cls: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, level, row, col, cls) for levels 1 to levels: the cell at the middle of each block.

    The middle of a block of level k lies at 2^(k-1) in it, so a cell is the middle of at most one block of all levels:
    that of its row's and column's lowest set bit, if they agree. One scan, no shuffle.
    """
    low = [F.col(c).cast("bigint").bitwiseAND(-F.col(c).cast("bigint")) for c in ("row", "col")]
    level = (F.log2(low[0]) + 1).cast("int")
    middle = cells.where((low[0] == low[1]) & (low[0] > 0) & (low[0] <= 1 << (levels - 1))).withColumn("level", level)
    return middle.select(*keys, "level", F.expr("shiftright(cast(row as bigint), level)").alias("row"), F.expr("shiftright(cast(col as bigint), level)").alias("col"), cls)


def _filtered(image: np.ndarray) -> bytes:
    """Scanlines, each by the filter (none, left, above) whose bytes are least as signed numbers."""
    height, width, depth = image.shape
    flat = image.reshape(height, width * depth)
    left, above = flat.copy(), flat.copy()
    left[:, depth:] -= flat[:, :-depth]
    above[1:] -= flat[:-1]
    ways = np.stack([flat, left, above])
    best = np.abs(ways.view(np.int8).astype(np.int16)).sum(axis=2).argmin(axis=0)
    return np.concatenate((best[:, None].astype(np.uint8), ways[best, np.arange(height)]), axis=1).tobytes()


def encode_png(image: np.ndarray) -> bytes:
    """A PNG file of an array of rows x columns x (r, g, b, a)."""
    height, width, _ = image.shape

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, PNG_RGBA, 0, 0, 0)
    return PNG_SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(_filtered(image))) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """The array of a file that encode_png made; another kind of PNG, or a damaged one, is an error."""
    if data[:8] != PNG_SIGNATURE:
        raise ValueError("not a PNG file")
    at, size, body = 8, None, b""
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + n]
        if struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] != zlib.crc32(kind + part):
            raise ValueError("a damaged chunk")
        if kind == b"IHDR":
            width, height, *rest = struct.unpack(">IIBBBBB", part)
            if rest != [8, PNG_RGBA, 0, 0, 0]:
                raise ValueError("only 8 bits of red, green, blue and alpha are read")
            size = (height, width)
        elif kind == b"IDAT":
            body += part
        at += 12 + n
    height, width = size
    lines = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, 1 + 4 * width)
    out = lines[:, 1:].copy()
    for k in range(height):
        way = lines[k, 0]
        if way == 1:
            out[k] = np.cumsum(out[k].reshape(width, 4), axis=0, dtype=np.uint8).ravel()
        elif way == 2 and k:
            out[k] += out[k - 1]
        elif way > 2:
            raise ValueError("a filter that isn't used here")
    return out.reshape(height, width, 4)


def render_tiles(colored: DataFrame, side: int, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, ty, tx, png) of cells (row, col, r, g, b, a): tiles of side x side pixels, transparent where there is no cell.

    Cells are packed into one number each before the shuffle; a group is one tile, side x side pixels at most.
    """
    place = (F.pmod("row", F.lit(side)) * side + F.pmod("col", F.lit(side))).cast("int")
    rgba = sum(F.coalesce(F.col(c), F.lit(0)).cast("bigint") * (1 << 8 * k) for k, c in enumerate("abgr"))  # so that the greatest stands by r, then g, b, a
    packed = colored.dropna(subset=["row", "col"]).select(*keys, F.floor(F.col("row") / side).cast("bigint").alias("ty"), F.floor(F.col("col") / side).cast("bigint").alias("tx"), place.alias("__at"), rgba.alias("__rgba"))
    one = packed.groupBy(*keys, "ty", "tx", "__at").agg(F.max("__rgba").alias("__rgba"))
    tiles = one.groupBy(*keys, "ty", "tx").agg(F.collect_list(F.struct("__at", "__rgba")).alias("__cells"))
    names = [*keys, "ty", "tx"]
    schema = ", ".join(f"`{n}` {tiles.schema[n].dataType.simpleString()}" for n in names) + ", png binary"
    return tiles.mapInArrow(partial(_pictures, names=names, side=side), schema)


def _pictures(batches: Iterator[pa.RecordBatch], names: list[str], side: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        files = []
        cells = batch.column(len(names))
        for k in range(batch.num_rows):
            one = cells[k].values
            image = np.zeros(side * side, ">u4")
            image[one.field(0).to_numpy()] = one.field(1).to_numpy()
            files.append(encode_png(image.view(np.uint8).reshape(side, side, 4)))
        yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(files, pa.binary())], names=[*names, "png"])


def read_pixels(tiles: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, row, col, r, g, b, a) of the pixels of tiles (keys, ty, tx, png), transparent ones too."""
    names = list(keys)
    kinds = [f"`{n}` {tiles.schema[n].dataType.simpleString()}" for n in names]
    schema = ", ".join([*kinds, "row bigint", "col bigint", *[f"{c} int" for c in "rgba"]])
    return tiles.select(*names, "ty", "tx", "png").mapInArrow(partial(_pixels, n_keys=len(names)), schema)


def _pixels(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            ty, tx, data = (batch.column(n_keys + j)[k].as_py() for j in range(3))
            image = decode_png(data)
            height, width, _ = image.shape
            row, col = (x.ravel().astype(np.int64) for x in np.indices((height, width)))
            own = [pa.array([batch.column(j)[k].as_py()] * (height * width), batch.column(j).type) for j in range(n_keys)]
            channels = [pa.array(image[:, :, j].ravel().astype(np.int32)) for j in range(4)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(row + ty * height), pa.array(col + tx * width), *channels], names=[*batch.schema.names[:n_keys], "row", "col", *"rgba"])
