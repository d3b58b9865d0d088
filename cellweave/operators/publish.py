"""Products: stitching tiles, colours, legends, granule bands and catalogue documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.columns import NODATA_CLASS, id_color, nan_to_null, piecewise

#: FIXED: a ramp from dark to light, as (share, red, green, blue).
RAMP = ((0.0, 68, 1, 84), (0.25, 59, 82, 139), (0.5, 33, 145, 140), (0.75, 94, 201, 98), (1.0, 253, 231, 37))
EDGE = 1e-6
# FIXED: the colour of classes that a map leaves open.
GREY = 128
#: A band of granule numbers has 16 bits: 0 is no granule, 65535 no data.
MOST_GRANULES = 65_534


def stitch(blocks: DataFrame, keys: Sequence[str] = ("row", "col")) -> DataFrame:
    """Blocks as one tile; a cell that two blocks deliver is an error, found by the aggregation that joins them."""
    values = [c for c in blocks.columns if c not in keys]
    one = blocks.groupBy(*keys).agg(F.count("*").alias("__n"), *[F.max(c).alias(c) for c in values])
    told = F.when(F.col("__n") > 1, F.raise_error(F.lit("two blocks deliver the same cell"))).otherwise(F.lit(True))
    return one.where(told).drop("__n")


def filled(cells: DataFrame, tile: DataFrame, cls: Sequence[str], keys: Sequence[str] = ("row", "col")) -> DataFrame:
    """All cells of the tile; classes that nothing delivers are no-data."""
    out = tile.join(cells, list(keys), "left")
    return out.select(*[F.coalesce(F.col(c), F.lit(NODATA_CLASS)).alias(c) if c in cls else F.col(c) for c in out.columns])


def categorical_colors(cells: DataFrame, cls: str, colors: dict[int, tuple[int, int, int]], on_unmapped: str = "palette") -> DataFrame:
    """Adds r, g, b, a: named colours, else a palette colour, grey, transparent, or an error (fail); no-data and class 0 are transparent.

    Colours are one map of at most 65,534 entries, so no join and no CASE a class.
    """
    if on_unmapped not in ("palette", "grey", "transparent", "fail"):
        raise ValueError(f"unknown way for classes without a colour: {on_unmapped}")
    shown = F.col(cls).isNotNull() & ~F.col(cls).isin(0, NODATA_CLASS)
    table = F.create_map(*[x for k, rgb in colors.items() for x in (F.lit(int(k)), F.array(*map(F.lit, rgb)))]) if colors else None
    named = F.try_element_at(table, F.col(cls).cast("int")) if colors else F.lit(None).cast("array<int>")
    rest = {
        "palette": id_color(F.col(cls)),
        "grey": F.array(*[F.lit(GREY)] * 3),
        "transparent": F.lit(None).cast("array<int>"),
        "fail": F.raise_error(F.concat(F.lit("no colour for class "), F.col(cls).cast("string"))).cast("array<int>"),
    }[on_unmapped]
    out = cells.withColumn("__rgb", F.when(shown, F.coalesce(named, rest)))
    return out.select(*cells.columns, *[F.coalesce(F.col("__rgb")[k], F.lit(0)).alias(c) for k, c in enumerate("rgb")], F.when(F.col("__rgb").isNull(), 0).otherwise(255).alias("a"))


def continuous_colors(cells: DataFrame, value: str, domain: tuple[float, float], ramp: Sequence[tuple] = RAMP, clip: bool = True) -> DataFrame:
    """Adds r, g, b, a along the ramp; missing values, and those out of the domain unless clipped, are transparent."""
    lo, hi = domain
    share = (F.col(value) - lo) / (hi - lo)
    edge = EDGE * max(abs(lo), abs(hi), hi - lo)
    shown = F.col(value).isNotNull() & (F.lit(True) if clip else F.col(value).between(lo - edge, hi + edge))
    channels = [F.coalesce(F.when(shown, F.rint(piecewise(share, [(s[0], s[k + 1]) for s in ramp])).cast("int")), F.lit(0)).alias(c) for k, c in enumerate("rgb")]
    return cells.select(*cells.columns, *channels, F.when(shown, 255).otherwise(0).alias("a"))


def alpha_from(value: Column, domain: tuple[float, float], alpha: tuple[int, int] = (0, 255)) -> Column:
    """Opacity along a domain; missing values are transparent."""
    return F.coalesce(F.rint(piecewise(value, [(domain[0], alpha[0]), (domain[1], alpha[1])])).cast("int"), F.lit(0))


def granule_band(cells: DataFrame, granules: DataFrame, acquired: str = "acquired") -> DataFrame:
    """Adds granule_no, the 1-based place of the cell's granule among those delivered; granules: (granule_id, acquired), the lowest id of equals."""
    one = granules.groupBy(acquired).agg(F.min("granule_id").alias("granule_id"))
    met = cells.join(one, acquired, "left")
    used = met.where(F.col("granule_id").isNotNull()).select("granule_id").distinct().persist()
    n = used.count()
    if n > MOST_GRANULES:
        raise ValueError(f"{n} granules are delivered, a band holds {MOST_GRANULES}")
    numbered = used.withColumn("granule_no", F.row_number().over(Window.orderBy("granule_id")))  # MOST_GRANULES rows at most
    return met.join(F.broadcast(numbered), "granule_id", "left").withColumn("granule_no", F.coalesce("granule_no", F.lit(0)))


#: Bins a pass, and how many values a bin may hold to be read.
BINS, FEW = 4096, 10_000


def values_at(cells: DataFrame, value: str, ranks: Sequence[int]) -> list[float]:
    """The values at 0-based ranks of the ascending present values, exactly.

    Each pass is one histogram of BINS bins between the bounds known so far, a small aggregation; the bin that holds the rank is
    looked into next, until it has one value or FEW rows. No task sorts all values.
    """
    x = nan_to_null(F.col(value).cast("double"))
    rows, found, seen = cells.select(x.alias("x")).where("x IS NOT NULL"), [], {}
    for rank in ranks:
        lo, hi, before = None, None, 0
        while True:
            if (lo, hi) not in seen:
                inside = rows if lo is None else rows.where(F.col("x").between(lo, hi))
                if lo is None:
                    b = inside.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
                    at = F.least(F.floor((F.col("x") - b.lo) / ((b.hi - b.lo) or 1.0) * BINS), F.lit(BINS - 1))
                else:
                    at = F.least(F.floor((F.col("x") - lo) / (hi - lo) * BINS), F.lit(BINS - 1))
                bins = inside.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("bin").collect()
                seen[lo, hi] = bins
            upto = before
            for b in seen[lo, hi]:
                if upto + b.n > rank:
                    break
                upto += b.n
            if b.lo == b.hi:
                found.append(b.lo)
                break
            if b.n <= FEW or (b.lo, b.hi) == (lo, hi):
                key = (b.lo, b.hi, "all")
                if key not in seen:
                    seen[key] = [r.x for r in rows.where(F.col("x").between(b.lo, b.hi)).orderBy("x").collect()]
                found.append(seen[key][rank - upto])
                break
            lo, hi, before = b.lo, b.hi, upto
    return found


def stretch(cells: DataFrame, value: str, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """(lo, hi) to show values between: two percentiles, interpolated; 0..1 of nothing, one wide if flat."""
    n = cells.where(nan_to_null(F.col(value).cast("double")).isNotNull()).count()
    ends = [0.0, 1.0]
    if n:
        at = [share * (n - 1) for share in (low, high)]
        v = values_at(cells, value, [r for a in at for r in (int(a), min(int(a) + 1, n - 1))])
        ends = [v[2 * k] + (a - int(a)) * (v[2 * k + 1] - v[2 * k]) for k, a in enumerate(at)]
    lo, hi = ends
    return cells.sparkSession.createDataFrame([(lo, hi if hi > lo else lo + 1)], "lo double, hi double")


def legend(classes: list[tuple[int, str]], colors: dict[int, tuple[int, int, int]]) -> dict:
    """A legend document."""
    return {"type": "classes", "entries": [{"id": k, "name": n, "color": "#%02x%02x%02x" % tuple(colors[k])} for k, n in sorted(classes) if k in colors]}


def extent(items: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """The box and times that items cover."""
    return items.agg(F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"), F.min(start).alias("start"), F.max(end).alias("end"))


def item_document(item_id: str, box: Sequence[float], start: str, end: str, assets: dict[str, str], classes: list[dict] | None = None) -> dict:
    """A catalogue item in the public STAC layout."""
    w, s, e, n = box
    ring = [[w, s], [e, s], [e, n], [w, n], [w, s]]
    properties = {"datetime": None, "start_datetime": start, "end_datetime": end} | ({"classification:classes": classes} if classes else {})
    return {"type": "Feature", "stac_version": "1.0.0", "id": item_id, "bbox": list(box), "geometry": {"type": "Polygon", "coordinates": [ring]}, "properties": properties, "assets": {k: {"href": v} for k, v in sorted(assets.items())}, "links": []}
