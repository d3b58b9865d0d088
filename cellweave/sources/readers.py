"""Files as tables: scans by pattern, readers by collection, class tables, band aliases, and the frozen index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.columns import nan_to_null


def affixes(pattern: str) -> tuple[str, str]:
    """What stands before the first and after the last wildcard of a pattern's last part."""
    base = pattern.rsplit("/", 1)[-1]
    first = min((base.find(c) for c in "*?[{" if c in base), default=-1)
    if first < 0:
        raise ValueError(f"{pattern}: a pattern needs a wildcard, it names the granule")
    return base[:first], base[max(base.rfind(c) for c in "*?]}") + 1 :]


def granule_of(path: Column, pattern: str) -> Column:
    """The granule: what the wildcards of the pattern matched."""
    before, after = affixes(pattern)
    base = F.element_at(F.split(path, "/"), -1)
    return F.substring(base, F.lit(len(before) + 1), F.length(base) - len(before) - len(after))


def stamp_of(name: Column) -> Column:
    """The first yyyymmddThhmmss of a name as a time; NULL if it has none or no calendar has it."""
    found = F.regexp_extract(name, r"(\d{8}T\d{6})", 1)
    return F.try_to_timestamp(found, F.lit("yyyyMMdd'T'HHmmss"))


def scan(spark: SparkSession, patterns: Mapping[tuple[str, str], str], updated_since: datetime | None = None) -> DataFrame:
    """(granule_id, collection, assets, modified, bytes) of files, found by a pattern for each (collection, asset).

    Only names, sizes and times are listed: the files' contents aren't read. Two files of one granule and asset are an error.
    """
    out = None
    for (collection, asset), pattern in patterns.items():
        files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime", "length")
        if updated_since is not None:
            files = files.where(F.col("modificationTime") >= F.lit(updated_since))
        rows = files.select(granule_of(F.col("path"), pattern).alias("granule_id"), F.lit(collection).alias("collection"), F.lit(asset).alias("asset"), "path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("nothing to scan")
    listed = F.collect_list(F.struct("asset", "path"))  # a few assets a granule; map_from_entries refuses one that comes twice
    return out.groupBy("granule_id", "collection").agg(F.map_from_entries(listed).alias("assets"), F.max("modified").alias("modified"), F.sum("bytes").alias("bytes"))


@dataclass(frozen=True)
class LongRows:
    """Reads pixels as long rows of Parquet: granule, s_row, s_col and a column a variable. Fill values and NaN become NULL."""

    variables: tuple[str, ...]
    fills: Mapping[str, float] = field(default_factory=dict)
    keys: tuple[str, ...] = ("granule", "s_row", "s_col")

    def read(self, spark: SparkSession, path: str, variables: Sequence[str]) -> DataFrame:
        rows = spark.read.parquet(path)
        missing = [v for v in (*self.keys, *variables) if v not in rows.columns or v not in (*self.keys, *self.variables)]
        if missing:
            raise KeyError(f"{path} has no variable {missing}")
        kinds = dict(rows.dtypes)

        def clean(v: str) -> Column:
            x = F.col(v)
            if v in self.fills:
                x = F.when(x != F.lit(self.fills[v]), x)
            return (nan_to_null(x) if kinds[v] in ("float", "double") else x).alias(v)

        return rows.select(*self.keys, *[clean(v) for v in variables])


def class_table(spark: SparkSession, path: str, key: str, attributes: Sequence[str] = ()) -> DataFrame:
    """A class table from CSV (with a header) or Parquet: the key, then the attributes. A missing column is an error, a key that comes twice too."""
    rows = spark.read.csv(path, header=True, inferSchema=True) if path.endswith(".csv") else spark.read.parquet(path)
    missing = [c for c in (key, *attributes) if c not in rows.columns]
    if missing:
        raise KeyError(f"{path} has no column {missing}")
    rows = rows.select(key, *attributes)
    twice = rows.groupBy(key).count().where("count > 1").limit(3).collect()  # to say which
    if twice:
        raise ValueError(f"{path}: {[r[0] for r in twice]} come twice")
    return rows


def band_of(bands: Sequence[Mapping], index: int | None = None, attribute: str | None = None, value=None, tolerance: float = 0.0) -> int:
    """The 0-based place of a band: by its index, or by an attribute; numbers agree within the tolerance. Exactly one must."""
    if index is not None:
        if not 0 <= index < len(bands):
            raise ValueError(f"band {index} of {len(bands)}")
        return index

    def agrees(x) -> bool:
        number = isinstance(x, int | float) and isinstance(value, int | float)
        return abs(x - value) <= tolerance if number else x == value

    found = [k for k, b in enumerate(bands) if attribute in b and agrees(b[attribute])]
    if len(found) != 1:
        raise ValueError(f"{len(found)} bands have {attribute} = {value}")
    return found[0]


def footprint(points: Column, lon: str = "Longitude", lat: str = "Latitude") -> dict[str, Column]:
    """West, south, east and north of an array of points."""
    x, y = F.transform(points, lambda p: p[lon]), F.transform(points, lambda p: p[lat])
    return {"west": F.array_min(x), "south": F.array_min(y), "east": F.array_max(x), "north": F.array_max(y)}


def fingerprint(rows: DataFrame) -> str:
    """Of a table's rows in any order, repeats counted: their number and the sum of their hashes, so no task sees all rows."""
    hashes = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in sorted(rows.columns)])
    n, total = rows.select(hashes.alias("h")).agg(F.count("*"), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    return f"{n:x}-{int(total or 0) % (1 << 64):016x}"


def freeze(index: DataFrame, path: str) -> str:
    """Write the selected rows of the index and return the fingerprint of what was written: a plan names its input by it."""
    index.write.mode("overwrite").parquet(path)
    return fingerprint(index.sparkSession.read.parquet(path))


def version_counts(index: DataFrame) -> DataFrame:
    """(collection, collection_version, granules)."""
    return index.groupBy("collection", "collection_version").agg(F.count("*").alias("granules"))
