"""Class tables: lumping raw classes into product classes."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UNMAPPED = -1
MOST_CLASSES = 65_534


@dataclass(frozen=True)
class ProductClass:
    """A class of the product and the raw keys that it takes."""

    class_id: int
    name: str
    members: tuple


def resolve(spark: SparkSession, raw_keys: Sequence, classes: Sequence[ProductClass], rest: int | None = None) -> DataFrame:
    """(raw, class_id): each member matches exactly one raw key (numbers and their text are the same), none is taken twice.

    Raw keys that nobody takes go to class `rest`, or are an error without one. Raw 0 stays 0.
    """
    known, taken = {str(k): k for k in raw_keys}, {}
    for c in classes:
        if not 1 <= c.class_id <= 65534:
            raise ValueError(f"class ids are 1 to 65534: {c.class_id}")
        for m in c.members:
            if str(m) not in known:
                raise ValueError(f"{c.name}: nothing has the key {m}")
            if str(m) in taken:
                raise ValueError(f"{c.name}: {m} is taken by class {taken[str(m)]}")
            taken[str(m)] = c.class_id
    left = [k for s, k in known.items() if s not in taken and k != 0]
    if left and rest is None:
        raise ValueError(f"no class takes {left[:5]}")
    rows = [(int(k), 0 if k == 0 else taken.get(s, rest)) for s, k in known.items()]
    return spark.createDataFrame(rows, "raw int, class_id int")


def remap(rows: DataFrame, table: DataFrame, raw: str, out: str = "class_id") -> DataFrame:
    """Adds the product class: 0 stays 0, what the table doesn't have is UNMAPPED. The table has one row a raw class."""
    t = table.select(F.col("raw").alias("__raw"), F.col("class_id").alias("__class"))
    return rows.join(t, F.col(raw) == F.col("__raw"), "left").withColumn(out, F.when(F.col(raw) == 0, 0).otherwise(F.coalesce("__class", F.lit(UNMAPPED)))).drop("__raw", "__class")


def identity(table: DataFrame, key: str, name: str) -> DataFrame:
    """(class_id, key, name): every raw class is one of the product; a name that several have gets #key."""
    several = F.count("*").over(Window.partitionBy(name)) > 1
    rows = table.select(key, F.when(several, F.concat(F.col(name), F.lit("#"), F.col(key).cast("string"))).otherwise(F.col(name)).alias(name))
    if table.count() > MOST_CLASSES:
        raise ValueError(f"a class table has {MOST_CLASSES} rows at most")
    return rows.withColumn("class_id", F.row_number().over(Window.orderBy(key)))


def ids_of(table: DataFrame, names: Sequence[str], name: str = "name", class_id: str = "class_id") -> list[int]:
    """Ids of classes by name; a name that the table lacks, or has twice, is an error."""
    found = {}
    for r in table.where(F.col(name).isin(list(names))).select(name, class_id).collect():  # rows of a class table
        if r[0] in found:
            raise ValueError(f"several classes are named {r[0]}")
        found[r[0]] = r[1]
    missing = [n for n in names if n not in found]
    if missing:
        raise ValueError(f"no classes {missing}")
    return [found[n] for n in names]


def merge_legends(parts: Sequence[DataFrame], class_id: str = "class_id", name: str = "name") -> DataFrame:
    """Class tables of several tiles as one, by id; an id that stands for two names is an error."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    one = rows.groupBy(class_id).agg(F.min(name).alias(name), F.max(name).alias("__last"))
    differ = F.raise_error(F.concat(F.lit("two names for class "), F.col(class_id).cast("string")))
    return one.select(class_id, F.when(F.col(name).eqNullSafe(F.col("__last")), F.col(name)).otherwise(differ).alias(name))


def fingerprint(rows: Sequence[Sequence]) -> str:
    """Of a class table, whatever the order of its rows."""
    return hashlib.sha256(json.dumps(sorted(map(list, rows), key=str), default=str, ensure_ascii=False).encode()).hexdigest()[:16]
