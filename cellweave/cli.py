"""The command line: python -m cellweave.cli plan | run | sample | diff | plugins. Each prints one JSON document."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cellweave.operators.catalog import query_index
from cellweave.operators.sinks import sample
from cellweave.plans import plugins
from cellweave.plans.manifest import Manifest, deliver, key_difference, reuse_or_write
from cellweave.sources.readers import fingerprint, version_counts


def description(path: str) -> Manifest:
    with open(path) as f:
        doc = json.load(f)
    for k in ("start", "end"):
        if k in doc.get("time", {}):
            doc["time"][k] = datetime.fromisoformat(doc["time"][k])
    if "layers" in doc:
        doc["box"] = tuple(doc.get("box", ()))
    return Manifest.from_document(doc)


def plan(spark: SparkSession, args) -> dict:
    """What a run would read and write, and whether its budget allows it."""
    m = description(args.manifest)
    chosen = query_index(spark.read.parquet(args.index), m.box, m.time.start, m.time.end)
    versions = [r.asDict() for r in version_counts(chosen).orderBy("collection", "collection_version").collect()]  # a row a version
    granules, tiles = sum(v["granules"] for v in versions), len(m.grid.tiles(m.box))
    partial = [str(e.start) for e in m.time.partial_epochs()]
    return {"key": m.key, "tiles": tiles, "granules": granules, "versions": versions, "epochs": len(m.time.epochs()), "partial_epochs": partial, "periods": len(m.time.deliveries()), "over_budget": m.budget.gate(tiles, granules)}


def run(spark: SparkSession, args) -> dict:
    """Write the products of looks below root, or find them there: the path is named by the description and the looks."""
    m, rows = description(args.manifest), spark.read.parquet(args.looks)
    inputs = {"manifest": m.key, "looks": fingerprint(rows), "reducers": sorted(args.reducer)}
    reducers = [plugins.resolve("reducer", r) for r in args.reducer]
    out = reuse_or_write(spark, args.root, "products", inputs, lambda: deliver(m, rows, args.keys.split(","), args.order.split(","), reducers))
    return {"inputs": inputs, "files": len(out.inputFiles()), "rows": out.count(), "columns": out.columns}


def point(spark: SparkSession, args) -> dict:
    m, rows = description(args.manifest), spark.read.parquet(args.products)
    found = sample(rows, args.lon, args.lat, m.grid.origin, m.grid.resolution)
    return {"values": [json.loads(r[0]) for r in found.orderBy("period").select(F.to_json(F.struct("*"))).collect()]}  # a row a period


def diff(spark, args) -> dict:
    with open(args.a) as a, open(args.b) as b:
        return {"different": key_difference(json.load(a), json.load(b))}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cellweave")
    sub = p.add_subparsers(required=True)

    def command(name, call, *names):
        c = sub.add_parser(name)
        c.set_defaults(call=call)
        for n in names:
            c.add_argument(n)
        return c

    command("plan", plan, "manifest", "index")
    c = command("run", run, "manifest", "looks", "root")
    c.add_argument("--keys", default="row,col")
    c.add_argument("--order", default="acquired,granule_id")
    c.add_argument("--reducer", action="append", default=[])
    c = command("sample", point, "manifest", "products")
    for n in ("--lon", "--lat"):
        c.add_argument(n, type=float, required=True)
    command("diff", diff, "a", "b")
    command("plugins", lambda spark, args: {"plugins": plugins.registered()})
    return p


def main(argv: list[str], spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    needs_spark = args.call in (plan, run, point)
    return args.call((spark or SparkSession.builder.appName("cellweave").getOrCreate()) if needs_spark else None, args)


if __name__ == "__main__":
    print(json.dumps(main(sys.argv[1:]), default=str))
