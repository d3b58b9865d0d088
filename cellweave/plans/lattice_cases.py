"""Queries of warps, and of roles whose cells differ in size, on the raster of parts, beside SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import warp
from cellweave.sources.tables import RASTER_SQL, raster, tasks

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

_SHAPE, _SCALE, _OFFSET = (80, 160), (0.4, 0.37), (0.25, -0.6)
_SHARES = {
    "bilinear": (1, "greatest(0, 1 - abs({t}))"),
    "cubic": (2, "CASE WHEN abs({t}) < 1 THEN (1.5 * abs({t}) - 2.5) * {t} * {t} + 1 WHEN abs({t}) < 2 THEN ((-0.5 * abs({t}) + 2.5) * abs({t}) - 4) * abs({t}) + 2 ELSE 0 END"),
}
#: Parts of some sizes are holes.
_HOLES = "cls % 9 <> 4"


def _add(name: str, sql: str, run) -> None:
    QUERIES[name], ORACLE_SQL[name] = run, sql


def _warped(kernel: str, tile: int) -> None:
    reach, share = _SHARES[kernel]
    (rows, cols), (sy, sx), (oy, ox) = _SHAPE, _SCALE, _OFFSET
    sql = f"""WITH {RASTER_SQL}, s AS (SELECT row, col, value FROM raster WHERE {_HOLES}),
t AS (SELECT r, c, (r + 0.5) * {sy}::DOUBLE + {oy}::DOUBLE AS y, (c + 0.5) * {sx}::DOUBLE + {ox}::DOUBLE AS x FROM range({rows}) a(r), range({cols}) b(c)),
n AS (SELECT r, c, y, x, floor(y - 0.5)::BIGINT + i AS row, floor(x - 0.5)::BIGINT + j AS col FROM t, range({1 - reach}, {reach + 1}) a(i), range({1 - reach}, {reach + 1}) b(j)),
w AS (SELECT r, c, value, ({share.format(t="(y - row - 0.5)")}) * ({share.format(t="(x - col - 0.5)")}) AS w FROM n JOIN s USING (row, col))
SELECT r AS row, c AS col, round(sum(w * value) / sum(w), 5) AS value FROM w GROUP BY 1, 2 HAVING sum(w) > 1e-6"""

    def run(spark, d):
        out = warp.warp(raster(spark, d).where(_HOLES), "value", _SHAPE, _SCALE, _OFFSET, kernel, tile)
        return out.withColumn("value", F.round("value", 5))

    _add(f"warp_{kernel}", sql, run)


_warped("bilinear", 16)
_warped("cubic", 32)


def _role(spark, d):
    return raster(spark, d).select("row", "col", F.col("value").cast("double").alias("depth"), (F.col("cls") % 5).alias("kind"), F.expr(_HOLES).alias("valid"))


def _role_sql(name: str, a: int, b: int) -> str:
    """A row for each unit of the common refinement: what to_lattice() counts without making it."""
    return f"""{name}u AS (SELECT (row * {a} + i) // {b} AS row, (col * {a} + j) // {b} AS col, value, cls % 5 AS kind FROM raster, range({a}) p(i), range({a}) q(j) WHERE {_HOLES}),
{name}k AS (SELECT row, col, kind FROM (SELECT row, col, kind, count(*) AS n FROM {name}u GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY row, col ORDER BY n DESC, kind) = 1),
{name} AS (SELECT row, col, avg(value) AS depth, {name}k.kind AS kind, count(*) = {b * b} AS whole FROM {name}u JOIN {name}k USING (row, col) GROUP BY row, col, {name}k.kind)"""


def _to(spark, d, role, a: int, b: int, means, kinds=()):
    """A role's cell covers a / b target cells along an axis, and one more where their edges don't meet."""
    return warp.to_lattice(role, a, b, means, kinds, keys=(), tasks=tasks(spark, d, "part", (a / b + (a % b > 0)) ** 2))


def _lattice(a: int, b: int, name: str) -> None:
    def run(spark, d):
        out = _to(spark, d, _role(spark, d), a, b, ["depth"], ["kind"])
        return out.select("row", "col", F.round("depth", 5).alias("depth"), "kind", "valid")

    _add(name, f"WITH {RASTER_SQL}, {_role_sql('x', a, b)} SELECT row, col, round(depth, 5) AS depth, kind, whole AS valid FROM x", run)


_lattice(3, 1, "role_to_finer_cells")
_lattice(3, 2, "role_three_to_two")
_lattice(1, 4, "role_to_coarser_cells")


def role_join(spark, d):
    """Three roles at 2, 3 and 5 units a cell meet on the lattice of the second."""
    role = _role(spark, d)
    fine = _to(spark, d, role, 2, 3, ["depth"])
    coarse = _to(spark, d, role, 5, 3, ["depth"], ["kind"])
    out = warp.join_roles(role.select("row", "col", "valid"), {"fine": fine, "coarse": coarse}, keys=(), tasks=tasks(spark, d, "part"))
    return out.select("row", "col", F.round("fine_depth", 5).alias("fine_depth"), F.round("coarse_depth", 5).alias("coarse_depth"), "coarse_kind", "valid")


_add(
    "role_join",
    f"""WITH {RASTER_SQL}, {_role_sql('f', 2, 3)}, {_role_sql('e', 3, 3)}, {_role_sql('h', 5, 3)}
SELECT e.row, e.col, round(f.depth, 5) AS fine_depth, round(h.depth, 5) AS coarse_depth, h.kind AS coarse_kind, e.whole AND coalesce(f.whole, false) AND coalesce(h.whole, false) AS valid
FROM (SELECT row, col, {_HOLES} AS whole FROM raster) e LEFT JOIN f ON e.row = f.row AND e.col = f.col LEFT JOIN h ON e.row = h.row AND e.col = h.col""",
    role_join,
)
