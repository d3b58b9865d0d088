"""Queries of the gated selection: the looks of the driver tables beside SQL. Small cells with known answers stand in tests/test_gated.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators.gated import METRICS, ModeGate, select_gated
from cellweave.sources.tables import LOOK_ORDER, LOOKS_SQL, dealt_looks

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

def only(**weights: float) -> dict[str, float]:
    return {m: weights.get(m, 0.0) for m in METRICS}


def _on_looks(name: str, key: str, gate: str):
    """The looks of the driver tables; two metrics, two looks at least."""
    p = "round(0.4::DOUBLE * least(sz / 70, 1) + 0.6::DOUBLE * least(vz / 30, 1), 9)"

    def mode_sql(tag: str, code: str, weight: str, voter: str, tie: str) -> str:
        return f"""
{tag}v AS (SELECT *, CASE WHEN {voter} THEN {code} END AS code, sum(CASE WHEN {voter} THEN {weight} END) OVER (PARTITION BY cell, epoch, CASE WHEN {voter} THEN {code} END) AS v, count(*) OVER (PARTITION BY cell, epoch, CASE WHEN {voter} THEN {code} END) AS n, {tie} AS tie FROM a),
{tag}t AS (SELECT *, max(CASE WHEN code IS NOT NULL THEN v END) OVER (PARTITION BY cell, epoch) AS best FROM {tag}v),
{tag} AS (SELECT cell, epoch, first(code ORDER BY tie, place) AS mode, first(v ORDER BY tie, place) AS votes, first(n ORDER BY tie, place) AS n FROM {tag}t WHERE code IS NOT NULL AND v >= best - 1e-7 GROUP BY 1, 2)"""

    partial = "(cls > 0) <> (cls2 > 0)"
    soft = "ELSE -(p + 10.0)" if gate == "soft" else ""
    if key == "joint":
        modes = mode_sql("j", "cls * 1000 + cls2", f"CASE WHEN {partial} THEN 0.01::DOUBLE ELSE 1.0::DOUBLE END", "valid AND (cls > 0 OR cls2 > 0)", f"round(p + CASE WHEN {partial} THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END, 9)")
        body = f"""SELECT a.*, n_valid, coalesce(j.n, 0) AS mode_count, round(coalesce(j.votes, 0), 6) AS mode_votes, CASE WHEN valid AND NOT coalesce(j.n < 2, false) THEN CASE WHEN j.mode IS NULL OR cls * 1000 + cls2 = j.mode THEN -p {soft} END END AS s,
  CASE WHEN coalesce(j.n, 2) >= 2 THEN coalesce(j.mode // 1000, 0) END AS mode_1, CASE WHEN coalesce(j.n, 2) >= 2 THEN coalesce(j.mode % 1000, 0) END AS mode_2
  FROM a LEFT JOIN j ON a.cell = j.cell AND a.epoch = j.epoch"""
    else:
        modes = mode_sql("j", "cls", "1", "valid AND cls > 0", "p") + "," + mode_sql("k", "cls2", "1", "valid AND cls2 > 0", "p")
        body = f"""SELECT *, CASE WHEN valid AND NOT (coalesce(jn < 2, false) AND coalesce(kn < 2, false)) THEN CASE WHEN m THEN -p {soft} END END AS s,
  CASE WHEN coalesce(jn, 2) >= 2 THEN coalesce(jmode, 0) END AS mode_1, CASE WHEN coalesce(kn, 2) >= 2 THEN coalesce(kmode, 0) END AS mode_2,
  CASE WHEN jn IS NULL AND kn IS NULL THEN 0 ELSE count(*) FILTER (valid AND m) OVER (PARTITION BY cell, epoch) END AS mode_count, (CASE WHEN jn IS NULL AND kn IS NULL THEN 0 ELSE count(*) FILTER (valid AND m) OVER (PARTITION BY cell, epoch) END)::DOUBLE AS mode_votes
  FROM (SELECT a.*, j.n AS jn, k.n AS kn, j.mode AS jmode, k.mode AS kmode, (j.n IS NULL OR j.n < 2 OR cls = j.mode) AND (k.n IS NULL OR k.n < 2 OR cls2 = k.mode) AS m
  FROM a LEFT JOIN j ON a.cell = j.cell AND a.epoch = j.epoch LEFT JOIN k ON a.cell = k.cell AND a.epoch = k.epoch)"""
    sql = f"""WITH {LOOKS_SQL}, a AS (SELECT *, {p} AS p, row_number() OVER (PARTITION BY cell, epoch ORDER BY acquired, oid, line) AS place, count(*) FILTER (valid) OVER (PARTITION BY cell, epoch) AS n_valid FROM looks),{modes},
r AS ({body})
SELECT cell, epoch, oid, line, round(p, 6) AS penalty, n_valid, mode_1, mode_2, mode_count, mode_votes, round(mode_count / n_valid, 6) AS agreement FROM r WHERE s IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cell, epoch ORDER BY s DESC, place) = 1"""
    spec = ModeGate(layers=("cls", "cls2"), key=key, gate=gate, min_count=2, weights=only(vza=3.0, sza=2.0), aliases={"vza": ["vz"], "sza": ["sz"]})

    def run(spark, d):
        out = select_gated(dealt_looks(spark, d, "cell", "epoch"), ["cell", "epoch"], LOOK_ORDER, spec)
        return out.select("cell", "epoch", "oid", "line", F.round("selection_penalty", 6).alias("penalty"), "n_valid", "mode_1", "mode_2", "mode_count", F.round("mode_votes", 6).alias("mode_votes"), F.round("agreement", 6).alias("agreement"))

    QUERIES[name], ORACLE_SQL[name] = run, sql


_on_looks("mode_gated_joint", "joint", "hard")
_on_looks("mode_gated_soft", "joint", "soft")
_on_looks("mode_gated_independent", "independent", "hard")
