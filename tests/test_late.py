"""Streams in which looks come late, against a plain walk over the same batches."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from cellweave.streaming import late

DAY = 86_400_000_000
KEYS, ORDER = ["cell"], ["oid"]
SCHEMA = "us bigint, cell string, oid bigint, score double, arrived int"


def rows_of(n: int, batches: int, seed: int):
    """Time in half days, arriving up to four batches later; a third belong to one cell, some have nulls, scores tie."""
    rng, out = random.Random(seed), []
    for k in range(n):
        b = rng.randrange(batches)
        us = None if rng.random() < 0.02 else (b + 1) * DAY // 2 + rng.randrange(DAY // 2)
        cell = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None])
        out.append((us, cell, k, None if rng.random() < 0.05 else float(rng.randrange(4)), min(batches - 1, b + rng.choice([0, 0, 0, 1, 4]))))
    return out


def walk(rows, delay_us: int):
    """(final, late) by the rules, one batch after another."""
    mark, state, final, gone = None, {}, {}, []
    for b in sorted({r[4] for r in rows}):
        now = [r for r in rows if r[4] == b and r[0] is not None and r[3] is not None]
        for us, cell, oid, score, _ in now:
            epoch = us // DAY * DAY
            if mark is not None and (epoch + DAY) // 1000 <= mark:
                gone.append((epoch, cell, oid, score))
            else:
                n, best = state.get((epoch, cell), (0, (9e9, 0)))
                state[epoch, cell] = (n + 1, min(best, (-score, oid)))
        if now:
            seen = max(r[0] for r in now) // 1000 - delay_us // 1000
            mark = seen if mark is None else max(mark, seen)
        for k in [k for k in state if mark is not None and (k[0] + DAY) // 1000 < mark]:
            final[k] = state.pop(k)
    return final, gone


def streamed(spark, rows, path, salts: int, name: str = "out"):
    made = spark.createDataFrame(rows, SCHEMA).selectExpr("timestamp_micros(us) AS ts", "cell", "oid", "score", "arrived")
    stream = late.replay(made, "arrived", f"{path}/arrivals", 3)
    return late.run(late.best_or_late(stream, "ts", 1, "12 hours", KEYS, ORDER, "score", salts), f"{path}/{name}", f"{path}/checkpoint-{name}")


def found(out):
    final = {(r.epoch_us, r.cell): (r.n, (-r.score, r.oid)) for r in late.closed(out, KEYS, ORDER).collect()}
    return final, sorted((r.epoch_us, str(r.cell), r.oid, r.score) for r in out.where("kind = 'late'").collect())


@pytest.mark.parametrize("salts", [1, 3])
def test_kept_late_and_closed(spark, tmp_path, salts):
    rows = rows_of(400, 9, 5)
    final, gone = walk(rows, DAY // 2)
    out = streamed(spark, rows, tmp_path, salts)
    assert found(out) == (final, sorted((e, str(c), o, s) for e, c, o, s in gone)) and len(gone) > 20 and len(final) > 10
    merged = {(r.epoch_us, r.cell): (r.n, -r.score, r.oid) for r in late.with_late(late.closed(out, KEYS, ORDER), out.where("kind = 'late'"), KEYS, ORDER).collect()}
    want = defaultdict(list)
    for k, (n, best) in final.items():
        want[k].append((n, *best))
    for e, c, o, s in gone:
        want[e, c].append((1, -s, o))
    assert merged == {k: (sum(x[0] for x in v), *min(x[1:] for x in v)) for k, v in want.items()}


def test_a_restart_goes_on_from_its_checkpoint(spark, tmp_path):
    rows = rows_of(300, 8, 11)
    final, gone = walk(rows, DAY // 2)
    made = spark.createDataFrame(rows, SCHEMA).selectExpr("timestamp_micros(us) AS ts", "cell", "oid", "score", "arrived")
    source = f"{tmp_path}/grown"
    late.replay(made.where("arrived <= 3"), "arrived", source, 2)

    def go():
        stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)
        return late.run(late.best_or_late(stream, "ts", 1, "12 hours", KEYS, ORDER, "score"), f"{tmp_path}/b", f"{tmp_path}/cb")

    go()
    for k in sorted({r[4] for r in rows if r[4] > 3}):
        made.where(f"arrived = {k}").coalesce(1).write.mode("append").partitionBy("arrived").parquet(source)
    assert found(go()) == (final, sorted((e, str(c), o, s) for e, c, o, s in gone))


def test_nothing_arrives(spark, tmp_path):
    (tmp_path / "none").mkdir()
    stream = spark.readStream.schema("ts timestamp, cell string, oid bigint, score double").parquet(f"{tmp_path}/none")
    out = late.run(late.best_or_late(stream, "ts", 1, "1 hour", KEYS, ORDER, "score"), f"{tmp_path}/out", f"{tmp_path}/cp")
    assert out.collect() == [] and late.closed(out, KEYS, ORDER).collect() == []


def test_keys_share_states_by_parts(spark, tmp_path):
    """Thousands of keys, some beyond what a double holds and one null, in a few values of state."""
    rng, big = random.Random(3), 2**53 + 1
    rows = [((k % 6 + 1) * DAY // 2 + k, None if k % 97 == 0 else big + rng.randrange(2000), k, float(rng.randrange(9)), k % 6 + rng.choice([0, 0, 0, 3])) for k in range(6000)]
    final, gone = walk(rows, DAY // 2)
    made = spark.createDataFrame(rows, SCHEMA.replace("cell string", "cell bigint")).selectExpr("timestamp_micros(us) AS ts", "cell", "oid", "score", "arrived")
    stream = late.replay(made, "arrived", f"{tmp_path}/arrivals", 2)
    out = late.run(late.best_or_late(stream, "ts", 1, "12 hours", KEYS, ORDER, "score", parts=3), f"{tmp_path}/out", f"{tmp_path}/checkpoint", 2)
    assert found(out) == (final, sorted((e, str(c), o, s) for e, c, o, s in gone)) and len(final) > 1000 and len(gone) > 20


@pytest.mark.parametrize("mode", ["complete", "append"])
def test_a_drained_stream_lies_in_files(spark, tmp_path, mode):
    """No row of the result passes the driver, and in complete mode only the last batch counts."""
    from cellweave.streaming import windows

    rows = [(k * DAY // 2, "ab"[k % 2], k, float(k), k // 4) for k in range(12)]
    stream = late.replay(spark.createDataFrame(rows, SCHEMA).selectExpr("timestamp_micros(us) AS ts", "cell", "oid", "score", "arrived"), "arrived", f"{tmp_path}/arrivals", 2)
    out = windows.drain(windows.running_best(stream, "ts", "3 days", "1 hour", ["cell"], ["oid"], "score"), f"drained_{mode}", mode)
    assert len(out.inputFiles()) > 0 and not spark.catalog.tableExists(f"drained_{mode}")
    got = sorted((r.window_start.day, r.cell, r.score, r.oid) for r in out.collect())
    want = sorted((1 + w * 3, c, float(w * 6 + 4 + k), w * 6 + 4 + k) for w in (0, 1) for k, c in enumerate("ab"))
    assert got == (want if mode == "complete" else want[:2])
