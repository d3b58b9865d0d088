"""The pipeline's stages, each against a plain version on its own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline as p
from cellweave.llm import mixing, quality_lm
from cellweave.llm.common import materialize
from tests.llm.test_packing import check_pack, plain  # noqa: F401
from tests.llm.test_simhash import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark, plain):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for _, stage in p.STAGES[:-1]:
        kept.append(materialize(stage(spark, kept[-1], SF), "test"))
        assert kept[-1].columns == columns
    texts = [{r.doc_id: r.text for r in k.collect()} for k in kept]
    # documents within the limits of the model
    scored = quality_lm.score(docs, spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "text", "lang", "quality")
    assert set(texts[1]) == {r.doc_id for r in scored.collect() if not r.rejected} and len(texts[1]) >= 0.8 * len(texts[0])
    # of equal texts the largest id
    assert set(texts[2]) == set({t: i for i, t in sorted(texts[1].items())}.values())
    # of near copies the smallest id
    assert set(texts[3]) == {c for _, _, c in brute([(i, t) for i, t in texts[2].items()])}
    # as often as the mixture says
    times = {r.doc_id: r.times for r in mixing.mix(kept[3], "doc_id", "text", "source").collect()}
    mixed = [(r.doc_id, r.text) for r in kept[4].collect()]
    assert Counter(i for i, _ in mixed) == Counter({i: n for i, n in times.items() if n})
    # all of it, packed
    check_pack(mixed, p.STAGES[-1][1](spark, kept[4], SF).collect(), plain)
    assert p.run(spark, SF).count() > 0 and 4 <= len(p.STAGES) <= 5
