"""Every query of the engine that SQL can express, beside DuckDB on the same tables."""

from __future__ import annotations

import pytest

from cellweave.plans import catalogue
from tests.oracle import differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    got, want, more, less = differences(catalogue.QUERIES[name](spark, SF), catalogue.ORACLE_SQL[name], SF)
    assert (got, more, less) == (want, [], []) and want > 0


@pytest.mark.parametrize("name", ["vote_highest_score", "argmax_streaming", "mode_gated_joint", "confirmed_vote"])
def test_partitions_dont_matter(spark, name):
    rows = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows.append(sorted(map(str, catalogue.QUERIES[name](spark, SF).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert rows[0] == rows[1]
