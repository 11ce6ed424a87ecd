"""Near edges listed tile by tile; expected values by comparing all pairs."""

from __future__ import annotations

import pytest

from siftlane.operators import dedup
from tests.conftest import rows
from tests.test_curation import hashed
from tests.test_near_matrix import clustered, near


@pytest.mark.parametrize(("block", "strip"), [(16, 64), (8192, 1 << 17)])
def test_near_edges_of_many_blocks(spark, monkeypatch, block, strip):
    monkeypatch.setattr(dedup, "BLOCK", block)
    monkeypatch.setattr(dedup, "STRIP", strip)
    items = clustered(300, [1, 2, 3])
    want = {(a[0], b[0], d) for a, b, d in near(items)}
    assert rows(dedup.near_edges(hashed(spark, items))) == want
    monkeypatch.setattr(dedup, "ALL_PAIRS", 10)
    assert rows(dedup.near_edges(hashed(spark, items))) == want


def test_near_edges_send_no_hashes_to_the_driver(spark, tmp_path):
    hashed(spark, clustered(300, [1, 2, 3])).write.parquet(f"{tmp_path}/kept")
    edges = dedup.near_edges(spark.read.parquet(f"{tmp_path}/kept"))
    assert "Broadcast" not in edges._jdf.queryExecution().executedPlan().toString()
