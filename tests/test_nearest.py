"""The least distance of two hashes."""

from __future__ import annotations

import pytest

from siftlane.operators import dedup


@pytest.mark.parametrize(("block", "limit"), [(2, 10**6), (8192, 10**6), (8192, 3)])
@pytest.mark.parametrize(
    ("hs", "want"),
    [([], None), ([7], None), ([0, 1, 2**40 - 1], 1), ([0, 7, 2**40 - 1, -1], 3), ([0, 0xFF, 2**40 - 1, -1], 8), ([0, 0x1FF, 2**40 - 1, -1], None)],
)
def test_nearest(spark, monkeypatch, block, limit, hs, want):
    monkeypatch.setattr(dedup, "BLOCK", block)
    monkeypatch.setattr(dedup, "ALL_PAIRS", limit)
    got = dedup.nearest(spark.createDataFrame([(h,) for h in hs], "h bigint"), 8).collect()
    assert [tuple(r) for r in got] == [(want,)]


def test_a_close_pair_ends_the_search(spark, monkeypatch):
    def fail(*_):
        raise AssertionError("all pairs were compared")

    monkeypatch.setattr(dedup, "_tiles", fail)
    assert dedup.nearest(spark.createDataFrame([(0,), (3,), (255,)], "h bigint"), 8).first()[0] == 2


@pytest.mark.parametrize("hs", [[0, 3, 255], [0, 7, 255]])
def test_the_search_is_over_before_its_row_is_broadcast(spark, hs):
    """A cross join with the row broadcasts it, which fails where the search takes more than the broadcast's timeout."""
    plan = dedup.nearest(spark.createDataFrame([(h,) for h in hs], "h bigint"), 8)._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan and "Join" not in plan and "MapInArrow" not in plan
