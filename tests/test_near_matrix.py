"""Near pairs counted by source without listing them; expected values by comparing all pairs."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pytest

from siftlane.operators import dedup
from tests.conftest import rows
from tests.test_curation import hashed, signed


def clustered(n, sources):
    """Items in a few clusters of hashes, most of them 3 to 12 apart; hashes are distinct."""
    rng = random.Random(n)
    bases, items = [rng.getrandbits(64) for _ in range(4)], {}
    while len(items) < n:
        h = rng.choice(bases)
        for b in rng.sample(range(64), rng.randint(0, 6)):
            h ^= 1 << b
        items.setdefault(signed(h), (f"k{len(items):04}", rng.choice(sources)))
    return [(key, prio, h) for h, (key, prio) in items.items()]


def near(items):
    """Pairs 3 to 8 apart, the earlier item first, with their distance."""
    items = sorted(items, key=lambda x: (x[1], x[0]))
    return [(a, b, d) for a, b in combinations(items, 2) if 3 <= (d := ((a[2] ^ b[2]) & (2**64 - 1)).bit_count()) <= 8]


@pytest.mark.parametrize(("block", "strip", "sources"), [(16, 64, [1, 2, 3]), (8192, 1 << 17, list(range(400))), (8192, 1 << 17, [0])])
def test_near_matrix_equals_all_pairs(spark, monkeypatch, block, strip, sources):
    monkeypatch.setattr(dedup, "BLOCK", block)
    monkeypatch.setattr(dedup, "STRIP", strip)
    items = clustered(300, sources)
    want = Counter((a[1], b[1]) for a, b, _ in near(items))
    assert rows(dedup.near_matrix(hashed(spark, items))) == {(*k, n) for k, n in want.items()}


def test_near_matrix_of_nothing(spark):
    assert dedup.near_matrix(hashed(spark, [])).count() == 0
    assert dedup.near_matrix(hashed(spark, [("a", 0, 5)])).count() == 0


@pytest.mark.parametrize(("most", "way"), [(2, None), (8, (4, 1, 1)), (8, (4, 2, 1))])
def test_exploded_hashes_are_not_broadcast(spark, tmp_path, most, way):
    """A file of few bytes becomes up to 1734 times as many rows, which went to the driver."""
    spark.createDataFrame([(signed(random.Random(i).getrandbits(64)),) for i in range(200)], "h bigint").write.parquet(f"{tmp_path}/h")
    pairs = dedup.close_pairs(spark.read.parquet(f"{tmp_path}/h"), most, way)
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_keys_are_chosen_by_what_shares_them(spark, monkeypatch):
    """Hashes that differ in the first bits only share most keys of one block."""
    monkeypatch.setattr(dedup, "COUNTED", 100)
    hs = [signed(i << 44) for i in range(2000)]
    df = spark.createDataFrame([(h,) for h in hs], "h bigint")
    assert dedup._counted_plan(df, len(hs), 2) != dedup.plan(len(hs), 2)
    want = {(min(a, b), max(a, b)) for a in hs[:300] for b in hs[:300] if 0 < ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    small = spark.createDataFrame([(h,) for h in hs[:300]], "h bigint")
    assert rows(dedup.close_pairs(small, 2), "a", "b") == want
