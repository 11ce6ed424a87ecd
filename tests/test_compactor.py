from __future__ import annotations

from datetime import datetime
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from siftlane.sources.tables import canonical_items
from siftlane.streaming import compactor
from tests.conftest import rows

T = datetime(2025, 1, 1)
FILES = "file_id bigint, path string, body binary, n_bytes int, modified_at timestamp_ntz"


def files(spark, spec):
    data = [(i, p, b, None if b is None else len(b), T.replace(minute=i % 60)) for i, p, b in spec]
    return spark.createDataFrame(data, FILES)


@pytest.fixture
def items(spark):
    keys = ["metal/milltray__scan (7).jpg", "metal/milltray__scan.jpg", "paper/brinewharf__w1__1.jpg", "paper/brinewharf__w1.jpg"]
    return canonical_items(spark.createDataFrame([(k,) for k in keys], "key string"))


def test_files_belong_to_the_item_of_their_own_name_first(spark, items):
    spec = [
        (1, "data/metal/milltray__scan (7).jpg", b"a"), (2, "data/metal/milltray__scan.JPG", b"a"), (3, "data/metal/milltray__scan (7) (1).jpg", b"a"),
        (4, "data\\metal\\milltray__scan - Copy.jpg", b"b"), (5, "data/metal/milltray__scan (9).jpg", b"c"), (6, "x/brinewharf%5F%5Fw1__1.png.bak", b""),
        (7, "x/brinewharf__w1.txt.part", b""), (8, "x/brinewharf__w1.txt", None), (9, "x/index.csv", b"1"), (10, None, b"1"), (11, "x/brinewharf__w1__2.jpg", b"z"), (12, "x/_SUCCESS", b""),
        (13, "x/brinewharf__w1 - Copy (2).jpg", b"z"), (14, "x/milltray__scan (7) - Copy.TXT", b"z"),
    ]
    got = rows(compactor.bind_files(files(spark, spec), items), "file_id", "key", "kind")
    assert got == {
        (1, "metal/milltray__scan (7).jpg", "image"), (2, "metal/milltray__scan.jpg", "image"), (3, "metal/milltray__scan (7).jpg", "image"), (4, "metal/milltray__scan.jpg", "image"),
        (5, "metal/milltray__scan.jpg", "image"), (6, "paper/brinewharf__w1__1.jpg", "image"), (7, "paper/brinewharf__w1.jpg", "label"), (8, "paper/brinewharf__w1.jpg", "label"),
        (13, "paper/brinewharf__w1.jpg", "image"), (14, "metal/milltray__scan (7).jpg", "label"),
    }


def write(spark, df, path, mode="append"):
    df.coalesce(1).write.mode(mode).parquet(path)


def test_new_files_are_taken_up_once_and_a_retry_replaces(spark, items, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    spec = [(1, "a/milltray__scan.jpg", b"1"), (2, "a/milltray__scan.txt", b"")]
    write(spark, files(spark, spec), source)
    first = compactor.stored_record_log(spark, source, items, out, progress)
    assert first.count() == 2
    assert compactor.stored_record_log(spark, source, items, out, progress).count() == 2
    write(spark, files(spark, [(3, "a/milltray__scan.jpg.bak", b"12")]), source)
    log = compactor.stored_record_log(spark, source, items, out, progress)
    assert rows(log, "file_id", "batch") == {(1, "00000000"), (2, "00000000"), (3, "00000001")} or log.count() == 3
    # The try of a batch is repeated: the same rows under the same id.
    again = files(spark, [(3, "a/milltray__scan.jpg.bak", b"12")])
    compactor.bind_files(again, items).write.mode("overwrite").parquet(f"{out}/batch=00000001")
    assert compactor.read_log(spark, out).count() == 3


def test_seal_keeps_each_record_once_and_loses_none(spark, items, tmp_path):
    spec = [(1, "a/milltray__scan.jpg.part", b"1234"), (2, "a/milltray__scan.jpg", b"12"), (3, "a/milltray__scan (1).jpg", b"123"), (4, "a/milltray__scan.txt", b""), (5, "a/brinewharf__w1.txt", b"0 .5 .5 .1 .1")]
    write(spark, files(spark, spec), str(tmp_path / "in"))
    log = compactor.stored_record_log(spark, str(tmp_path / "in"), items)
    sealed = {r["key"]: r for r in compactor.seal(log).collect()}
    assert sealed["metal/milltray__scan.jpg"]["image"] == b"12" and sealed["metal/milltray__scan.jpg"]["label"] == b""
    assert sealed["metal/milltray__scan.jpg"]["copies"] == 4
    assert sealed["paper/brinewharf__w1.jpg"]["image"] is None and bytes(sealed["paper/brinewharf__w1.jpg"]["label"]) == b"0 .5 .5 .1 .1"
    assert len(sealed) == 2


def test_pairs_equal_brute_force(spark):
    data = [(i, f"k{i % 4}", "image" if i % 3 else "label") for i in range(40)]
    log = spark.createDataFrame(data, "file_id bigint, key string, kind string")
    want = {(a[0], b[0]) for a, b in combinations(data, 2) if a[1:] == b[1:]}
    assert rows(compactor.same_record_pairs(log)) == want


def test_no_files(spark, items, tmp_path):
    write(spark, files(spark, []), str(tmp_path / "in"))
    log = compactor.stored_record_log(spark, str(tmp_path / "in"), items)
    assert log.count() == 0 and compactor.seal(log).count() == 0 and compactor.same_record_pairs(log).count() == 0


def test_extra_columns_with_clashing_names(spark, items, tmp_path):
    df = files(spark, [(1, "a/milltray__scan.jpg", b"1")]).withColumn("key", F.lit("no")).withColumn("kind", F.lit("no")).withColumn("own", F.lit("no"))
    items = items.withColumn("kind", F.lit("no")).withColumn("body", F.lit("no")).withColumn("less", F.lit("no"))
    assert rows(compactor.bind_files(df, items), "key", "kind") == {("metal/milltray__scan.jpg", "image")}


def test_any_number_of_copy_marks(spark, items):
    spec = [(1, "a/milltray__scan (7) (1) (1) (1) (1).jpg", b"a"), (2, "a/milltray__scan_copy2 - Copy (3).copy (1) - copy.JPG", b"b"), (3, "a/milltray__none (1) (1) (1) (1).jpg", b"c"), (4, "a/milltray__scan (1) x.jpg", b"c")]
    got = rows(compactor.bind_files(files(spark, spec), items), "file_id", "key")
    assert got == {(1, "metal/milltray__scan (7).jpg"), (2, "metal/milltray__scan.jpg")}
