from __future__ import annotations

import io
import json
import tarfile
import zipfile
from dataclasses import dataclass

import pytest

from siftlane.operators.checks import DataError, require_columns, require_disjoint, require_subset, require_unique
from siftlane.plans import pipeline
from siftlane.sources import archives, readers, registry, sinks
from tests.conftest import rows

CLASSES = ("plastic", "paper")


def source(**kw):
    base = {"name": "s", "fetcher": {"kind": "local", "ref": "x.zip"}, "license": "MIT", "attribution": "a", "annotation_type": "cls", "background": "clean", "mapping": {"Plastic": "plastic", "Trash": "DROP"}}
    return base | kw


@pytest.mark.parametrize(
    ("change", "names"),
    [
        ({"colour": 1}, "colour"), ({"license": 3}, "license"), ({"fetcher": {"kind": "ftp", "ref": "x"}}, "fetcher.kind"), ({"fetcher": {"kind": "local", "ref": "x", "sha256": "zz"}}, "sha256"),
        ({"mapping": {"a": "wood"}}, "wood"), ({"mapping": {"A": "plastic", "a": "paper"}}, "several"), ({"drops": ["plastic"]}, "several"), ({"mapping": {}}, "empty"), ({"license": " "}, "license"), ({"name": ""}, "name"), ({"box_order": ["dino", "dino"]}, "box_order"), ({"box_order": ["sam"]}, "box_order"), ({"class_names": []}, "class_names"), ({"class_names": ["Plastic", " "]}, "class_names"), ({"cap": {"paper": 0}}, "cap.paper"), ({"cap": {"paper": True}}, "cap"),
        ({"cap": {"wood": 3}}, "cap.wood"), ({"class_names": ["Plastic", "plastic"]}, "class_names"), ({"class_names": ["wood"]}, "class_names"), ({"annotation_type": "seg"}, "annotation_type"), ({"role": "x"}, "role"),
    ],
)
def test_refused_sources(change, names):
    with pytest.raises(registry.ConfigError, match=names):
        registry.parse_registry({"sources": [source(**change)]}, CLASSES)


def test_registry(spark, tmp_path):
    data = {"sources": [source(), source(name="t", cap={"paper": 5}, drops=["shoes"], role="test_only", class_names=["Plastic", "shoes"])]}
    (tmp_path / "r.yaml").write_text(json.dumps(data))
    loaded = registry.load_registry(tmp_path / "r.yaml", CLASSES)
    df = registry.registry_table(spark, loaded)
    assert rows(df, "source", "priority", "role") == {("s", 1, None), ("t", 2, "test_only")}
    for bad in ({"sources": [source(), source()]}, {"other": []}, {"sources": [{k: v for k, v in source().items() if k != "license"}]}):
        with pytest.raises(registry.ConfigError):
            registry.parse_registry(bad, CLASSES)
    for classes in ((), ("a", "a"), ("rest",)):
        with pytest.raises(registry.ConfigError):
            registry.check_classes(classes)


@dataclass(frozen=True)
class Inner:
    x: float
    pair: tuple[int, int]


@dataclass(frozen=True)
class Outer:
    inner: Inner
    names: tuple[str, ...]
    limit: int | None = None


def test_typed_config():
    got = registry.build(Outer, {"inner": {"x": 1, "pair": [1, 2]}, "names": ["a"]})
    assert got == Outer(Inner(1.0, (1, 2)), ("a",))
    for bad, where in [({"inner": {"x": True, "pair": [1, 2]}, "names": []}, "inner.x"), ({"inner": {"x": 1, "pair": [1]}, "names": []}, "pair"), ({"inner": {"x": 1, "pair": [1, 2]}, "names": [], "limit": 1.5}, "limit"), ({"inner": 3, "names": []}, "inner")]:
        with pytest.raises(registry.ConfigError, match=where):
            registry.build(Outer, bad)


def test_class_index(tmp_path):
    (tmp_path / "data.yaml").write_text("names: {0: a, 1: b}")
    (tmp_path / "classes.txt").write_text("a\nb\n\n")
    assert registry.class_index(data_yaml=tmp_path / "data.yaml", classes_txt=tmp_path / "classes.txt") == ["a", "b"]
    assert registry.class_index(["z"], tmp_path / "data.yaml") == ["z"]
    (tmp_path / "classes.txt").write_text("b\na\n")
    with pytest.raises(registry.ConfigError):
        registry.class_index(data_yaml=tmp_path / "data.yaml", classes_txt=tmp_path / "classes.txt")
    (tmp_path / "data.yaml").write_text("names: {0: a, 2: b}")
    for kw in ({"data_yaml": tmp_path / "data.yaml"}, {}):
        with pytest.raises(registry.ConfigError):
            registry.class_index(**kw)


def write(path, lines):
    path.write_text("".join(json.dumps(x) + "\n" if not isinstance(x, str) else x for x in lines))
    return str(path)


DET = {"image_id": "i", "object_id": "o", "class_id": 1, "score": 0.5, "severity": 0}


def test_detections(spark, tmp_path):
    assert readers.read_detections(spark, write(tmp_path / "a", [DET, "\n", DET])).count() == 2
    with pytest.raises(DataError):
        readers.read_detections(spark, write(tmp_path / "b", [{k: v for k, v in DET.items() if k != "score"}]))
    with pytest.raises(Exception):  # noqa: B017
        readers.read_detections(spark, write(tmp_path / "c", [DET | {"class_id": "x"}])).count()
    empty = write(tmp_path / "d", [])
    assert readers.read_detections(spark, empty).count() == 0
    with pytest.raises(DataError):
        readers.read_detections(spark, empty, nonempty=True)


def test_provenance(spark, tmp_path):
    one = {"image": "x/a.jpg", "source": "s", "method": "dino", "confidence": 0.4}
    got = readers.read_provenance(spark, write(tmp_path / "a", [one, one | {"image": "b.jpg", "flags": ["multibox"]}]))
    assert {(r["stem"], tuple(r["flags"])) for r in got.collect()} == {("a", ()), ("b", ("multibox",))}
    for bad in ([one, one], [one | {"method": "yolo"}]):
        with pytest.raises(DataError):
            readers.read_provenance(spark, write(tmp_path / "b", bad))
    groups = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("a", "y", 3)], "grp string, stem string, n int")
    assert rows(readers.merge_provenance(groups), "stem", "n") == {("x", 2), ("y", 3)}


def test_csv_readers(spark, tmp_path):
    head = "tau_frame,min_votes,high_water,wrong_bin_rate,rest_rate,chosen\n"
    (tmp_path / "s.csv").write_text(head + "0.4,3,0.6,0.01,0.2,1\n")
    assert readers.read_sweep(spark, str(tmp_path / "s.csv")).first()["chosen"] == 1
    for text in (head, head + "0.4,3,0.6,0.01,0.2,2\n", "a,b\n1,2\n"):
        (tmp_path / "s.csv").write_text(text)
        with pytest.raises(DataError):
            readers.read_sweep(spark, str(tmp_path / "s.csv"))
    (tmp_path / "r.csv").write_text("  epoch,  loss \n 1, 0.5\n 2, 0.4\n")
    assert rows(readers.read_training_metrics(spark, str(tmp_path / "r.csv"))) == {(1, 0.5), (2, 0.4)}
    for text in ("loss\n1\n", "epoch,loss\n1,x\n", "epoch\n"):
        (tmp_path / "r.csv").write_text(text)
        with pytest.raises(DataError):
            readers.read_training_metrics(spark, str(tmp_path / "r.csv"))


def test_item_tree(spark, tmp_path):
    for p in ("plastic/s__a.jpg", "plastic/s__a.txt", "paper/t__b.PNG", "paper/notes.csv"):
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_text("x")
    got = {r["key"]: (r["class_name"], r["source"], r["label"] is not None) for r in readers.scan_items(spark, str(tmp_path), CLASSES).collect()}
    assert got == {"plastic/s__a.jpg": ("plastic", "s", True), "paper/t__b.PNG": ("paper", "t", False)}
    (tmp_path / "paper/odd.jpg").write_text("x")
    with pytest.raises(DataError):
        readers.scan_items(spark, str(tmp_path), CLASSES)
    with pytest.raises(DataError):
        readers.scan_items(spark, str(tmp_path), ("glass",))


def test_split_index(spark):
    df = spark.createDataFrame([("p/s__a.jpg", "val", None), ("q/s__b.jpg", "val", "g")], "key string, split string, group_id string")
    assert rows(readers.split_index(df), "stem") == {("s__a",), ("s__b",)}
    with pytest.raises(DataError):
        readers.split_index(df.union(spark.createDataFrame([("q/s__a.png", "val", None)], df.schema)))


def test_checks(spark):
    a, b = spark.createDataFrame([("x",), ("y",)], "k string"), spark.createDataFrame([("x",)], "k string")
    require_subset(b, a, "k", "m")
    require_unique(a, ["k"], "m")
    require_columns(a, ["k"], exact=True)
    for f in (lambda: require_subset(a, b, "k", "m"), lambda: require_disjoint(a, b, "k", "m"), lambda: require_unique(a.union(b), ["k"], "m"), lambda: require_columns(a, ["z"])):
        with pytest.raises(DataError):
            f()


def zipped(path, names):
    with zipfile.ZipFile(path, "w") as z:
        for n in names:
            z.writestr(n, "data")
    return path


def test_archives(tmp_path):
    good = zipped(tmp_path / "a.zip", ["p/a.jpg", "q/b.jpg"])
    assert archives.extract(good, tmp_path / "out") == 2 and (tmp_path / "out/p/a.jpg").read_text() == "data"
    (tmp_path / "out/p/a.jpg").write_text("mine")
    (tmp_path / "out/q/b.jpg").unlink()
    assert archives.extract(good, tmp_path / "out") == 1  # goes on where it stopped, and nothing is overwritten
    assert (tmp_path / "out/p/a.jpg").read_text() == "mine" and (tmp_path / "out/q/b.jpg").read_text() == "data"
    with pytest.raises(archives.FetchError):
        archives.extract(zipped(tmp_path / "b.zip", ["../evil"]), tmp_path / "out2")
    assert not (tmp_path / "evil").exists()
    with tarfile.open(tmp_path / "c.tar.gz", "w:gz") as t:
        link = tarfile.TarInfo("l")
        link.type, link.linkname = tarfile.SYMTYPE, "/etc/passwd"
        t.addfile(link)
    with pytest.raises(archives.FetchError):
        archives.extract(tmp_path / "c.tar.gz", tmp_path / "out3")
    with tarfile.open(tmp_path / "d.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("x/y.txt")
        info.size = 2
        t.addfile(info, io.BytesIO(b"hi"))
    assert archives.extract(tmp_path / "d.tar.gz", tmp_path / "out4") == 1
    (tmp_path / "e.bin").write_text("?")
    with pytest.raises(archives.FetchError):
        archives.extract(tmp_path / "e.bin", tmp_path / "out5")
    packed = archives.pack(tmp_path / "out4", tmp_path / "f.tar.gz")
    assert archives.extract(packed, tmp_path / "out6") == 1


def test_download(tmp_path):
    archive = zipped(tmp_path / "a.zip", ["p/a.jpg"])
    good = registry.build(registry.Source, source(fetcher={"kind": "local", "ref": str(archive)}))
    first = archives.download(good, tmp_path / "raw", tmp_path / "scratch")
    assert archives.download(good, tmp_path / "raw", tmp_path / "scratch") == first and first["files"] == 1
    wrong = registry.build(registry.Source, source(name="w", fetcher={"kind": "local", "ref": str(archive), "sha256": "0" * 64}))
    with pytest.raises(archives.FetchError, match="sha256"):
        archives.download(wrong, tmp_path / "raw", tmp_path / "scratch")
    other = registry.build(registry.Source, source(fetcher={"kind": "local", "ref": str(archive), "sha256": "1" * 64}))
    with pytest.raises(archives.FetchError, match="move it away"):
        archives.download(other, tmp_path / "raw", tmp_path / "scratch")
    forced = archives.download_all([good], tmp_path / "raw", tmp_path / "scratch", force=True)
    assert [f["sha256"] for f in forced] == [first["sha256"]] and forced[0]["files"] == 1
    for kind, ref in (("local", "gone.zip"), ("kaggle", "a/b")):
        with pytest.raises(archives.FetchError):
            archives.fetch(registry.build(registry.Source, source(fetcher={"kind": kind, "ref": ref})), tmp_path / "scratch")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("paper/s__a.jpg", "train", "i", "0 .5 .5 .1 .1"), ("paper/s__b.jpg", "val", "i", "")], "key string, split string, image string, label_text string")
    about = sinks.emit_dataset(df, str(tmp_path / "set"), CLASSES)
    assert list(about["splits"]) == ["train", "val"]
    assert rows(spark.read.parquet(str(tmp_path / "set")), "name", "split") == {("paper__s__a.jpg", "train"), ("paper__s__b.jpg", "val")}
    assert readers.read_split(spark, str(tmp_path / "set"), "val").count() == 1
    with pytest.raises(DataError):
        readers.read_split(spark, str(tmp_path / "set"), "test")
    with pytest.raises(DataError):
        sinks.emit_dataset(df.union(spark.createDataFrame([("k", "val", "i", None)], df.schema)), str(tmp_path / "set2"), CLASSES)
    sinks.write_by_source(spark.createDataFrame([("a", 1), ("b", 1)], "source string, n int"), str(tmp_path / "by"))
    sinks.write_by_source(spark.createDataFrame([("a", 2)], "source string, n int"), str(tmp_path / "by"))
    assert rows(spark.read.parquet(str(tmp_path / "by")), "source", "n") == {("a", 2), ("b", 1)}
    assert json.loads(sinks.read_note(spark, str(tmp_path / "set/_dataset.json")))["names"]["0"] == CLASSES[0] and sinks.read_note(spark, str(tmp_path / "none")) is None
    sinks.append_run({"a": 1}, tmp_path / "log")
    sinks.append_run({"a": 2}, tmp_path / "log")
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    sinks.write_stage(df, str(tmp_path / "stage"), ["key"])
    sinks.write_json_lines(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).columns == sorted(df.columns)
    queue = spark.createDataFrame([("i", 0.1, "box_count", "box_count|centerbox"), ("i", 0.1, "centerbox", "box_count|centerbox")], "image string, confidence double, flag string, all_flags string")
    sinks.write_review_queue(queue, str(tmp_path / "q"))
    assert sorted(p.name for p in (tmp_path / "q").glob("flag=*")) == ["flag=box_count", "flag=centerbox"]


def stages(done, log, fail=None):
    def run(name):
        if name == fail:
            raise ValueError("broken")
        log.append(name)
        done.add(name)

    return [pipeline.Stage(n, lambda n=n: run(n), lambda n=n: n in done, f"look at {n}") for n in ("one", "two", "three")]


def test_stage_runner():
    done, log = {"one"}, []
    assert pipeline.run_stages(stages(done, log)) == ["two", "three"]
    assert pipeline.run_stages(stages(done, log)) == []
    assert pipeline.run_stages(stages(done, log), only="two", force=True) == ["two"]
    with pytest.raises(pipeline.StageError, match="look at two"):
        pipeline.run_stages(stages(set(), [], fail="two"))
    with pytest.raises(pipeline.StageError):
        pipeline.run_stages(stages(set(), []), only="two")
    with pytest.raises(pipeline.StageError):
        pipeline.run_stages(stages(set(), []), only="four")
    assert pipeline.run_stages(stages({"one", "two", "three"}, []), start="two", force=True) == ["two", "three"]
    assert pipeline.run_stages(stages({"one", "two"}, []), start="two") == ["three"]
    with pytest.raises(pipeline.StageError, match="one"):
        pipeline.run_stages(stages({"two"}, []), start="two")
    with pytest.raises(pipeline.StageError, match="repeat"):
        pipeline.run_stages([*stages(set(), []), *stages(set(), [])])

    def halt():
        raise pipeline.Halt("review")

    with pytest.raises(pipeline.Halt):
        pipeline.run_stages([pipeline.Stage("h", halt, lambda: False)])


def test_fingerprint_and_cache(tmp_path):
    a = pipeline.fingerprint({"x": 1, "y": (1, 2)}, b"registry")
    assert a == pipeline.fingerprint({"y": [1, 2], "x": 1}, b"registry") != pipeline.fingerprint({"x": 1, "y": [1, 2]}, b"other")
    built = []
    build = lambda p: built.append(p)
    assert pipeline.restore_or_build(a, tmp_path / "c", lambda f, p: False, build).status == "rebuilt"
    assert pipeline.restore_or_build(a, tmp_path / "c", lambda f, p: False, build).status == "local"
    assert pipeline.restore_or_build("new", tmp_path / "c", lambda f, p: True, build).status == "restored" and len(built) == 1


def test_run_record_and_guards():
    assert pipeline.run_record("r", {"a": 1}, {"m": 0.5}, 0.0)["fingerprint"] == pipeline.fingerprint({"a": 1})
    assert pipeline.device_tier(39.5, 8) == (64, 8) and pipeline.device_tier(0, 16) == (16, 8)
    pipeline.check_recipe({"optimizer": "sgd"}, {"optimizer": ["auto"]})
    with pytest.raises(pipeline.StageError):
        pipeline.check_recipe({"optimizer": "auto"}, {"optimizer": ["auto"]})
