"""Typed configuration and the source registry: closed-world, fail-fast readers on the driver."""

from __future__ import annotations

import dataclasses
import re
import types
import typing
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# What the enumerations of a source may say.
FETCHERS, ANNOTATIONS, BACKGROUNDS, ROLES = ("kaggle", "http", "local"), ("cls", "det"), ("clean", "wild"), (None, "test_only")
BOX_METHODS = ("dino", "birefnet", "centerbox")
_SHA256 = re.compile(r"^[0-9a-f]{64}$")


class ConfigError(ValueError):
    """A configuration that breaks a rule; the message names the key."""


def convert(value: Any, kind: Any, where: str) -> Any:
    """``value`` as ``kind`` (dataclasses, tuples, dicts, unions with None and plain types), or an error that names ``where``.

    A bool is no number; an int may stand for a float.
    """
    origin, args = typing.get_origin(kind), typing.get_args(kind)
    if origin in (typing.Union, types.UnionType):
        if value is None and type(None) in args:
            return None
        (inner,) = [a for a in args if a is not type(None)]
        return convert(value, inner, where)
    if dataclasses.is_dataclass(kind):
        return build(kind, value, where)
    if origin is tuple:
        if not isinstance(value, list | tuple):
            raise ConfigError(f"{where}: expected a list")
        if len(args) == 2 and args[1] is Ellipsis:
            return tuple(convert(v, args[0], f"{where}[{k}]") for k, v in enumerate(value))
        if len(args) != len(value):
            raise ConfigError(f"{where}: expected {len(args)} entries")
        return tuple(convert(v, a, f"{where}[{k}]") for k, (v, a) in enumerate(zip(value, args, strict=True)))
    if origin is dict:
        if not isinstance(value, Mapping):
            raise ConfigError(f"{where}: expected a mapping")
        return {convert(k, args[0], f"{where} key"): convert(v, args[1], f"{where}.{k}") for k, v in value.items()}
    if kind is float and isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    if kind is Path and isinstance(value, str):
        return Path(value)
    if not isinstance(value, kind) or (isinstance(value, bool) and kind is not bool):
        raise ConfigError(f"{where}: expected {getattr(kind, '__name__', kind)}, got {type(value).__name__}")
    return value


def build(cls: Any, data: Any, where: str = "config") -> Any:
    """A dataclass from a mapping with exactly its keys (those with defaults may be missing)."""
    if not isinstance(data, Mapping):
        raise ConfigError(f"{where}: expected a mapping")
    hints = typing.get_type_hints(cls)
    fields = {f.name: f for f in dataclasses.fields(cls)}
    unknown = sorted(str(k) for k in data if k not in fields)
    if unknown:
        raise ConfigError(f"{where}: unknown keys {unknown}")
    missing = [n for n, f in fields.items() if n not in data and f.default is dataclasses.MISSING and f.default_factory is dataclasses.MISSING]
    if missing:
        raise ConfigError(f"{where}: missing keys {missing}")
    return cls(**{k: convert(v, hints[k], f"{where}.{k}") for k, v in data.items()})


@dataclass(frozen=True)
class Fetcher:
    kind: str
    ref: str
    sha256: str | None = None


@dataclass(frozen=True)
class Source:
    """One source; the order of the registry is the priority of deduplication."""

    name: str
    fetcher: Fetcher
    license: str
    attribution: str
    annotation_type: str
    background: str
    mapping: dict[str, str]
    drops: tuple[str, ...] = ()
    cap: dict[str, int] = field(default_factory=dict)
    role: str | None = None
    class_names: tuple[str, ...] | None = None
    box_order: tuple[str, ...] | None = None


def check_classes(classes: tuple[str, ...]) -> None:
    if not classes or len(set(classes)) != len(classes):
        raise ConfigError("classes: must be unique and not empty")
    if "rest" in classes:
        raise ConfigError("classes: rest is the outcome without a class, not a class")


def _faults(s: Source, classes: tuple[str, ...]) -> Iterator[str]:
    """What is wrong with a source, one rule after another."""
    texts = {"name": s.name, "license": s.license, "attribution": s.attribution, "fetcher.ref": s.fetcher.ref}
    yield from (f"{key} must not be blank" for key, text in texts.items() if not text.strip())
    choices = {"fetcher.kind": (s.fetcher.kind, FETCHERS), "annotation_type": (s.annotation_type, ANNOTATIONS), "background": (s.background, BACKGROUNDS), "role": (s.role, ROLES)}
    yield from (f"{key} must be one of {allowed}" for key, (value, allowed) in choices.items() if value not in allowed)
    if not _SHA256.match(s.fetcher.sha256 or "0" * 64):
        yield "fetcher.sha256 must be 64 hexadecimal digits"
    if not s.mapping:
        yield "mapping must not be empty"
    targets: dict[str, set[str]] = {}
    for label, target in [*s.mapping.items(), *((label, "DROP") for label in s.drops)]:
        targets.setdefault(label.lower(), set()).add(target)
    yield from (f"{label} has several targets, {sorted(t)}" for label, t in targets.items() if len(t) > 1)
    yield from (f"mapping leads to {t}, which is no class" for t in sorted(set().union(*targets.values()) - {*classes, "DROP"}))
    names = [n.strip().lower() for n in s.class_names or ()]
    strange = {"no names": s.class_names == (), "blanks": "" in names, "repeats": len(set(names)) < len(names), "names neither mapped nor dropped": not targets.keys() >= set(names)}
    yield from (f"class_names has {what}" for what, there in strange.items() if there)
    yield from (f"cap.{target} must be a positive number for a class" for target, most in s.cap.items() if target not in classes or isinstance(most, bool) or most <= 0)
    steps = s.box_order or ()
    if len(set(steps)) < len(steps) or not set(steps) <= set(BOX_METHODS):
        yield f"box_order must name methods of {BOX_METHODS}, each once"


def check_source(s: Source, classes: tuple[str, ...]) -> None:
    fault = next(_faults(s, classes), None)
    if fault:
        raise ConfigError(f"source {s.name}: {fault}")


def load_yaml(path: str | Path) -> Any:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)


def parse_registry(data: Any, classes: tuple[str, ...]) -> tuple[Source, ...]:
    check_classes(classes)
    if not isinstance(data, Mapping) or set(data) != {"sources"}:
        raise ConfigError("registry: expected exactly the key 'sources'")
    if not data["sources"]:
        raise ConfigError("registry: sources must not be empty")
    sources = tuple(build(Source, s, f"sources[{k}]") for k, s in enumerate(data["sources"]))
    names = [s.name for s in sources]
    if len(set(names)) != len(names):
        raise ConfigError("registry: names of sources repeat")
    for s in sources:
        check_source(s, classes)
    return sources


def load_registry(path: str | Path, classes: tuple[str, ...]) -> tuple[Source, ...]:
    return parse_registry(load_yaml(path), classes)


SPEC_SCHEMA = "source string, priority int, license string, annotation_type string, background string, role string, mapping map<string,string>, drops array<string>, cap map<string,int>"


def registry_table(spark: SparkSession, sources: tuple[Source, ...]) -> DataFrame:
    """The registry as the dimension table that the operators join."""
    rows = [(s.name, k + 1, s.license, s.annotation_type, s.background, s.role, s.mapping, list(s.drops), s.cap) for k, s in enumerate(sources)]
    return spark.createDataFrame(rows, SPEC_SCHEMA)


def class_index(explicit: list[str] | None = None, data_yaml: str | Path | None = None, classes_txt: str | Path | None = None) -> list[str]:
    """The class names of a source in index order: given ones, else ``names`` of a data file (a list, or a map of 0..n-1), else a text file of
    one name per line. Two files that disagree are an error, and so is having none."""
    if explicit is not None:
        return list(explicit)
    found: list[list[str]] = []
    if data_yaml and Path(data_yaml).is_file():
        names = load_yaml(data_yaml).get("names")
        if isinstance(names, Mapping):
            if sorted(names) != list(range(len(names))):
                raise ConfigError(f"{data_yaml}: names must be numbered from 0 without gaps")
            names = [names[k] for k in range(len(names))]
        if not isinstance(names, list):
            raise ConfigError(f"{data_yaml}: names missing")
        found.append([str(n) for n in names])
    if classes_txt and Path(classes_txt).is_file():
        found.append([x.strip() for x in Path(classes_txt).read_text(encoding="utf-8").splitlines() if x.strip()])
    if not found:
        raise ConfigError("no class names found")
    if any(f != found[0] for f in found[1:]):
        raise ConfigError("class names of two files disagree")
    return found[0]
