"""Fetching and unpacking source archives on the driver, and packing finished sets."""

from __future__ import annotations

import hashlib
import json
import shutil
import tarfile
import time
import urllib.request
import zipfile
from collections.abc import Callable, Iterable
from pathlib import Path
from typing import IO

from siftlane.sources.registry import ConfigError, Source


class FetchError(RuntimeError):
    """An archive that can't be had or doesn't verify."""


def sha256_of(path: Path) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while chunk := f.read(1 << 20):
            digest.update(chunk)
    return digest.hexdigest()


def fetch(source: Source, scratch: Path) -> Path:
    """The archive of a source under ``scratch``; kinds that need a tool of their own are refused."""
    scratch.mkdir(parents=True, exist_ok=True)
    kind, ref = source.fetcher.kind, source.fetcher.ref
    target = scratch / Path(ref).name
    if kind == "local":
        if not Path(ref).is_file():
            raise FetchError(f"{source.name}: no file {ref}")
        shutil.copy2(ref, target)
    elif kind == "http":
        with urllib.request.urlopen(ref) as answer, open(target, "wb") as out:
            shutil.copyfileobj(answer, out)
    else:
        raise FetchError(f"{source.name}: archives of kind {kind} must be fetched by hand and given as local")
    return target


def _inside(dest: Path, name: str) -> Path:
    path = (dest / name).resolve()
    if not path.is_relative_to(dest.resolve()):
        raise FetchError(f"{name} leads out of the target folder")
    return path


def _written(path: Path, source: Callable[[], IO[bytes] | None]) -> bool:
    """Write a file unless it is there."""
    if path.exists():
        return False
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(path.name + ".unpacking")
    src = source()
    assert src is not None
    with src, open(part, "wb") as out:
        shutil.copyfileobj(src, out)
    part.replace(path)
    return True


def extract(archive: Path, dest: Path) -> int:
    """Unpack zip, tar or tar.gz; links and paths that lead out are refused before anything is written. A file that exists stays as it is, so an
    interrupted unpacking goes on where it stopped: a file is written under another name first. Returns the files written."""
    dest.mkdir(parents=True, exist_ok=True)
    if zipfile.is_zipfile(archive):
        with zipfile.ZipFile(archive) as z:
            names = [i for i in z.infolist() if not i.is_dir()]
            for i in names:
                if (i.external_attr >> 16) & 0o170000 == 0o120000:
                    raise FetchError(f"{i.filename} is a link")
                _inside(dest, i.filename)
            return sum(_written(dest / i.filename, lambda i=i: z.open(i)) for i in names)
    if tarfile.is_tarfile(archive):
        with tarfile.open(archive) as t:
            members = [m for m in t.getmembers() if not m.isdir()]
            for m in members:
                if not m.isfile():
                    raise FetchError(f"{m.name} is no plain file")
                _inside(dest, m.name)
            return sum(_written(dest / m.name, lambda m=m: t.extractfile(m)) for m in members)
    raise FetchError(f"{archive.name}: unknown kind of archive")


def download(source: Source, raw_root: Path, scratch: Path, force: bool = False) -> dict:
    """Fetch, verify and unpack a source once.

    With a manifest in place nothing is done, unless ``force``; but one whose sha256 isn't the registry's is an error, since raw files are never
    changed: the old ones must be moved away first.
    """
    dest = raw_root / source.name
    manifest = dest / ".manifest.json"
    wanted = source.fetcher.sha256
    if manifest.is_file() and not force:
        record = json.loads(manifest.read_text())
        if wanted not in (None, record["sha256"]):
            raise FetchError(f"{source.name}: what is there has the sha256 {record['sha256']}, the registry wants {wanted}; move it away and fetch again")
        return record
    archive = fetch(source, scratch)
    digest = sha256_of(archive)
    if wanted not in (None, digest):
        raise FetchError(f"{source.name}: the archive's sha256 is {digest}, not {wanted}")
    extract(archive, dest)
    files = sum(p.is_file() and p != manifest for p in dest.rglob("*"))
    record = {"source": source.name, "sha256": digest, "files": files, "fetched_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())}
    manifest.write_text(json.dumps(record, sort_keys=True))
    return record


def download_all(sources: Iterable[Source], raw_root: Path, scratch: Path, force: bool = False) -> list[dict]:
    """`download` of each source in order; the first error ends it."""
    return [download(s, raw_root, scratch / s.name, force) for s in sources]


def pack(folder: Path, archive: Path) -> Path:
    """A tar.gz of a folder, entries in order of their names."""
    if not folder.is_dir():
        raise ConfigError(f"no folder {folder}")
    with tarfile.open(archive, "w:gz") as t:
        for p in sorted(folder.rglob("*")):
            t.add(p, p.relative_to(folder).as_posix(), recursive=False)
    return archive
