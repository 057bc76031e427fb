"""Fetching snapshots before a run, on the driver: files, repositories, archives, hub datasets. A manifest pins each."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import subprocess
import urllib.request
import zipfile
from collections.abc import Callable
from pathlib import Path

from tessera.sources.writers import utc_now, write_json


def digest_of(path: str | Path, algorithm: str = "sha256") -> str:
    h = hashlib.new(algorithm)
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            h.update(block)
    return h.hexdigest()


def revision_of(manifest: dict) -> str:
    """The first of revision, commit and sha256 that a manifest has."""
    return str(next((manifest[k] for k in ("revision", "commit", "sha256") if manifest.get(k)), None))


def fetch_file(url: str, path: Path, agent: str = "tessera/0.1", timeout: int = 120) -> dict:
    """Download a file once, aside first; returns its manifest."""
    manifest = path.with_name("manifest.json")
    if path.exists() and manifest.exists():
        return json.loads(manifest.read_text(encoding="utf-8"))
    path.parent.mkdir(parents=True, exist_ok=True)
    aside = path.with_name(path.name + ".part")
    request = urllib.request.Request(url, headers={"User-Agent": agent})
    with urllib.request.urlopen(request, timeout=timeout) as answer, aside.open("wb") as out:
        shutil.copyfileobj(answer, out)
    aside.replace(path)
    found = {"url": url, "sha256": digest_of(path), "created_at": utc_now()}
    write_json(str(manifest), found)
    return found


def clone(url: str, folder: Path, run: Callable = subprocess.run) -> dict:
    """A shallow clone, reused if it is there; a folder that is no repository is an error."""
    if folder.exists() and not (folder / ".git").exists():
        raise RuntimeError(f"{folder} is not a repository")
    if not folder.exists():
        folder.parent.mkdir(parents=True, exist_ok=True)
        run(["git", "clone", "--depth", "1", url, str(folder)], check=True)
    commit = run(["git", "-C", str(folder), "rev-parse", "HEAD"], check=True, capture_output=True, text=True).stdout.strip()
    found = {"url": url, "commit": commit, "created_at": utc_now()}
    write_json(str(folder.parent / f"{folder.name}.manifest.json"), found)
    return found


def hub_snapshot(dataset: str, folder: Path, patterns: list[str] | None = None, revision: Callable[[str], str] | None = None, download: Callable | None = None) -> dict:
    """A hub dataset at a pinned revision, fetched once. The client functions can be handed in; else the hub library must be there."""
    manifest = folder.parent / f"{folder.name}.manifest.json"
    if folder.exists() and manifest.exists():
        return json.loads(manifest.read_text(encoding="utf-8"))
    if revision is None or download is None:
        try:
            from huggingface_hub import HfApi, snapshot_download
        except ImportError as e:
            raise RuntimeError("fetching hub datasets needs the huggingface_hub package") from e
        revision = revision or (lambda d: HfApi().dataset_info(d).sha)
        download = download or snapshot_download
    pinned = revision(dataset)
    download(repo_id=dataset, repo_type="dataset", revision=pinned, local_dir=str(folder), allow_patterns=patterns)
    files = sum(1 for p in folder.rglob("*") if p.is_file() and ".cache" not in p.parts)
    found = {"dataset": dataset, "revision": pinned, "files": files, "created_at": utc_now()}
    write_json(str(manifest), found)
    return found


def unpack(archive: Path, folder: Path, md5: str | None = None) -> Path:
    """Extract a zip archive once, after its digest is checked; names that lead outside the folder are an error."""
    done = folder / ".extracted"
    if done.exists():
        return folder
    if md5 and digest_of(archive, "md5") != md5:
        raise RuntimeError(f"{archive} has another digest than expected")
    top = folder.resolve()
    with zipfile.ZipFile(archive) as z:
        for name in z.namelist():
            if os.path.commonpath([top, (folder / name).resolve()]) != str(top):
                raise RuntimeError(f"unsafe name in archive: {name}")
        z.extractall(folder)
    done.write_text(utc_now())
    return folder
