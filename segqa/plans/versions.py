"""Versions of a dataset: a build becomes visible as a whole or not at all."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame

from ..storage import names, place, publish
from .build import Dataset, build_dataset

_COMMITS = "_commits"


def build_version(videos: DataFrame, out: str, name: str, **options) -> Dataset:
    """``build_dataset`` into a new folder below ``out``, then made the current version.

    All files of a build lie below its folder, and one small file, published last, names it. Until
    then readers of ``current_version`` see the version before; a build that fails leaves it as it
    was. Earlier versions stay. One build of a dataset at a time.
    """
    out = out.rstrip("/")
    folder = f"version-{uuid.uuid4().hex}"
    dataset = build_dataset(videos, f"{out}/{folder}", name, **options)
    store, path = place(out)
    number = len(versions(out)) + 1
    commit = json.dumps({"version": number, "folder": folder, "name": name})
    publish(store, f"{path}/{_COMMITS}/{number:08d}.json", commit.encode())
    return dataset


def versions(out: str) -> list[str]:
    """Folders of all versions of a dataset, oldest first."""
    store, path = place(out.rstrip("/"))
    found = []
    for commit in names(store, f"{path}/{_COMMITS}", ".json"):
        with store.open_input_stream(commit) as source:
            found.append(f"{out.rstrip('/')}/{json.loads(source.read())['folder']}")
    return found


def current_version(out: str) -> str:
    """Folder of the newest version, with ``flat``, ``splits``, ``info`` and the like in it."""
    found = versions(out)
    if not found:
        raise ValueError(f"no version below {out}")
    return found[-1]
