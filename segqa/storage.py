"""Files that tasks write and read by themselves, in any store Arrow knows."""

from __future__ import annotations

from pyarrow import fs


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``path`` and the path in it."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def names(store: fs.FileSystem, folder: str, suffix: str) -> list[str]:
    """Paths of the files with ``suffix`` in a folder, in order; none if there is no folder."""
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.path for f in found if f.is_file and f.path.endswith(suffix))


def publish(store: fs.FileSystem, path: str, data: bytes) -> None:
    """Make a file appear whole or not at all: written under a hidden name, then moved."""
    folder, name = path.rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    hidden = f"{folder}/_{name}"
    with store.open_output_stream(hidden) as out:
        out.write(data)
    store.move(hidden, path)
