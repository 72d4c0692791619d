"""Files of a shared folder, for the parts that run in Python: on the driver, or one file per task."""

from __future__ import annotations

from pyarrow import fs


def shared_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it; a path without a scheme is one of this machine."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def listed(system: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    """What a folder holds, names of unfinished or hidden files left out; nothing if it is not there."""
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted((f for f in found if f.base_name[:1] not in "_."), key=lambda f: f.base_name)
