"""Numbered manifest files in a folder of the shared store.

A source that is not files of Spark's own needs to say which of its files
count. ``add`` writes a given number and fails if another writer has written it
(for entries that build on the one before); ``append`` writes the next number
under a name of its own (for entries in any order, by a data-source process,
which has no session). Entries appear whole or not at all. Driver and data-source
processes both read them through Arrow's file systems.
"""

from __future__ import annotations

import json
import uuid

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def entries(folder: str, after: int = 0) -> list[tuple[int, dict]]:
    """(number, entry) of all entries above ``after``, in order."""
    system, path = locate(folder)
    infos = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    found = sorted((int(i.base_name[:8]), i.path) for i in infos if i.base_name.endswith(".json"))
    out = []
    for n, p in found:
        if n > after:
            with system.open_input_stream(p) as f:
                out.append((n, json.loads(f.read())))
    return out


def add(spark, folder: str, number: int, entry: dict) -> None:
    """Write entry ``number``; raises if it exists."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(f"{folder}/{number:08d}.json")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    temporary = hadoop.Path(f"{folder}/.{uuid.uuid4().hex}.tmp")
    stream = system.create(temporary, False)
    stream.write(json.dumps(entry).encode())
    stream.close()
    if system.exists(target) or not system.rename(temporary, target):
        system.delete(temporary, False)
        raise FileExistsError(f"{target.toString()} was written by another writer")


def append(folder: str, entry: dict) -> None:
    """Write the next entry; two that are written at once both count."""
    system, path = locate(folder)
    system.create_dir(path, recursive=True)
    number = max((n for n, _ in entries(folder)), default=0) + 1
    name = uuid.uuid4().hex
    with system.open_output_stream(f"{path}/.{name}.tmp") as f:
        f.write(json.dumps(entry).encode())
    system.move(f"{path}/.{name}.tmp", f"{path}/{number:08d}-{name}.json")
