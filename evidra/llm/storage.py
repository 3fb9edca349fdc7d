"""Folders of files that tasks write, made visible by manifests.

Storage goes through pyarrow file systems (local, HDFS, object stores).  Tasks write files of unique names; a commit adds a
manifest of what succeeded tasks wrote, so files left by lost or repeated tasks are never read.
"""

from __future__ import annotations

import json
import re
import uuid

#: A commit writes one of these; readers take the files of all that no other one replaces.
MANIFEST = re.compile(r"_manifest-[0-9a-f]{32}\.json")


def file_system(path: str):
    """The file system of a path or URI, and the folder in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def manifests(system, folder: str) -> dict[str, list]:
    """The valid manifests of a folder by name, with what each lists."""
    from pyarrow import fs

    told = {}
    for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if MANIFEST.fullmatch(info.base_name):
            with system.open_input_file(info.path) as file:
                told[info.base_name] = json.loads(file.read())
    gone = {name for x in told.values() for name in x["replaces"]}
    return {name: x["files"] for name, x in told.items() if name not in gone}


def publish(system, folder: str, files: list, replaces: dict) -> None:
    """One new manifest makes all files visible and the manifests that it replaces void."""
    name = f"{folder}/_manifest-{uuid.uuid4().hex}.json"
    with system.open_output_stream(f"{name}.new", compression=None) as out:
        out.write(json.dumps({"files": files, "replaces": sorted(replaces)}).encode())
    system.move(f"{name}.new", name)
