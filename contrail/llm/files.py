"""Files in the shared folder, opened by tasks through pyarrow's filesystems.

A task writes under a name that no other attempt uses and reports the name in
its result row; the result table, which Spark commits, names the files that
count.  Files of lost or speculative attempts are never read.
"""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def locate(uri: str):
    """(filesystem, path) of a Hadoop-style URI or a plain path."""
    if uri.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def open_out(uri: str):
    fs, path = locate(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(path, compression=None)  # not by the file ending


def open_in(uri: str):
    fs, path = locate(uri)
    return fs.open_input_file(path)


def attempt_name(folder: str, pid: int, ending: str) -> str:
    return f"{folder}/part-{pid:06d}-{uuid.uuid4().hex}{ending}"
