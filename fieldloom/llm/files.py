"""Files that tasks write and read themselves, by paths that name their file system."""

from __future__ import annotations

import re

import pyarrow.fs


def _at(path: str):
    # Hadoop writes file:/x, which others read as file:///x
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/(?=[^/])", "file:///", path))


def open_write(path: str):
    fs, at = _at(path)
    fs.create_dir(at.rpartition("/")[0], recursive=True)
    return fs.open_output_stream(at)


def open_read(path: str):
    fs, at = _at(path)
    return fs.open_input_file(at)
