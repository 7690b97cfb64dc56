"""Plain files in the folder that driver and executors share.

Tasks write files of unique names and return their paths as rows; only paths
of successful attempts reach the manifest, so a file left by a lost executor
or a second attempt is never read. Names need no renaming, which suits object
stores.
"""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from surgecast.session import checkpoint_dir


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def unique_name(folder: str, suffix: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a Hadoop-style URI."""
    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def create(path: str):
    """Output stream of a new file."""
    system, inner = locate(path)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    return system.open_output_stream(inner, compression=None)  # not by the suffix


def open_for_seek(path: str):
    """Random-access file."""
    system, inner = locate(path)
    return system.open_input_file(inner)
