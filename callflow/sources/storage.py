"""Files of Spark's paths through Arrow, for tasks that list folders or read the start of a file."""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession

_GLOB = re.compile(r"[{}\[\]*?\\]")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as Spark's readers name it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


@cache
def _system(scheme: str, authority: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(f"{scheme}://{authority}/")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a qualified path, and the path in it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority, _, inner = rest.lstrip("/").partition("/")
    system, base = _system("s3" if scheme in ("s3a", "s3n") else scheme, authority)
    base = base.strip("/")
    return system, f"{base}/{inner}" if base else f"/{inner}"


def reachable(path: str) -> bool:
    """Whether Arrow knows the scheme of a qualified path; globs are left to Spark's readers."""
    if _GLOB.search(path):
        return False
    try:
        opened(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def literal(path: str) -> str:
    """``path`` for a Spark reader that takes it as a glob."""
    return _GLOB.sub(r"\\\g<0>", path)


def is_hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)
