"""File-system access used inside tasks (listing, reading, copying).

``pyarrow.fs`` gives one interface for local and mounted paths and for the
schemes pyarrow was built with (HDFS, S3, GCS).  Spark-style ``file:/x``
URIs map to the local file system.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow.fs as pafs


@lru_cache(maxsize=64)
def _fs_for_scheme(authority_uri: str):
    fs, _ = pafs.FileSystem.from_uri(authority_uri)
    return fs


def filesystem_for(uri: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path on it) for a path or URI; cached per task process."""
    if uri.startswith("file:"):
        rest = uri[len("file:"):]
        path = "/" + rest.lstrip("/")
        return _local(), path
    if "://" not in uri:
        return _local(), uri
    scheme, rest = uri.split("://", 1)
    authority, _, path = rest.partition("/")
    fs = _fs_for_scheme(f"{scheme}://{authority}/")
    if isinstance(fs, pafs.S3FileSystem) or scheme in ("gs", "gcs"):
        return fs, f"{authority}/{path}"
    return fs, "/" + path


@lru_cache(maxsize=1)
def _local() -> pafs.LocalFileSystem:
    return pafs.LocalFileSystem()


def is_local(uri: str) -> bool:
    """True for plain paths and ``file:`` URIs."""
    return uri.startswith("file:") or "://" not in uri


def qualify(path: str, spark=None) -> str:
    """Absolute form of a path given on the driver.

    A path without a scheme belongs to the cluster's default file system
    (``fs.defaultFS``): local paths become absolute, a path on another default
    gets its scheme and authority and must be absolute.  ``scheme:/path`` gets
    the authority of a default of that scheme, and raises without one.  Full
    URIs and ``file:`` paths are kept.
    """
    import os
    from urllib.parse import urlparse

    if "://" in path or path.startswith("file:"):
        return path
    default = "file:///"
    if spark is not None:
        default = spark._jsc.hadoopConfiguration().get("fs.defaultFS") or default
    base, scheme = urlparse(default), urlparse(path).scheme
    if scheme:
        if base.scheme != scheme:
            raise ValueError(f"{path}: no authority given, and the default file system is {default}")
        return f"{base.scheme}://{base.netloc}{path[len(scheme) + 1:]}"
    if base.scheme in ("", "file"):
        return os.path.abspath(path)
    if not path.startswith("/"):
        raise ValueError(f"{path}: relative path on {default}")
    return f"{base.scheme}://{base.netloc}{path}"


def path_exists(spark, path: str) -> bool:
    """Whether a path given on the driver is there, by the file system Spark
    itself reads it from (``fs.defaultFS`` for a path without a scheme)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
