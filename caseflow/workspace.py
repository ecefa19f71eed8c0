"""Where derived tables are written: the shared folder the cluster names."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_roots: dict[str, str] = {}


def workspace(spark: SparkSession) -> str:
    """Folder of this application under ``spark.checkpoint.dir``.

    Derived tables outlive executors, so they must be on storage every node sees. Only a
    local master may run without the setting; it then gets a temporary folder of its own.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all nodes")
            root = tempfile.mkdtemp(prefix="caseflow-")
            atexit.register(shutil.rmtree, root, ignore_errors=True)
        _roots[app] = f"{root.rstrip('/')}/caseflow/{app}-{uuid.uuid4().hex[:8]}"
    return _roots[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder path in the workspace."""
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, path)`` for metadata calls on any storage Spark can read."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath
