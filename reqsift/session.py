"""Session settings, scratch space and directory listing."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Collection

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def build_session(app_name: str = "reqsift", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Streaming state on local disk and in checkpoints rather than on the heap.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder of ``spark.checkpoint.dir``.

    A machine-local folder is used only when the setting is absent and the session itself is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = _local_scratch()
    app = spark.sparkContext.applicationId
    path = _hadoop_path(spark, f"{root.rstrip('/')}/reqsift/{app}/{name}-{uuid.uuid4().hex}")
    return _file_system(spark, path).makeQualified(path).toString()


_scratch: list[str] = []


def _local_scratch() -> str:
    """One folder per process, removed when it ends."""
    if not _scratch:
        _scratch.append(tempfile.mkdtemp(prefix="reqsift-"))
        atexit.register(shutil.rmtree, _scratch[0], ignore_errors=True)
    return _scratch[0]


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, hadoop_path):
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """``(name, is_dir)`` of the direct children of one directory; empty when it does not exist.

    For directories with few children (days, state versions). Files are listed by Spark sources.
    """
    hadoop_path = _hadoop_path(spark, path)
    fs = _file_system(spark, hadoop_path)
    if not fs.exists(hadoop_path):
        return []
    return sorted((s.getPath().getName(), bool(s.isDirectory())) for s in fs.listStatus(hadoop_path))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and without a slash at the end, as Spark reports the files below it."""
    hadoop_path = _hadoop_path(spark, path)
    return _file_system(spark, hadoop_path).makeQualified(hadoop_path).toString()


def is_directory(spark: SparkSession, path: str) -> bool:
    hadoop_path = _hadoop_path(spark, path)
    fs = _file_system(spark, hadoop_path)
    return bool(fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isDirectory())


def age_files(spark: SparkSession, path: str, days: int, but: Collection[str] = ()) -> None:
    """Set the time stamps of the data files directly in ``path``, ``but`` for those of these names, back by ``days``; for
    queries that show what late files do."""
    hadoop_path = _hadoop_path(spark, path)
    fs = _file_system(spark, hadoop_path)
    data = [s for s in fs.listStatus(hadoop_path) if s.isFile() and s.getPath().getName().startswith("part-")]
    for status in (s for s in data if s.getPath().getName() not in but):
        fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path = _hadoop_path(spark, path)
    _file_system(spark, hadoop_path).delete(hadoop_path, True)


def committed_below(spark: SparkSession, path: str, levels: int) -> list[str]:
    """Paths below ``path``, ``levels`` directories deep and relative to it, into which a Spark write finished: one listing."""
    root = _hadoop_path(spark, path)
    fs = _file_system(spark, root)
    found = fs.globStatus(_hadoop_path(spark, path + "/*" * levels + "/_SUCCESS")) or []
    below = len(fs.makeQualified(root).toString()) + 1
    return sorted(s.getPath().getParent().toString()[below:] for s in found)


def committed(spark: SparkSession, path: str) -> bool:
    """True when a Spark write into ``path`` finished."""
    hadoop_path = _hadoop_path(spark, f"{path}/_SUCCESS")
    return bool(_file_system(spark, hadoop_path).exists(hadoop_path))


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = _hadoop_path(spark, path)
    return bool(_file_system(spark, hadoop_path).exists(hadoop_path))


def put_mark(spark: SparkSession, path: str) -> None:
    """An empty file; putting it again changes nothing."""
    hadoop_path = _hadoop_path(spark, path)
    _file_system(spark, hadoop_path).create(hadoop_path, True).close()


def read_text(spark: SparkSession, path: str) -> str:
    """The content of one small file."""
    hadoop_path = _hadoop_path(spark, path)
    stream = _file_system(spark, hadoop_path).open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """A small file with ``text``, whole at once; False, and no change, where ``path`` is there already.

    Writers may race: one of them wins. It is written beside its place first, and takes it by a link on a local disk and
    by a rename elsewhere, which stores such as HDFS refuse when the place is taken.
    """
    target = _hadoop_path(spark, path)
    fs = _file_system(spark, target)
    if fs.exists(target):
        return False
    aside = _hadoop_path(spark, f"{target.getParent().toString()}/_{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.getScheme() != "file":
        won = bool(fs.rename(aside, target))
    else:
        files = spark.sparkContext._jvm.java.nio.file
        try:
            local = [files.Path.of(p.toUri().getPath(), spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.String, 0)) for p in (target, aside)]
            files.Files.createLink(*local)
            won = True
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception):
                raise
            won = False
    fs.delete(aside, False)
    return won
