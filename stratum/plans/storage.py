"""Small file-system calls through Hadoop's FileSystem API.

The same calls work for local paths, HDFS and object stores, so nothing
here assumes a machine-local folder.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (empty if absent)."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    held = fs.listStatus(p)
    if not len(held):
        return []
    # one answer for all entries, not a call for each: {folder/a,folder/b}
    text = spark.sparkContext._jvm.org.apache.commons.lang3.ArrayUtils.toString(spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(held))
    folder = held[0].getPath().getParent().toString().rstrip("/") + "/"
    return text[1:-1].removeprefix(folder).split(f",{folder}")


def fingerprint(spark: SparkSession, folder: str) -> tuple:
    """(name, size, modification time) of what lies under ``folder``, down to the files of a table's folder."""
    p, fs = _fs(spark, folder)
    out = []
    for st in fs.listStatus(p):
        inner = fs.listStatus(st.getPath()) if st.isDirectory() else [st]
        out += [(st.getPath().getName(), f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in inner]
    return tuple(sorted(out))


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or folder, if it is there."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def create_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Create a file; fails if it already exists (an atomic claim)."""
    p, fs = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    create_bytes(spark, path, text.encode())


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def set_mtimes_in_name_order(spark: SparkSession, folder: str, suffix: str, start_ms: int) -> int:
    """Give the files under ``folder`` ending in ``suffix`` increasing
    modification times in name order (one second apart)."""
    p, fs = _fs(spark, folder)
    files = sorted((st.getPath() for st in fs.listStatus(p) if st.getPath().getName().endswith(suffix)),
                   key=lambda q: q.getName())
    for i, f in enumerate(files):
        fs.setTimes(f, start_ms + 1000 * i, -1)
    return len(files)
