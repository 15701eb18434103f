"""File inventory with SHA-256 for provenance.

The driver only lists names (metadata); executors read and hash the files. Those below 128 MB go
through the ``binaryFile`` source, which holds one file per record; larger and empty ones, and
those whose names Spark's sources pass over (``_`` or ``.`` first), are streamed in chunks, at most 256 MB of a file in a task (``hash_large``).
"""

from __future__ import annotations

import re

from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.sources.sha256 import open_store, read_segment

MAX_BINARY_FILE = 1 << 27
#: most that the ``binaryFile`` source can hold in a record; for file systems that only Spark reads
MAX_RECORD = 1 << 31
#: bytes of a streamed file that one task reads
SEGMENT = 1 << 28


def list_files(spark: SparkSession, directory: str | None) -> list[tuple[str, int, int, bool]]:
    """(path, length, modification time in ms, marker) of all regular files below ``directory``,
    sorted; a missing folder -> []. Markers are Spark's own files: an empty ``_SUCCESS``, and the
    checksum ``.x.crc`` beside a file x."""
    if not directory:
        return []
    p = spark._jvm.org.apache.hadoop.fs.Path(directory)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p) or not fs.getFileStatus(p).isDirectory():
        return []
    if is_instance_of(spark.sparkContext._gateway, fs, "org.apache.hadoop.fs.ChecksumFileSystem"):
        fs = fs.getRawFileSystem()  # the other one hides checksum files
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        st = files.next()
        found.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    paths = {f[0] for f in found}

    def marker(path, size):
        folder, name = path.rsplit("/", 1)
        return name == "_SUCCESS" and size == 0 or name[0] == "." and name.endswith(".crc") and f"{folder}/{name[1:-4]}" in paths

    return sorted((*f, marker(f[0], f[1])) for f in found)


def file_inventory(spark: SparkSession, directory: str | None) -> DataFrame:
    """name (relative to ``directory``), mtime ("%Y-%m-%d %H:%M" in the session time zone), size_mb
    (1e6 bytes), sha256, marker (one of Spark's own files, see ``list_files``): one row per regular
    file in the folder or below it, sorted by name."""
    files = list_files(spark, directory)
    schema = "name string, mtime string, size_mb double, sha256 string, marker boolean"
    if not files:
        return spark.createDataFrame([], schema)
    root = spark._jvm.org.apache.hadoop.fs.Path(directory).toUri().getPath().rstrip("/")
    parts = []
    limit = MAX_BINARY_FILE if _streamable(files[0][0]) else MAX_RECORD
    plain = [0 < size < limit and path.rsplit("/", 1)[1][0] not in "_." for path, size, *_ in files]  # binaryFile leaves out the others
    small = [f[0] for f, p in zip(files, plain) if p]
    large = [f for f, p in zip(files, plain) if not p]
    if small:
        b = spark.read.format("binaryFile").load(small)
        parts.append(b.select("path", F.col("modificationTime").alias("at"), "length", F.sha2("content", 256).alias("sha256"), F.lit(False).alias("marker")))
    if large:
        parts.append(hash_large(spark, large))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.regexp_replace("path", "^.*?" + re.escape(root) + "/", "").alias("name"),
                      F.date_format("at", "yyyy-MM-dd HH:mm").alias("mtime"), (F.col("length") / 1e6).alias("size_mb"), "sha256", "marker").orderBy("name")


def _streamable(path: str) -> bool:
    try:
        open_store(path)
    except (ValueError, OSError, NotImplementedError):
        return False
    return True


def hash_large(spark: SparkSession, files: list[tuple[str, int, int, bool]], chunk: int = 1 << 20) -> DataFrame:
    """path, at, length, sha256, marker of files streamed in 1 MB chunks (the file systems of
    ``pyarrow.fs``: local, HDFS and object stores). In each round one task per unfinished file reads its next
    ``SEGMENT`` bytes and hands on the state of its hash, so rounds grow with the largest file and tasks do not."""
    from panelspark.session import ship_package

    ship_package(spark)
    segment, sums = SEGMENT, {}
    todo = [(path, size, 0, None) for path, size, *_ in files]
    while todo:
        read = spark.sparkContext.parallelize(todo, len(todo)).map(lambda f: (*f[:2], *read_segment(*f, segment, chunk))).collect()
        sums |= {path: digest for path, *_, digest in read if digest}
        todo = [(path, size, done, words) for path, size, done, words, digest in read if not digest]
    hashed = spark.createDataFrame([(*f, sums[f[0]]) for f in files], "path string, length long, ms long, marker boolean, sha256 string")
    return hashed.select("path", F.timestamp_millis("ms").alias("at"), "length", "sha256", "marker")
