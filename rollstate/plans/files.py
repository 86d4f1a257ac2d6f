"""Files of a shared file system (local, HDFS or object store alike), by Hadoop's own interface."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def filesystem(spark: SparkSession, path: str):
    """FileSystem handle and Path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is absent."""
    fs, p = filesystem(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def sizes(spark: SparkSession, path: str, pattern: str) -> dict[str, int]:
    """Bytes of the files below ``path`` that match a glob pattern, by path below it."""
    fs, p = filesystem(spark, path)
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, pattern)) or []
    depth = pattern.count("/") + 1
    return {"/".join(st.getPath().toString().rsplit("/", depth)[1:]): st.getLen() for st in found}


def modified(spark: SparkSession, path: str) -> float:
    """Time of the last change, in seconds."""
    fs, p = filesystem(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def delete(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def read_json(spark: SparkSession, path: str) -> dict | None:
    """Content of a file; None if it is absent."""
    fs, p = filesystem(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def create_json(spark: SparkSession, path: str, content: dict) -> bool:
    """Creates a file in one step; False if there is one already, which stays as it is.

    The content is written to a draft that is then renamed without overwriting: of two writers at
    once one succeeds, and no reader sees half a file.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = path.rsplit("/", 1)[0]
    fs, draft = filesystem(spark, f"{folder}/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(draft).toUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    try:
        context.rename(fs.makeQualified(draft), target, options)
        return True
    except Exception:
        if not fs.exists(target):
            raise
        return False
    finally:
        delete(spark, draft.toString())
