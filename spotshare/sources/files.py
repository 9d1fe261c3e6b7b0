"""Files and folders through Spark's own file systems, from the driver; any path that Spark reads will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def of_uri(spark: SparkSession, uri: str) -> str:
    """The path of a file named by its URI, as Spark's file metadata does."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, system = _at(spark, path)
    return system.exists(hadoop)


def listed(spark: SparkSession, folder: str) -> list[str]:
    """All files below ``folder`` whose names, and those of their folders below it, start with neither ``_`` nor ``.``; rising."""
    hadoop, system = _at(spark, folder)
    if not system.exists(hadoop):
        return []
    root, found = system.makeQualified(hadoop).toString().rstrip("/"), []
    files = system.listFiles(hadoop, True)
    while files.hasNext():
        path = files.next().getPath().toString()
        if not any(part.startswith(("_", ".")) for part in path[len(root) + 1 :].split("/")):
            found.append(path)
    return sorted(found)


def below(spark: SparkSession, folder: str, path: str) -> str:
    """``path`` relative to ``folder``."""
    hadoop, system = _at(spark, folder)
    return path[len(system.makeQualified(hadoop).toString().rstrip("/")) + 1 :]


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or a whole folder, if it is there."""
    hadoop, system = _at(spark, path)
    system.delete(hadoop, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file; what ``target`` held is replaced."""
    (old, system), (new, _) = _at(spark, source), _at(spark, target)
    system.mkdirs(new.getParent())
    if system.exists(new):
        system.delete(new, False)
    if not system.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a new small file; fails if it is there already."""
    hadoop, system = _at(spark, path)
    out = system.create(hadoop, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def text_of(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    hadoop, system = _at(spark, path)
    if not system.exists(hadoop):
        return None
    stream = system.open(hadoop)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
