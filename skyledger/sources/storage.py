"""Small metadata files and listings on whatever file system a path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Storage:
    """File-system access through Spark's own Hadoop configuration."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _open(self, location: str):
        path = self._jvm.org.apache.hadoop.fs.Path(location)
        return path, path.getFileSystem(self._conf)

    def names(self, directory: str) -> list[str]:
        """Names of the entries of a directory, none if it does not exist."""
        path, fs = self._open(directory)
        if not fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(path))

    def files(self, location: str, suffix: str = "") -> list[str]:
        """Paths of the visible files at a file, directory or glob, in ``key=value`` folders too."""
        path, fs = self._open(location)
        found = []
        waiting = [(status, True) for status in fs.globStatus(path) or []]
        while waiting:
            status, top = waiting.pop()
            name = status.getPath().getName()
            if not top and (name.startswith(".") or (name.startswith("_") and "=" not in name)):
                continue
            if status.isDirectory():
                if top or "=" in name:
                    waiting += [(item, False) for item in fs.listStatus(status.getPath())]
            elif name.endswith(suffix):
                found.append(status.getPath().toString())
        return sorted(found)

    def first_line(self, location: str) -> str | None:
        """The first line of a text file that is not blank, decompressed if its name says so;
        None if there is none."""
        path, fs = self._open(location)
        stream = fs.open(path)
        try:
            codec = self._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
                self._conf
            ).getCodec(path)
            content = codec.createInputStream(stream) if codec else stream
            reader = self._jvm.java.io.BufferedReader(
                self._jvm.java.io.InputStreamReader(content, "UTF-8")
            )
            line = reader.readLine()
            while line is not None and not line.strip().removeprefix("\ufeff"):
                line = reader.readLine()
            return line
        finally:
            stream.close()

    def read(self, location: str) -> str:
        path, fs = self._open(location)
        stream = fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, location: str, text: str) -> None:
        """Write a new file; fails if it exists."""
        path, fs = self._open(location)
        stream = fs.create(path, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def remove(self, directory: str) -> None:
        """Delete a directory and what is in it, if it exists."""
        path, fs = self._open(directory)
        fs.delete(path, True)
