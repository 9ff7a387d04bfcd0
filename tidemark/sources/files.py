"""Small files on whatever file system Spark can reach, through Hadoop's own interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Text files and folders under a path, which may be a URI."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._jvm, self._gateway, self._conf = context._jvm, context._gateway, context._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def read(self, path: str) -> str | None:
        """A file's text, None where there is none."""
        if not self._fs.exists(self._path(path)):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Put a text there in one step: written beside it, forced to disk, then renamed over what was there."""
        fs = self._jvm.org.apache.hadoop.fs
        beside, target = self._path(f"{path}.tmp"), self._path(path)
        stream = self._fs.create(beside, True)
        try:
            stream.write(bytearray(text.encode()))
            stream.hsync()
        finally:
            stream.close()
        over = self._gateway.new_array(fs.Options.Rename, 1)
        over[0] = fs.Options.Rename.OVERWRITE
        fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(beside, target, over)

    def matching(self, pattern: str) -> list[str]:
        return [s.getPath().toString() for s in self._fs.globStatus(self._path(pattern)) or []]

    def size(self, folder: str) -> int:
        return self._fs.getContentSummary(self._path(folder)).getLength()

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
