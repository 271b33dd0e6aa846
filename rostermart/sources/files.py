"""Small text files on whatever file system Spark writes to, by its own client."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """List, read, write, create and rename below any path that Spark can open.

    ``create`` and ``publish`` never replace a file. On HDFS and the stores with
    conditional writes behind their Hadoop client only one caller can succeed; on
    a plain local disk the check and the write are two steps.
    """

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        """The names in a folder, sorted; none where there is no such folder."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(n for n in (f.getPath().getName() for f in self._fs.listStatus(path)) if not n.startswith("."))

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def age_ms(self, path: str, now_ms: int) -> int:
        return now_ms - self._fs.getFileStatus(self._path(path)).getModificationTime()

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Write or replace."""
        self._put(self._fs.create(self._path(path), True), text)

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False where the path is taken."""
        try:
            stream = self._fs.create(self._path(path), False)
        except Exception as error:
            if "already exists" in str(error).lower() or "FileAlreadyExists" in str(error):
                return False
            raise
        self._put(stream, text)
        return True

    def publish(self, path: str, text: str) -> bool:
        """Make ``path`` appear with all of its text or not at all; False where it is taken."""
        hidden = path.rsplit("/", 1)
        hidden = f"{hidden[0]}/.{hidden[1]}.{self._jvm.java.util.UUID.randomUUID()}"
        self.write(hidden, text)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self._jvm.java.lang.reflect.Array.newInstance(self._jvm.java.lang.Class.forName(
            "org.apache.hadoop.fs.Options$Rename", True, self._jvm.java.lang.Thread.currentThread().getContextClassLoader()), 1)
        how[0] = rename.valueOf("NONE")
        try:
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
            context.rename(self._fs.makeQualified(self._path(hidden)), self._fs.makeQualified(self._path(path)), how)
        except Exception as error:
            self._fs.delete(self._path(hidden), False)
            if "already exists" in str(error).lower() or "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    @staticmethod
    def _put(stream, text: str) -> None:
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
