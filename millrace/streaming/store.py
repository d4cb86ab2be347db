"""Small files in whatever store Spark writes to, and the scratch folder that a deployment shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir`` (session or context); only on a local master without one, one of our own."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _own:
            _own[context.applicationId] = f"file://{tempfile.mkdtemp(prefix='millrace-')}"
        root = _own[context.applicationId]
    return root.rstrip("/")


class Files:
    """Text files and folders of a store, through Spark's own file systems."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        found = self.jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.conf), found

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def size(self, path: str) -> int:
        """Bytes of all files under a path."""
        fs, at = self._at(path)
        return fs.getContentSummary(at).getLength() if fs.exists(at) else 0

    def names(self, folder: str) -> list[str]:
        fs, at = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def write(self, path: str, text: str) -> None:
        """Write aside and rename, so that a file is there whole or not at all."""
        fs, at = self._at(path)
        aside = self.jvm.org.apache.hadoop.fs.Path(at.getParent(), "_" + at.getName())
        out = fs.create(aside, True)
        out.write(bytearray(text.encode()))
        out.close()
        fs.delete(at, False)
        if not fs.rename(aside, at):
            raise OSError(f"could not rename to {path}")

    def read(self, path: str) -> str:
        fs, at = self._at(path)
        stream = fs.open(at)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)
