"""Small files and folders of the driver: manifests and what lies beside them.

Spark has no public call to list, remove or exclusively create a file, so the session's
Hadoop file system is used, which also knows its credentials. Data never passes here.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        place = self._jvm.org.apache.hadoop.fs.Path(root)
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = place.getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """What lies in a folder; nothing where there is none."""
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))]

    def folders(self, path: str) -> dict[str, int]:
        """The folders in a folder with their sizes in bytes."""
        if not self.exists(path):
            return {}
        return {
            s.getPath().getName(): self._fs.getContentSummary(s.getPath()).getLength()
            for s in self._fs.listStatus(self._path(path))
            if s.isDirectory()
        }

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path))
        stream.write(bytearray(text.encode()))
        stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a new file, whole or not at all; False if there is one already.

        The text is written under another name and then given its own in one step that
        fails where the name is taken: a link on a local disk, a rename without overwriting
        elsewhere, which file systems with atomic renames, such as HDFS, settle for one
        writer only.
        """
        folder, name = path.rsplit("/", 1)
        draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
        self._write(draft, text)
        try:
            if self._fs.getScheme() == "file":
                local = [self._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath() for p in (draft, path)]
                try:
                    os.link(*local)
                except FileExistsError:
                    return False
                return True
            if self.exists(path):
                return False
            try:
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
                context.rename(self._path(draft), self._path(path))
            except Exception as error:
                if "FileAlreadyExists" in str(error):
                    return False
                raise
            return True
        finally:
            self.delete(draft)

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
