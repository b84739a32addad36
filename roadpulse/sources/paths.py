"""Folders of any file system Spark reaches: names, ages, small texts, moves. All calls are the driver's."""

import uuid

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _at(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _fs(self):
        return self._at().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def child(self, name: str) -> "Folder":
        return Folder(self.spark, f"{self.path}/{name}")

    def exists(self, name: str = "") -> bool:
        return self._fs().exists(self._at(name))

    def names(self) -> list[str]:
        """What lies in the folder, sorted; nothing if there is no such folder."""
        return sorted(self.modified())

    def modified(self) -> dict[str, int]:
        """Time of the last change of what lies in the folder, in milliseconds since 1970."""
        if not self.exists():
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self._fs().listStatus(self._at())}

    def read(self, name: str) -> str:
        stream = self._fs().open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """A small text that is there as a whole or not at all; one of that name is replaced."""
        fs, draft = self._fs(), self._at(f".{name}.{uuid.uuid4().hex}")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not fs.rename(draft, self._at(name)):  # not all file systems rename onto a file
            fs.delete(self._at(name), False)
            if not fs.rename(draft, self._at(name)):
                raise OSError(f"cannot write {self.path}/{name}")

    def move(self, name: str, to: "Folder", new_name: str) -> None:
        fs = self._fs()
        fs.mkdirs(to._at())
        if not fs.rename(self._at(name), to._at(new_name)):
            raise OSError(f"cannot move {self.path}/{name} to {to.path}/{new_name}")

    def make(self) -> None:
        self._fs().mkdirs(self._at())

    def delete(self, name: str) -> None:
        self._fs().delete(self._at(name), True)
