"""Numbered records in a folder; a number can be taken once."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_DIGITS = 20


class Conflict(Exception):
    """Another writer has taken the number since the last record was read."""


class Records:
    """Small texts ``<number>.json`` below ``folder``, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        files, path = self._files(), self._path()
        names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
        return sorted(int(n[:_DIGITS]) for n in names if n.endswith(".json"))

    def read(self, number: int) -> str:
        opened = self._files().open(self._path(f"{number:0{_DIGITS}}.json"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
        finally:
            opened.close()

    def put(self, number: int, text: str) -> None:
        """A whole record or none; ``Conflict`` if the number is taken."""
        jvm, files = self.spark._jvm, self._files()
        draft = self._path(f"draft-{uuid.uuid4().hex}")
        out = files.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path().toUri(), self.spark._jsc.hadoopConfiguration()
        )
        no_options = self.spark.sparkContext._gateway.new_array(
            getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0
        )
        try:
            # Refuses a name that is taken.
            context.rename(
                files.makeQualified(draft), files.makeQualified(self._path(f"{number:0{_DIGITS}}.json")), no_options
            )
        except Py4JJavaError as error:
            files.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise Conflict(f"record {number} of {self.folder} was made by another writer") from None
            raise

    def delete(self, number: int) -> None:
        self._files().delete(self._path(f"{number:0{_DIGITS}}.json"), False)
