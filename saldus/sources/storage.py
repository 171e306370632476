"""Small files in whatever store Spark writes to: listing, leases and a create that only one of many writers gets."""

from __future__ import annotations

import os
import time
import uuid
from urllib.parse import unquote, urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Storage:
    """A folder through Hadoop's file systems, on the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self._jvm = spark, spark.sparkContext._jvm
        self._at = self._jvm.org.apache.hadoop.fs.Path
        at = self._at(path)
        self._fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.path = self._fs.makeQualified(at).toString().rstrip("/")
        self._local = urlsplit(self.path).scheme == "file"

    def at(self, name: str = "") -> str:
        return f"{self.path}/{name}" if name else self.path

    def names(self, folder: str) -> list[str]:
        return sorted(self.stats(folder))

    def stats(self, folder: str) -> dict[str, float]:
        """Names in a folder, and when each was last written, in seconds. None in a folder that isn't there."""
        try:
            return {x.getPath().getName(): x.getModificationTime() / 1000 for x in self._fs.listStatus(self._at(self.at(folder)))}
        except Py4JJavaError as e:
            if "FileNotFoundException" in str(e.java_exception):
                return {}
            raise

    def exists(self, name: str) -> bool:
        return bool(self._fs.exists(self._at(self.at(name))))

    def read(self, name: str) -> str | None:
        """A file's text; None if it isn't there."""
        try:
            stream = self._fs.open(self._at(self.at(name)))
        except Py4JJavaError as e:
            if "FileNotFoundException" in str(e.java_exception):
                return None
            raise
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Makes a file with all of its text, if nobody has made it yet; whether we have.

        Local files are linked into place and those of HDFS renamed, both of which fail on a name that is taken; a rename there moves a file beside one that
        appeared meanwhile into no folder, as files aren't folders. Object stores get a create without overwriting, whose content shows when it is closed.
        """
        if self.exists(name):
            return False
        self._fs.mkdirs(self._at(self.at(name)).getParent())
        aside = f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        if self._local:
            one, two = (unquote(urlsplit(self.at(x)).path) for x in (aside, name))
            with open(one, "w") as f:
                f.write(text)
                f.flush()
                os.fsync(f.fileno())
            try:
                os.link(one, two)
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(one)
        if urlsplit(self.path).scheme in ("hdfs", "viewfs"):
            self.write(aside, text.encode())
            done = bool(self._fs.rename(self._at(self.at(aside)), self._at(self.at(name))))
            if not done:
                self.delete(aside)
            return done
        try:
            self.write(name, text.encode())
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception):
                return False
            raise

    def write(self, name: str, data: bytes) -> None:
        """Makes a new file."""
        stream = self._fs.create(self._at(self.at(name)), False)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()

    def rename(self, name: str, to: str) -> bool:
        try:
            return bool(self._fs.rename(self._at(self.at(name)), self._at(self.at(to))))
        except Py4JJavaError:
            return False

    def touch(self, name: str) -> None:
        """Sets the time of last writing to now."""
        try:
            self._fs.setTimes(self._at(self.at(name)), int(time.time() * 1000), -1)
        except Py4JJavaError:
            pass  # it is gone, or the store keeps no times: a lease then lasts once

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(self.at(name)), True)
