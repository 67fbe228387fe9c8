"""Small files and folders through Spark's Hadoop file systems, whatever store they lie in."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: bytes that cross between Python and the JVM at once
SLICE = 1 << 20


class Files:
    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def delete(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.delete(p, True)

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        try:
            return [s.getPath().getName() for s in fs.listStatus(p)]
        except Py4JJavaError as e:
            if "FileNotFoundException" in e.java_exception.getClass().getName():
                return []
            raise

    def _text(self, path: str) -> str | None:
        fs, p = self._fs(path)
        try:
            stream = fs.open(p)
        except Py4JJavaError as e:
            if "FileNotFoundException" in e.java_exception.getClass().getName():
                return None
            raise
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _count(self, path: str) -> int:
        """Files below a folder."""
        fs, p = self._fs(path)
        return fs.getContentSummary(p).getFileCount()

    def _lines(self, path: str) -> Iterator[str] | None:
        """The lines of a text file, which crosses over to Python in slices; None if there is no such file."""
        fs, p = self._fs(path)
        try:
            stream = fs.open(p)
        except Py4JJavaError as e:
            if "FileNotFoundException" in e.java_exception.getClass().getName():
                return None
            raise

        def read() -> Iterator[str]:
            rest = b""
            try:
                while piece := bytes(stream.readNBytes(SLICE)):
                    *whole, rest = (rest + piece).split(b"\n")
                    yield from (line.decode() for line in whole)
                if rest:
                    yield rest.decode()
            finally:
                stream.close()

        return read()

    def _put(self, path: str, text: str | Iterable[str]) -> bool:
        """Write a file whole under its name, in one step, if the name is free; tells whether it was. A text in pieces crosses over in slices."""
        folder, name = path.rsplit("/", 1)
        spare = f"{folder}/.{name}-{uuid.uuid4().hex}"
        fs, p = self._fs(spare)
        out = fs.create(p, True)
        try:
            held = bytearray()
            for piece in [text] if isinstance(text, str) else text:
                held += piece.encode()
                if len(held) >= SLICE:
                    out.write(held)
                    held = bytearray()
            out.write(held)
        finally:
            out.close()
        try:
            if fs.getScheme() == "file":  # whose rename replaces a file of that name
                os.link(p.toUri().getPath(), self._fs(path)[1].toUri().getPath())
            else:
                jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
                how = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
                one = gateway.new_array(how, 1)
                one[0] = how.NONE
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(p, self._fs(path)[1], one)
        except FileExistsError:
            return False
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise
        finally:
            self.delete(spare)
        return True
