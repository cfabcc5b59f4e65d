"""Manifests: small files that say which folders make up a version of a table.

A version counts once its manifest is there; it is written last and put in place by a rename. Folders that no manifest
names are leftovers of a failed write. There is one writer per table.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from typing import Any, Iterator

from pyspark.sql import SparkSession

_SUFFIX = ".json"


def filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def drop_folder(spark: SparkSession, folder: str) -> None:
    fs, path = filesystem(spark, folder)
    fs.delete(path, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in ``folder``, in order; nothing if there is no such folder."""
    fs, path = filesystem(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(path))


def folder_bytes(spark: SparkSession, folder: str) -> int:
    fs, path = filesystem(spark, folder)
    return fs.getContentSummary(path).getLength() if fs.exists(path) else 0


def write_json(spark: SparkSession, path: str, content: Any) -> None:
    """Put a file in place whole or not at all. One that is there already is an error: two writers."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    fs, temporary = filesystem(spark, part)
    stream = fs.create(temporary)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if fs.exists(target) or not fs.rename(temporary, target):
        fs.delete(temporary, False)
        raise FileExistsError(f"{path} was written by another writer")


def read_json(spark: SparkSession, path: str) -> Any:
    fs, target = filesystem(spark, path)
    stream = fs.open(target)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()


@dataclass(frozen=True)
class Manifests:
    """The manifests of one table, numbered from 0."""

    spark: SparkSession
    path: str

    def _file(self, number: int) -> str:
        return f"{self.path}/{number:012d}{_SUFFIX}"

    def numbers(self) -> list[int]:
        found = names(self.spark, self.path)
        return [int(name.removesuffix(_SUFFIX)) for name in found if name.endswith(_SUFFIX)]

    def read(self, number: int) -> dict:
        return read_json(self.spark, self._file(number))

    def newest(self) -> tuple[int, dict | None]:
        """Number and content of the newest manifest; -1 and None before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (-1, None)

    def commit(self, number: int, content: dict) -> None:
        write_json(self.spark, self._file(number), {**content, "at": time.time()})

    def drop(self, number: int) -> None:
        drop_folder(self.spark, self._file(number))


@dataclass(frozen=True)
class Leases:
    """Readers that want their files to stay. A lease ends when it is given back or its time is over."""

    spark: SparkSession
    path: str

    def take(self, number: int, seconds: float) -> str:
        name = uuid.uuid4().hex
        write_json(self.spark, f"{self.path}/{name}{_SUFFIX}", {"number": number, "until": time.time() + seconds})
        return name

    def give_back(self, name: str) -> None:
        drop_folder(self.spark, f"{self.path}/{name}{_SUFFIX}")

    def held(self) -> Iterator[int]:
        """Numbers of the manifests that readers hold; leases whose time is over are removed."""
        for name in names(self.spark, self.path):
            if not name.endswith(_SUFFIX):
                continue
            try:
                lease = read_json(self.spark, f"{self.path}/{name}")
            except Exception as error:  # given back meanwhile
                if "FileNotFound" in str(error):
                    continue
                raise
            if lease["until"] > time.time():
                yield lease["number"]
            else:
                drop_folder(self.spark, f"{self.path}/{name}")
