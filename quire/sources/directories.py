"""Directories of a BIDS tree as rows, listed on the executors.

A task reads the names in the root as a stream, keeps those of its share (a
hash of the name) and lists each kept subject's directory, so subjects are
listed side by side and no task holds more than one directory's names.  Roots
are paths or URIs of file systems that Arrow knows (``file``, ``hdfs``, ``s3``, ``gs``).
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Share(InputPartition):
    def __init__(self, number: int):
        self.number = number


def directory_names(root: str, prefix: str) -> Iterator[str]:
    """Names of the directories in ``root`` that start with ``prefix``; links count as what they lead to."""
    if "://" not in root or root.startswith("file:"):
        with os.scandir(root.removeprefix("file://") if root.startswith("file://") else root.removeprefix("file:")) as found:
            for entry in found:
                if entry.name.startswith(prefix) and entry.is_dir():
                    yield entry.name
        return
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(root)
    for info in system.get_file_info(fs.FileSelector(path)):
        if info.type == fs.FileType.Directory and info.base_name.startswith(prefix):
            yield info.base_name


class DirectoryReader(DataSourceReader):
    def __init__(self, root: str, parts: int):
        self.root, self.parts = root.rstrip("/"), parts

    def partitions(self) -> list[InputPartition]:
        return [Share(i) for i in range(self.parts)]

    def read(self, partition: Share) -> Iterator[tuple[str, str]]:
        for subject in directory_names(self.root, "sub-"):
            if zlib.crc32(subject.encode()) % self.parts != partition.number:
                continue
            alone = True
            for session in directory_names(f"{self.root}/{subject}", "ses-"):
                alone = False
                yield subject, session[len("ses-"):]
            if alone:
                yield subject, "1"


class DirectorySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quire_directories"

    def schema(self) -> str:
        return "subject_id string, session_id string"

    def reader(self, schema) -> DirectoryReader:
        return DirectoryReader(self.options["root"], int(self.options.get("parts", "32")))
