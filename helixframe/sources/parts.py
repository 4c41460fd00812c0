"""What data sources written in Python share: paths, and part files that show only when all tasks are done."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    path = path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:") if path.startswith("file:/") else path
    return (pafs.LocalFileSystem(), path) if "://" not in path else pafs.FileSystem.from_uri(path)


def is_file(fs: pafs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type == pafs.FileType.File


def listed(paths: Sequence[str], *ends: str) -> list[str]:
    """Files of paths, folders among them: of those the files with such an ending."""

    def files(path: str) -> list[str]:
        fs, inner = open_path(path)
        if fs.get_file_info(inner).type != pafs.FileType.Directory:
            return [path]
        root = path.removesuffix("/")
        return sorted(f"{root}/{f.base_name}" for f in fs.get_file_info(pafs.FileSelector(inner)) if f.base_name.endswith(ends) and not f.base_name.startswith(("_", ".")))

    with ThreadPoolExecutor(16) as pool:
        return [f for some in pool.map(files, paths) for f in some]


def globbed(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int]]:
    """Paths and sizes of the files of paths, globs and folders, as Hadoop's file systems list them, empty ones too."""
    jvm, conf, found = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        fs = place.getFileSystem(conf)
        for status in fs.globStatus(place) or []:
            for f in fs.listStatus(status.getPath()) if status.isDirectory() else [status]:
                if not f.isDirectory() and not f.getPath().getName().startswith(("_", ".")):
                    found.append((f.getPath().toString(), f.getLen()))
    return found


class Window:
    """A file read by place, so many bytes at a time."""

    def __init__(self, file, size: int = 1 << 20):
        self.file, self.most, self.size, self.at, self.held = file, size, file.size(), 0, b""

    def bytes_at(self, place: int, n: int) -> bytes:
        """n bytes from a place on, fewer at the end of the file."""
        if not self.at <= place <= place + n <= self.at + len(self.held):
            self.at, self.held = place, self.file.read_at(max(n, self.most), place)
        return self.held[place - self.at : place - self.at + n]


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class PartWriter(DataSourceArrowWriter):
    """Each task writes its files under names that begin with a mark; they lose it when all tasks are done."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def part(self, ending: str) -> str:
        """A name for a file of this task."""
        fs, inner = open_path(self.path)
        fs.create_dir(inner, recursive=True)
        return f"part-{uuid.uuid4().hex}{ending}"

    def opened(self, name: str):
        fs, inner = open_path(self.path)
        return fs.open_output_stream(f"{inner}/_{name}", compression=None)

    def commit(self, messages: list[Written | None]) -> None:
        fs, inner = open_path(self.path)
        fs.create_dir(inner, recursive=True)
        names = [n for m in messages if m for n in m.names]
        if self.overwrite:
            for f in fs.get_file_info(pafs.FileSelector(inner)):
                if f.base_name.removeprefix("_") not in names:
                    fs.delete_file(f.path)
        for name in names:
            fs.move(f"{inner}/_{name}", f"{inner}/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, inner = open_path(self.path)
        for name in [n for m in messages if m for n in m.names]:
            if is_file(fs, f"{inner}/_{name}"):
                fs.delete_file(f"{inner}/_{name}")
