"""Hashes of files of any size, as a data source whose partitions are files."""

from __future__ import annotations

import fnmatch
import hashlib
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, relative_path string, filename string, size_bytes long, sha256 string"
#: bytes that a task holds of a file at a time
BLOCK = 8 << 20
#: small files that one partition takes together, up to as many bytes
PACK = 64 << 20


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it, of a plain path or a URI (local, HDFS, S3, GCS)."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


class Files(InputPartition):
    def __init__(self, files: list[tuple[str, str, int]]):
        self.files = files


class HashReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.pattern = options.get("pattern", "*")
        self.block = int(options.get("blockBytes", BLOCK))
        self.hashed = options.get("hash", "true").lower() == "true"

    def partitions(self) -> list[Files]:
        """The files by name; a file beyond ``PACK`` bytes is a partition of its own. Only names and sizes are listed here."""
        system, root = opened(self.root)
        info = system.get_file_info(fs.FileSelector(root, recursive=True)) if system.get_file_info(root).type == fs.FileType.Directory else [system.get_file_info(root)]
        found = sorted((i.path, i.size) for i in info if i.type == fs.FileType.File and fnmatch.fnmatch(i.base_name, self.pattern))
        packs, held = [], 0
        for path, size in found:
            if not packs or held + size > PACK:
                packs.append([])
                held = 0
            packs[-1].append((path, path[len(root):].lstrip("/") or path.rsplit("/", 1)[-1], size))
            held += size
        return [Files(p) for p in packs] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        system, _ = opened(self.root)
        for path, relative, size in partition.files:
            digest = None
            if self.hashed:
                sha = hashlib.sha256()
                with system.open_input_stream(path, buffer_size=0) as stream:
                    while block := stream.read(self.block):
                        sha.update(block)
                digest = sha.hexdigest()
            yield path, relative, path.rsplit("/", 1)[-1], size, digest


class FileHashes(DataSource):
    """``spark.read.format("file_hashes").option("pattern", "*.parquet").load(folder)``: a row for each file below a folder.

    A task streams its files block by block into a running SHA-256, so memory is one block whatever the size of a file, and no
    row holds contents. ``hash`` = false lists the files without reading them (``sha256`` is null). Empty folders
    give no rows; a folder that does not exist is an error.
    """

    @classmethod
    def name(cls) -> str:
        return "file_hashes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HashReader:
        return HashReader(self.options)


def file_hashes(spark: SparkSession, path: str, pattern: str = "*", hashed: bool = True, block: int = BLOCK) -> DataFrame:
    spark.dataSource.register(FileHashes)
    return spark.read.format("file_hashes").options(pattern=pattern, hash=str(hashed).lower(), blockBytes=str(block)).load(path)
