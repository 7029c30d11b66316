"""Files by name as Spark data sources: any name read, whole tasks committed when written.

Both sides open paths with Arrow's file systems, which take plain paths and URIs. Spark
itself leaves out names that begin with an underscore and can't name the files it writes.
"""

from __future__ import annotations

import posixpath
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Bytes of files that one task reads, at least where one file has fewer; and of a batch.
TASK_BYTES, BATCH_BYTES = 32 << 20, 4 << 20
STAGING = ".staging-"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and plain path of a path or URI; ValueError if Arrow has none for it."""
    try:
        return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    except (pa.ArrowInvalid, OSError) as error:
        raise ValueError(f"no file system for {path}: {error}") from None


def can_open(path: str) -> bool:
    try:
        opened(path)
    except ValueError:
        return False
    return True


@dataclass
class Share(InputPartition):
    """Files of one task, as paths below the root."""

    names: list[str]


class NamedFiles(DataSource):
    """``(file_path, content)`` of all files below ``path`` whose names end with ``suffix``.

    Only names that begin with a dot are left out. Content that is not UTF-8 is null.
    """

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "file_path string, content string"

    def reader(self, schema) -> NamedFilesReader:
        return NamedFilesReader(self.options["path"], self.options.get("suffix", ""))


class NamedFilesReader(DataSourceReader):
    def __init__(self, path: str, suffix: str):
        self.path, self.suffix = path, suffix

    def partitions(self) -> list[Share]:
        """Shares of about equal bytes: the largest files first, each to the lightest share."""
        system, root = opened(self.path)
        prefix = root.rstrip("/") + "/"
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        files = [(f.size or 0, f.path.removeprefix(prefix)) for f in found if f.type == fs.FileType.File]
        files = sorted((x for x in files if x[1].endswith(self.suffix) and not any(p.startswith(".") for p in x[1].split("/"))), reverse=True)
        shares: list[tuple[int, list[str]]] = []
        for size, name in files:
            if not shares or shares[-1][0] + size > TASK_BYTES:
                shares.append((0, []))
            shares[-1][1].append(name)
            shares[-1] = shares[-1][0] + size + 4096, shares[-1][1]
        return [Share(names) for _, names in shares] or [Share([])]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        system, root = opened(self.path)
        names, texts, size = [], [], 0
        for name in partition.names:
            with system.open_input_stream(f"{root.rstrip('/')}/{name}") as source:
                data = source.read()
            try:
                texts.append(data.decode("utf-8"))
            except UnicodeDecodeError:
                texts.append(None)
            names.append(name)
            size += len(data)
            if size > BATCH_BYTES:
                yield _batch(names, texts)
                names, texts, size = [], [], 0
        yield _batch(names, texts)


def _batch(names: list[str], texts: list[str | None]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["file_path", "content"])


class DocumentFiles(DataSource):
    """Sink: rows of ``(content_path, markdown)`` as one file each below ``path``."""

    @classmethod
    def name(cls) -> str:
        return "document_files"

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        names = list(schema.names)
        writer = DocumentWriter(self.options["path"], overwrite, names.index("content_path"), names.index("markdown"))
        writer.begin()
        return writer


@dataclass
class Staged(WriterCommitMessage):
    """A task's folder below the staging folder."""

    folder: str


def below(path: str) -> str:
    """A file's path below the root; ValueError if it would leave it or name no file."""
    plain = posixpath.normpath(path or "")
    if plain in (".", "") or plain.startswith(("/", "../")) or plain == ".." or path.endswith("/"):
        raise ValueError(f"no file path below the target: {path!r}")
    return plain


class DocumentWriter(DataSourceArrowWriter):
    """Tasks write to folders of their own; the commit moves files to their names.

    A task that fails takes its folder along, a job that fails the whole staging folder,
    so no file appears under its name before all are written. Tasks never make the staging
    folder, so one that outlives its job can't bring it back. Where attempts of a task run
    twice, only the one that Spark accepts is moved.
    """

    def __init__(self, path: str, overwrite: bool, path_at: int, text_at: int):
        self.path, self.overwrite, self.path_at, self.text_at = path, overwrite, path_at, text_at
        self.stage = f"{STAGING}{uuid.uuid4().hex}"

    def _places(self) -> tuple[fs.FileSystem, str, str]:
        system, root = opened(self.path)
        root = root.rstrip("/")
        return system, root, f"{root}/{self.stage}"

    def begin(self) -> None:
        """Make the staging folder; runs once, before any task."""
        system, _, stage = self._places()
        system.create_dir(stage, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        system, _, stage = self._places()
        task = TaskContext.get()
        own = f"{stage}/{task.partitionId()}-{task.taskAttemptId()}"
        system.create_dir(own, recursive=False)
        made = {own}

        def make(folder: str) -> None:
            if folder not in made:
                make(posixpath.dirname(folder))
                system.create_dir(folder, recursive=False)
                made.add(folder)

        try:
            for batch in iterator:
                for path, text in zip(batch.column(self.path_at), batch.column(self.text_at)):
                    target = f"{own}/{below(path.as_py())}"
                    make(posixpath.dirname(target))
                    with system.open_output_stream(target) as out:
                        out.write((text.as_py() or "").encode("utf-8"))
        except BaseException:
            if system.get_file_info(own).type == fs.FileType.Directory:
                system.delete_dir(own)
            raise
        return Staged(own)

    def commit(self, messages: list[Staged | None]) -> None:
        system, root, stage = self._places()
        if self.overwrite:
            for old in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if posixpath.basename(old.path.rstrip("/")).startswith(STAGING):
                    continue
                (system.delete_dir if old.type == fs.FileType.Directory else system.delete_file)(old.path)
        made = set()
        for message in messages:
            if message is None:
                continue
            for info in system.get_file_info(fs.FileSelector(message.folder, recursive=True)):
                if info.type != fs.FileType.File:
                    continue
                target = f"{root}/{info.path.removeprefix(message.folder + '/')}"
                folder = posixpath.dirname(target)
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                system.move(info.path, target)
        system.delete_dir(stage)

    def abort(self, messages: list[Staged | None]) -> None:
        system, _, stage = self._places()
        for _ in range(20):  # a task may write while its folder is being emptied
            if system.get_file_info(stage).type != fs.FileType.Directory:
                return
            try:
                system.delete_dir(stage)
            except OSError:
                time.sleep(0.1)
