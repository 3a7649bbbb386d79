"""Posts of accounts from a folder of exported files, as a Spark data source: in a batch, or as a stream that goes on where it stopped.

    spark.dataSource.register(ExportedPosts)
    spark.read.format("exported_posts").load("/shared/exports")
    spark.readStream.format("exported_posts").option("files", 100).load("/shared/exports")
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

CHUNK = 32 << 20  # bytes of a file that one partition reads
FIELDS = "account string, id string, permalink string, media_type string, timestamp string, caption string, file string"


@dataclass
class Piece(InputPartition):
    """The lines of a file that begin at its bytes start to end."""

    path: str
    start: int
    end: int


def _folder(path: str):
    """The file system that a path or URI names, and the folder in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def exports(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a folder's files of lines, by name; names that begin with a dot or an underscore are still being written."""
    from pyarrow import fs

    system, folder = _folder(path)
    files = system.get_file_info(fs.FileSelector(folder))
    return sorted((f.path, f.size) for f in files if f.type == fs.FileType.File and f.base_name.endswith(".jsonl") and f.base_name[0] not in "._")


def pieces(files: list[tuple[str, int]], chunk: int) -> list[Piece]:
    return [Piece(path, at, min(at + chunk, size)) for path, size in files for at in range(0, size, chunk)]


def _rows(root: str, piece: Piece | None, accounts: frozenset[str] | None) -> Iterator[tuple]:
    """The posts on a piece's lines. A line that isn't an object with an account and an id fails the read, with its place."""
    if piece is None:  # what Spark reads where there are no partitions
        return
    system, _ = _folder(root)
    name = piece.path.rsplit("/", 1)[-1]
    with system.open_input_file(piece.path) as file:
        # a line belongs to the piece that holds its first byte: one begun before is left to the piece before
        at = piece.start - 1 if piece.start else 0
        file.seek(at)
        lines = _lines(file)
        if piece.start:
            at += len(next(lines, b""))
        for line in lines:
            if at >= piece.end:
                return
            if line.strip():
                try:
                    post = json.loads(line)
                    account, key = post["account"], str(post["id"])
                except (ValueError, TypeError, KeyError) as error:
                    raise ValueError(f"{name}, byte {at}: not a post ({error})") from error
                if accounts is None or account in accounts:
                    yield account, key, *(post.get(f) for f in ("permalink", "media_type", "timestamp", "caption")), name
            at += len(line)


def _lines(file, size: int = 1 << 20) -> Iterator[bytes]:
    """A file's lines from where it stands, each with its end."""
    rest = b""
    while block := file.read(size):
        *whole, rest = (rest + block).split(b"\n")
        yield from (line + b"\n" for line in whole)
    if rest:
        yield rest


class Batch(DataSourceReader):
    """Files cut in pieces of bytes, one partition each; a filter on accounts drops other posts where they are read."""

    def __init__(self, options: dict[str, str]):
        self.path, self.chunk = options["path"], int(options.get("chunk", CHUNK))
        self.accounts: frozenset[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("account",):
                named = frozenset([f.value] if isinstance(f, EqualTo) else f.value)
                self.accounts = named if self.accounts is None else self.accounts & named
            yield f  # Spark filters again, which also judges nulls

    def partitions(self) -> list[Piece]:
        return pieces(exports(self.path), self.chunk)

    def read(self, partition: Piece) -> Iterator[tuple]:
        return _rows(self.path, partition, self.accounts)


class Stream(DataSourceStreamReader):
    """A stream over the same folder. Its offset is the last file's name that was read, so new files must have later names, as
    exports named by their time have; a file doesn't change once it has its name. Each micro-batch takes `files` at most."""

    def __init__(self, options: dict[str, str]):
        self.path, self.chunk, self.most = options["path"], int(options.get("chunk", CHUNK)), int(options.get("files", 1000))
        self.at: str | None = None  # the end of the last batch that was planned

    def initialOffset(self) -> dict:
        return {"after": ""}

    def _between(self, after: str, last: str | None) -> list[tuple[str, int]]:
        named = [(path.rsplit("/", 1)[-1], path, size) for path, size in exports(self.path)]
        return [(path, size) for name, path, size in named if name > after and (last is None or name <= last)]

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = ""
        new = self._between(self.at, None)[: self.most]
        if new:
            self.at = new[-1][0].rsplit("/", 1)[-1]
        return {"after": self.at}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        self.at = end["after"]
        return pieces(self._between(start["after"], end["after"]), self.chunk)

    def read(self, partition: Piece) -> Iterator[tuple]:
        return _rows(self.path, partition, None)


class ExportedPosts(DataSource):
    """`exported_posts`: files *.jsonl with a post a line (account, id, permalink, media_type, timestamp, caption)."""

    @classmethod
    def name(cls) -> str:
        return "exported_posts"

    def schema(self) -> str:
        return FIELDS

    def reader(self, schema: StructType) -> DataSourceReader:
        return Batch(dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return Stream(dict(self.options))
