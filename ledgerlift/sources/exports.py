"""Annotation exports as a data source (S-01, S-02): one JSON document of large arrays, read element by element."""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator
from typing import BinaryIO

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

CHUNK = 1 << 20
ROWS = 4096  # elements of one Arrow batch
SPACE = " \t\r\n"


class _Text:
    """A window over a UTF-8 stream that grows while a value is not whole and lets go of what has been read."""

    def __init__(self, file: BinaryIO, chunk: int) -> None:
        self.file, self.chunk, self.decoder = file, chunk, codecs.getincrementaldecoder("utf-8-sig")()
        self.text, self.at, self.ended, self.values = "", 0, False, json.JSONDecoder()

    def more(self) -> bool:
        """Read as much again as is held, so that a long value costs linear time."""
        if self.ended:
            return False
        data = self.file.read(max(self.chunk, len(self.text) - self.at))
        self.ended = not data
        self.text, self.at = self.text[self.at :] + self.decoder.decode(data, self.ended), 0
        return True

    def peek(self) -> str:
        """The next character that is no space; empty at the end."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in SPACE:
                self.at += 1
            if self.at < len(self.text) or not self.more():
                return self.text[self.at : self.at + 1]

    def take(self, wanted: str) -> str:
        got = self.peek()
        if not got or got not in wanted:
            raise ValueError(f"one of {wanted!r} expected, {got or 'the end'!r} found")
        self.at += 1
        return got

    def value(self) -> str:
        """The text of the next value. A number may go on past the window, so its end must be in sight."""
        self.peek()
        while True:
            try:
                _, end = self.values.raw_decode(self.text, self.at)
                if end < len(self.text) or self.ended:
                    out, self.at = self.text[self.at : end], end
                    return out
            except json.JSONDecodeError:
                if self.ended:
                    raise
            self.more()


def elements(file: BinaryIO, part: str, chunk: int = CHUNK) -> Iterator[str]:
    """The JSON text of each element of the array `part` of the object in `file`; of other members only one value is held,
    and of other arrays one element. A member that is missing or no array has no elements."""
    text = _Text(file, chunk)
    text.take("{")
    if text.peek() == "}":
        return
    while True:
        key = json.loads(text.value())
        text.take(":")
        if text.peek() == "[":
            text.take("[")
            if text.peek() == "]":
                text.take("]")
            else:
                while True:
                    one = text.value()
                    if key == part:
                        yield one
                    if text.take(",]") == "]":
                        break
        else:
            text.value()
        if text.take(",}") == "}":
            return


class CocoExports(DataSource):
    """Options: `paths`, a JSON list of files; `part`, the array to read. Rows: (path, value), value an element's JSON text."""

    @classmethod
    def name(cls) -> str:
        return "coco_exports"

    def schema(self) -> str:
        return "path string, value string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(json.loads(self.options["paths"]), self.options["part"])


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], part: str) -> None:
        self.paths, self.part = paths, part

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(path) for path in self.paths] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        if partition.value is None:
            return
        store, at = fs.FileSystem.from_uri(partition.value)
        rows: list[str] = []
        with store.open_input_stream(at) as file:
            for one in elements(file, self.part):
                rows.append(one)
                if len(rows) == ROWS:
                    yield pa.RecordBatch.from_pydict({"path": [partition.value] * len(rows), "value": rows})
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pydict({"path": [partition.value] * len(rows), "value": rows})
