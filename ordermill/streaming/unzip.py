"""Lines of zipped files, one file at a time, as rows.

Spark's own readers fail a whole job when one zipped file is cut off. Here every file is a row that a task turns into its lines
or into the error that was met, so a bad file costs neither the others nor a second job. A zipped file cannot be split, so
a task per file is all there is to gain in either way. Each file is checked to its end before its first line goes out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa

#: Lines that go out together.
LINES = 10_000
#: Bytes that are unzipped at once.
PIECE = 1 << 20

ROWS = "file string, line string, error string"
_SCHEMA = pa.schema([("file", pa.string()), ("line", pa.string()), ("error", pa.string())])
_BREAK = re.compile(rb"\r\n|\n|\r(?!\Z)")


def _pieces(content: bytes) -> Iterator[bytes]:
    """Unzipped bytes of a file of one or more members; raises if it is damaged or ends too early."""
    rest = memoryview(content)
    while len(rest):
        member = zlib.decompressobj(wbits=31)
        fed = rest[:0]
        while not member.eof:
            fed, rest = (member.unconsumed_tail, rest) if member.unconsumed_tail else (rest[:PIECE], rest[PIECE:])
            if len(fed):
                yield member.decompress(fed, PIECE)
                continue
            yield member.flush()
            if not member.eof:
                raise EOFError("the file ends before its zipped data does")
        used = member.unused_data
        rest = memoryview(used + bytes(rest)) if used else rest


def unzipped_lines(content: bytes) -> Iterator[str]:
    held = b""
    for piece in _pieces(content):
        *whole, held = _BREAK.split(held + piece)
        yield from (line.decode("utf-8", "replace") for line in whole)
    if held:
        yield held.rstrip(b"\r").decode("utf-8", "replace")


def _batch(file: str, lines: list[str | None], error: str | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([file] * len(lines)), pa.array(lines, pa.string()), pa.array([error] * len(lines), pa.string())], schema=_SCHEMA
    )


def lines_or_error(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (path, content): the lines of each file, then a row without line and error; or one row with the error alone."""
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            content = content.as_buffer().to_pybytes()
            try:
                for _ in _pieces(content):
                    pass
            except (zlib.error, EOFError) as error:
                yield _batch(path, [None], f"{type(error).__name__}: {error}")
                continue
            some: list[str | None] = []
            for line in unzipped_lines(content):
                some.append(line)
                if len(some) == LINES:
                    yield _batch(path, some)
                    some = []
            yield _batch(path, [*some, None])
