"""Words of texts as numbers, inside tasks."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Rows whose texts a task has as Python objects at a time; bytes of one text cut at a time.
ROWS = 256
BYTES = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0d]")


class Hashes(dict):
    """A word's CRC-32; remembers the first ``most`` words it is asked for."""

    most = 1 << 17

    def __missing__(self, word: bytes) -> int:
        value = zlib.crc32(word)
        if len(self) < self.most:
            self[word] = value
        return value


def slices(data: bytes) -> Iterator[bytes]:
    """A text in slices of about ``BYTES``, cut at white space."""
    at = 0
    while len(data) - at > BYTES:
        cut = SPACE.search(data, at + BYTES)
        if not cut:
            break
        yield data[at : cut.end()]
        at = cut.end()
    yield data[at:] if at else data


def hashed(text: str | None, pattern: re.Pattern, hashes: Hashes, lower: bool = False) -> np.ndarray:
    """The hashes of a text's tokens, in order."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if lower:
        data = data.lower()
    parts = []
    for piece in slices(data):
        found = pattern.findall(piece)
        parts.append(np.fromiter(map(hashes.__getitem__, found), np.uint32, len(found)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list]]:
    """A batch's texts, ``ROWS`` at a time, with the row they begin at."""
    for at in range(0, batch.num_rows, ROWS):
        yield at, batch.column(column).slice(at, ROWS).to_pylist()
