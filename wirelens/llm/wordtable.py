"""Distinct-word tables: work done once a word, brought back to documents by place.

Documents are packed into chunks of about CHUNK_CHARS characters, one row
each.  The TOP most frequent words of the corpus (a fixed bound) go to every
task; a chunk lists its other words once each, and documents refer to them by
their number in that list.  The listed words are joined with the word table
and the answers return to the chunk, so the exchange carries each word once a
chunk rather than once an occurrence, and every group is as small as a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of the top table, and characters of the longest one: together they bound what every task gets.
TOP, TOP_CHARS = 1 << 18, 64
CHUNK_CHARS = 8_000_000
#: Distinct words that a task counts before it passes its partial counts on.
FLUSH = 400_000


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as compressed byte planes."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.astype("<u4" if width <= 4 else "<u8").view(np.uint8).reshape(len(values), 4 if width <= 4 else 8)[:, :width]
    data = np.ascontiguousarray(planes.T).tobytes()
    return len(values).to_bytes(8, "little") + bytes([width]) + pa.compress(data, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    n, width = int.from_bytes(blob[:8], "little"), blob[8]
    if not n:
        return np.empty(0, np.int64)
    data = np.frombuffer(pa.decompress(blob[9:], decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = data.reshape(width, n).T
    return out.view(np.int64).ravel()


def top_words(words: DataFrame, count: str, columns: list[str], top: int = TOP) -> list[list]:
    """Columns, as lists, of at most ``top`` words, the most frequent first (ties by the first column), so that frequent words get small numbers; the cut is found from a histogram of counts with bounded bins."""
    bin_ = F.floor(F.log2(F.col(count).cast("double")) * 64).cast("int")
    words = words.where((F.col(count) > 0) & (F.length(columns[0]) <= TOP_CHARS))
    bins = sorted(((r[0], r[1]) for r in words.groupBy(bin_.alias("b")).count().collect()), reverse=True)
    total, cut = 0, None
    for b, n in bins:
        if total + n > top:
            break
        total, cut = total + n, b
    if cut is None:
        return [[] for _ in columns]
    got = words.where(bin_ >= cut).select(*dict.fromkeys([*columns, count])).toArrow().sort_by([(count, "descending"), (columns[0], "ascending")])
    return [got.column(c).to_pylist() for c in columns]


def chunks(texts: Iterator[tuple], size: Callable[[tuple], int], most: int | None = None) -> Iterator[list[tuple]]:
    """Rows in lists of about ``most`` characters (CHUNK_CHARS); a longer row is alone."""
    most = most or CHUNK_CHARS
    held, n = [], 0
    for row in texts:
        if held and n + size(row) > most:
            yield held
            held, n = [], 0
        held.append(row)
        n += size(row)
    if held:
        yield held


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(doc_id, text) of every row; null texts are empty."""
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            part = batch.slice(k, 500)
            yield from zip(part.column(0).to_pylist(), (t or "" for t in part.column(1).to_pylist()), strict=True)


def chunk_ids() -> Iterator[int]:
    """Numbers that no other partition uses."""
    from pyspark import TaskContext

    at = TaskContext.get().partitionId() << 32
    while True:
        yield at
        at += 1


class Numbers(dict):
    """Numbers its keys from 0 as they come."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n

    def of(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


def pack_words(words: list[str]) -> bytes:
    """A list of words, none of which has a line break, in one compressed piece."""
    data = "\n".join(words).encode("utf-8", "surrogatepass")
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True) if words else b""


def unpack_words(blob: bytes) -> list[str]:
    return pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True).decode("utf-8", "surrogatepass").split("\n") if blob else []


def listed(chunk_at: int, words_at: int):
    """For mapInArrow: (chunk, place, word) of every chunk's list; takes whole rows, so that all readers of an exchange can share it."""

    def run(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column(chunk_at).to_pylist(), batch.column(words_at).to_pylist(), strict=True):
                w = unpack_words(blob)
                for at in range(0, len(w), 50_000):
                    part = w[at : at + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(part), pa.int64()), pa.array(range(at, at + len(part)), pa.int32()), pa.array(part, pa.string())], names=["chunk", "at", "word"])

    return run
