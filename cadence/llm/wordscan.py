"""Words of whole texts, a batch at a time in numpy and Arrow buffers.

A word is a maximal run of word bytes; A-Z are lowered, bytes of other than
ASCII characters always belong to words.  A batch's words come as numbers into
its different words, so that hashing and lookups are done once a different
word and everything else is an array operation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are looked at together; a longer text goes by itself.
SLICE_BYTES = 4_000_000


def byte_table(digits: bool) -> np.ndarray:
    """For every byte its form within a word (A-Z lowered), 0 for the bytes
    between words: letters and bytes from 0x80 on are word bytes, digits on demand."""
    form = np.zeros(256, np.uint8)
    form[0x80:] = np.arange(0x80, 256)
    form[ord("a") : ord("z") + 1] = form[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    if digits:
        form[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
    return form


LETTERS = byte_table(False)
ALPHANUMERIC = byte_table(True)


@dataclass
class Words:
    number: np.ndarray  # of every word, its place in terms
    terms: pa.BinaryArray  # the different words
    bound: np.ndarray  # words bound[i] to bound[i + 1] are text i's

    def text_of(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(len(self.bound) - 1), np.diff(self.bound))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of binary or string texts."""
    wide = pa.types.is_large_binary(texts.type) or pa.types.is_large_string(texts.type)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return flat[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def words(texts: pa.Array, form: np.ndarray) -> Words:
    """The words of binary texts without nulls."""
    data, offsets = buffers(texts)
    low = form[data]
    inside = low != 0
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True  # a word never goes on in the next text
    before = np.r_[False, inside]
    after = np.r_[inside, False]
    start = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    size = end - start
    at = np.r_[0, np.cumsum(size)]
    kept = low[inside]
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(size), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(kept)]
    ).dictionary_encode()
    return Words(flat.indices.to_numpy(zero_copy_only=False), flat.dictionary, np.searchsorted(start, offsets))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in batches of about ``most``
    (SLICE_BYTES) of text: smaller ones are put together, larger ones cut between rows."""
    most = most or SLICE_BYTES
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffers(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + most - size, "right")) - 1
            last = min(max(last, first + (not held)), batch.num_rows)
            if last > first:
                held.append(batch.slice(first, last - first))
                size += int(offsets[last] - offsets[first])
            if last < batch.num_rows or size >= most:
                yield _joined(held)
                held, size = [], 0
            first = last
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def text_bytes(docs: DataFrame, *columns) -> DataFrame:
    """``columns`` and the text as bytes, null texts empty."""
    return docs.select(*columns, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
