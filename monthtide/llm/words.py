"""Words of whole texts as arrays, in the tasks.

A word is a run of anything but space and U+0009 to U+000D. Texts are taken in slices of a few
MB, so a task's memory follows its longest text, not its partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 2 << 20
LONG_WORD = 256
BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def slices(
    batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, about ``most`` bytes of text (one row at least) at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(size, dtype=np.int64) - 1).clip(0) // most
        starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            yield batch.slice(a, b - a)


def split(texts: pa.Array, lower: bool) -> tuple[pa.Array, np.ndarray]:
    """All words in order, and for each text the end of its words. Null texts have none."""
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.fill_null(pc.ascii_split_whitespace(texts), [])
    flat = lists.flatten()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    ends = before[np.cumsum(lengths, dtype=np.int64)] if len(lengths) else np.zeros(0, np.int64)
    return flat.filter(real), ends.astype(np.int64)


def word_values(words: pa.Array, value: Callable[[str], int]) -> np.ndarray:
    """``value`` (an unsigned 64-bit number) of every word, worked out once for each kind."""
    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    each = np.fromiter(map(value, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return each[coded.indices.to_numpy(zero_copy_only=False)]


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of every word's bytes, eight bytes of all words at a time."""
    if not len(words):
        return np.zeros(0, np.uint64)
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) - 7, np.dtype("<u8"), data, strides=(1,))
    start, left = ends[:-1].astype(np.int64), np.diff(ends).astype(np.int64)
    out = mix(left.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    todo = np.flatnonzero((left > 0) & (left <= LONG_WORD))
    start, left = start[todo], left[todo]
    for k in range(0, LONG_WORD, 8):
        if not len(todo):
            break
        out[todo] = mix(out[todo] ^ (eight[start + k] & BYTES[np.minimum(left - k, 8)]))
        more = left > k + 8
        todo, start, left = todo[more], start[more], left[more]
    for i in np.flatnonzero(np.diff(ends) > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(data[ends[i] : ends[i + 1]].tobytes())
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive values (of none, if there are fewer)."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mix(out ^ values[k : k + n]) + np.uint64(k + 1)
    return mix(out)
