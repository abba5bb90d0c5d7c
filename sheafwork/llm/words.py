"""Words of whole texts as 64-bit hashes, for a batch of documents at a time.

Words are the runs ``[^\\x20\\x09-\\x0D]+``. All six separators are single bytes of UTF-8, so a batch
is cut on its bytes. A word is hashed eight bytes at a time; texts never share a word, and a null
text has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
SEPARATOR_PATTERN = "[\\x20\\x09-\\x0D]+"

_U = np.uint64
SEPARATOR = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection that spreads every input bit."""
    h = h + _U(0x9E3779B97F4A7C15)
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a batch, and where each text starts (one more than there are texts)."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if len(column) == 0 or data is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    taken = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return taken, offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and the byte after the last of every word, in order."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = ~SEPARATOR[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, read eight bytes at a time."""
    if not len(starts):
        return np.empty(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded.data, strides=(1,))
    length = ends - starts
    h = mix(eight[starts] & _MASKS[np.minimum(length, 8)]) ^ length.astype(np.uint64)
    h = mix(h)
    left, done = np.flatnonzero(length > 8), 8
    while len(left):
        piece = eight[starts[left] + done] & _MASKS[np.minimum(length[left] - done, 8)]
        h[left] = mix(h[left] * _U(3) + mix(piece))
        done += 8
        left = left[length[left] > done]
    return h


def batch_words(column: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch and, per text, where its words start (one more than texts)."""
    data, offsets = text_bytes(column)
    if lower:
        data = _LOWER[data]
    starts, ends = word_bounds(data, offsets)
    return hash_ranges(data, starts, ends), np.searchsorted(starts, offsets)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words (borders between texts are the caller's business)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(count, np.uint64)
    for k in range(n):
        h = mix(h * _U(0x100000001B3) + words[k : k + count])
    return h


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 22):
    """Consecutive parts of a batch whose texts hold ``most`` bytes each, or one longer text."""
    _, offsets = text_bytes(batch.column(column))
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        end = min(max(end, row + 1), batch.num_rows)
        yield batch.slice(row, end - row)
        row = end
