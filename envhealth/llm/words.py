"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are looked at together; a single longer text is still one piece.
PIECE_BYTES = 2 << 20
#: Bytes of words that are hashed together.
HASH_BYTES = 512 << 10

_SEED = np.random.default_rng(20240229)
_BYTE_CODES = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD_STEP = np.uint64(0xD6E8FEB86659FD93)

_ALL = np.arange(256)
#: Bytes of words between ASCII white space (space and 0x09 to 0x0D).
NOT_SPACE = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
#: Bytes of words made of digits, lower-case ASCII letters and anything beyond ASCII.
ALNUM = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80)
#: Maps A-Z to a-z and leaves every other byte.
LOWER = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 0x20, _ALL).astype(np.uint8)


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values over all their bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(step: np.uint64, n: int) -> np.ndarray:
    """1, step, step**2, ... modulo 2**64."""
    out = np.full(max(n, 1), step, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Texts:
    """Texts `first` to `first + len(offsets) - 2` of a batch, lower-cased, end to end."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


@dataclass
class Words:
    """Words in order: byte range, 64-bit hash; `bounds[i]:bounds[i + 1]` are those of text i."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a null is an empty text."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(column: pa.Array, lower: bool = True, size: int = PIECE_BYTES) -> Iterator[Texts]:
    """The texts of a column in runs of about `size` bytes."""
    data, at = byte_column(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, "right")) - 1)
        part = data[at[i] : at[j]]
        yield Texts(i, LOWER[part] if lower else part, at[i : j + 1] - at[i])
        i = j


def find_words(texts: Texts, inside: np.ndarray, hashed: bool = True) -> Words:
    """Maximal runs of `inside` bytes; a run never crosses two texts."""
    data, at = texts.data, texts.offsets
    n = len(data)
    in_word = np.zeros(n + 1, bool)
    in_word[:n] = inside[data]
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    before = np.zeros(n + 1, bool)
    before[1:] = in_word[:-1]
    starts = np.flatnonzero(in_word & (~before | cut))
    ends = np.flatnonzero(before & (~in_word | cut))
    bounds = np.searchsorted(starts, at)
    hashes = hash_ranges(data, starts, ends) if hashed else np.zeros(0, np.uint64)
    return Words(starts, ends, hashes, bounds)


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range; ranges are in order and do not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    steps = powers(_BYTE_STEP, int(sizes.max()))
    total = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):  # bounded runs of words, so that only single bytes are held at full length
        j = max(i + 1, int(np.searchsorted(total, total[i] + HASH_BYTES, "right")) - 1)
        n, firsts = sizes[i:j], total[i:j] - total[i]
        place = np.arange(total[j] - total[i]) - np.repeat(firsts, n)
        codes = _BYTE_CODES[data[place + np.repeat(starts[i:j], n)]]
        codes *= steps[place]
        out[i:j] = np.add.reduceat(codes, firsts)
        i = j
    return mixed(out + sizes.astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; grams run over text ends, which callers mask."""
    total = len(words) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(total, np.uint64)
    for j, factor in enumerate(powers(_WORD_STEP, n)):
        out += words[j : j + total] * factor
    return mixed(out)


def gram_fits(bounds: np.ndarray, n_words: int, n: int) -> np.ndarray:
    """For each gram position, whether the n words lie in one text."""
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n_words)
    return left[: max(0, n_words - n + 1)] >= n
