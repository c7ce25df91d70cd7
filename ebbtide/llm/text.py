"""Vectorised word hashing over UTF-8 bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_LENGTH = 4096


def _constants() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240)
    values = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    places = rng.integers(1, 2**63, _LENGTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return values, places


VALUES, PLACES = _constants()


def space_table() -> np.ndarray:
    """True for bytes that end a word: space and \\x09-\\x0D."""
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public splitmix64 constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as bytes) in runs of about `size` bytes; null is empty."""
    first, held, total = 0, [], 0
    for i, value in enumerate(texts):
        data = value.as_buffer().to_pybytes() if value.is_valid else b""
        if held and total + len(data) > size:
            yield first, held
            first, held, total = i, [], 0
        held.append(data)
        total += len(data)
    if held:
        yield first, held


def words(texts: list[bytes], ends: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hash of every word of the texts in turn, words before each text (one entry more), prefix hashes.

    `ends` says for each of 256 bytes whether it ends a word. A-Z count as a-z.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = lower_table()[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    gap = ends[data]
    gap[np.cumsum(sizes + 1) - 1] = True
    edges = np.flatnonzero(np.diff(np.concatenate(([True], gap))))
    starts, stops = edges[::2], edges[1::2]
    first = np.concatenate(([0], np.cumsum(sizes + 1)))
    before = np.searchsorted(starts, first)
    if not len(starts):
        return np.zeros(0, np.uint64), before, [np.zeros(0, np.uint64) for _ in prefixes]
    place = np.arange(len(data)) - np.repeat(np.concatenate((starts, [len(data)])), np.diff(np.concatenate(([0], starts[1:], [len(data)], [len(data)]))))
    code = VALUES[data] * PLACES[place & (_LENGTH - 1)]
    code[gap] = 0
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(code)))
    at = total[starts]
    return mix(total[stops] - at), before, [mix(total[np.minimum(starts + p, stops)] - at + np.uint64(p)) for p in prefixes]


def raw(column: pa.Array) -> list[bytes]:
    """The texts of a batch; null is empty."""
    return [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in column]


PIECE_BYTES = 1 << 18
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
# Odd factors for the 4,096-byte runs of a word, so that a very long word's runs can't change places unseen.
_RUNS = mix(np.arange(1, _LENGTH + 1, dtype=np.uint64)) | np.uint64(1)
_RUNS[0] = 1


def pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The text in runs of about `size` bytes, cut at spaces; one run at least, which may be empty."""
    at = 0
    while len(data) - at > size:
        space = _SPACE.search(data, at + size)
        if not space:
            break
        yield data[at:space.start()]
        at = space.end()
    yield data[at:] if at else data


def word_hashes(data: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word of `data`, words as `space_table` ends them; about 30 bytes of arrays a byte."""
    codes = np.frombuffer(data, np.uint8)
    if lower:
        codes = lower_table()[codes]
    body = ~space_table()[codes]
    edges = np.flatnonzero(np.diff(body, prepend=False, append=False))
    starts, stops = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    sizes = stops - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum()), dtype=np.int32) - np.repeat(first.astype(np.int32), sizes)
    code = VALUES[codes[body]]
    code *= PLACES[place & (_LENGTH - 1)]
    if sizes.max() > _LENGTH:
        code *= _RUNS[(place >> 12) & (_LENGTH - 1)]
    return mix(np.add.reduceat(code, first) + sizes.astype(np.uint64)), starts


def word_runs(texts: list[bytes], lower: bool = False, keep: int = 0, size: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray, int, bool]]:
    """(first text, hashes, bounds, words before, last) of the texts' words, a bounded run of bytes at a time.

    A run holds the whole words of several texts (`bounds` parts them, one entry more than texts), or a piece of one
    text longer than `size`; a piece then begins with the last `keep` words of the piece before. `last` says that the
    run ends its texts. How a text is cut depends on that text alone.
    """
    held: list[bytes] = []
    first, total = 0, 0

    def together() -> tuple[int, np.ndarray, np.ndarray, int, bool]:
        joined = b"\n".join(held)
        h, starts = word_hashes(joined, lower)
        ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held)) + 1)
        return first, h, np.concatenate(([0], np.searchsorted(starts, ends))), 0, True

    for i, data in enumerate(texts):
        if held and (total + len(data) > size or len(data) > size):
            yield together()
            held, total = [], 0
        if len(data) <= size:
            if not held:
                first = i
            held.append(data)
            total += len(data) + 1
            continue
        carried, before, waiting = np.zeros(0, np.uint64), 0, None
        for piece in pieces(data, size):
            if waiting is not None:
                yield *waiting, False
            h = np.concatenate((carried, word_hashes(piece, lower)[0]))
            waiting = (i, h, np.array([0, len(h)]), before - len(carried))
            before += len(h) - len(carried)
            carried = h[max(0, len(h) - keep):] if keep else carried
        yield *waiting, True
    if held:
        yield together()
