"""Vectorised word splitting and word hashing over Arrow string columns.

A word is a maximal run of *word bytes* of the UTF-8 text, so the two
alphabets below split exactly like the regular expressions they stand for:
every byte of a character beyond ASCII is 0x80 or more and belongs to words
in both.

* ``SPACED``: ``[^\\x20\\x09-\\x0D]+``
* ``ALNUM``:  ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z went to a-z

A word's hash is a polynomial over random 64-bit byte codes modulo 2**64,
finished by a mixer; runs of words hash the same way over word hashes. Both
are prefix sums, so a batch costs a few nanoseconds a byte and no Python
loop runs over words. Hashes are the same in every process and session.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18  # texts are joined to pieces of about this size (a longer text is one piece); some 50 bytes of arrays a byte
SLICE_BYTES = 1 << 20  # rows with texts are handed on in slices of about this size

_U = np.uint64
_BASE, _RUN = 0x9E3779B97F4A7C15 | 5, 0xD6E8FEB86659FD93 | 5  # odd, 5 modulo 8
_BASE = (_BASE & ~7) | 5
_RUN = (_RUN & ~7) | 5
_M64 = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=_U)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * _U(pow(base, done, 1 << 64))
        done += step
    return out


class _Table:
    """Powers of a base and of its inverse, grown on demand and kept by the worker."""

    def __init__(self, base: int):
        self.base, self.inv = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=_U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(self.base, n), _powers(self.inv, n)
        return self.up, self.down


_BYTES, _RUNS = _Table(_BASE), _Table(_RUN)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


@dataclass(frozen=True)
class Alphabet:
    """``code[b]``: random 64-bit value of byte b, 0 if b is outside words."""

    code: np.ndarray

    @staticmethod
    def build(outside, lower: bool) -> Alphabet:
        code = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
        if lower:
            code[65:91] = code[97:123]
        code[np.array(sorted(outside))] = 0
        return Alphabet(code)


_SPACE = {0x20, *range(0x09, 0x0E)}
SPACED = Alphabet.build(_SPACE, lower=False)
SPACED_LOWER = Alphabet.build(_SPACE, lower=True)
ALNUM = Alphabet.build({*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}, lower=True)


def hash_word(word: str, alphabet: Alphabet) -> int:
    """The hash of one word (for small fixed lists)."""
    return int(Words.of([word], alphabet).hashes[0])


@dataclass
class Words:
    """Words of a run of texts: ``hashes``; ``first`` holds each text's first
    word index, with the total at the end; ``starts`` are byte offsets in
    ``data``, and text i begins at byte ``offsets[i]``."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    alphabet: Alphabet

    @staticmethod
    def of(texts, alphabet: Alphabet) -> Words:
        raw = [(t or "").encode("utf-8", "surrogatepass") if not isinstance(t, bytes) else t for t in texts]
        offsets = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum([len(x) for x in raw], out=offsets[1:])
        return Words.over(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets, alphabet)

    @staticmethod
    def over(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Words:
        code = alphabet.code[data]
        inside = code != 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = offsets[:-1]
        heads = heads[heads < len(data)]
        begins[heads] = inside[heads]  # a word never crosses texts
        starts = np.flatnonzero(begins)
        up, down = _BYTES.get(len(data) + 1)
        if len(starts):
            hashes = mix(np.add.reduceat(code * up[:len(data)], starts) * down[starts])
        else:
            hashes = np.empty(0, dtype=_U)
        return Words(hashes, np.searchsorted(starts, offsets), starts, data, offsets, alphabet)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def runs(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; a text's last k - 1 are not
        runs of that text (see ``run_ok``)."""
        n = len(self.hashes)
        if n < k:
            return np.empty(0, dtype=_U)
        up, down = _RUNS.get(n + 1)
        sums = np.zeros(n + 1, dtype=_U)
        np.cumsum(self.hashes * up[:n], out=sums[1:])
        return mix((sums[k:] - sums[:-k]) * down[:n - k + 1] + _U(k))

    def whole(self) -> np.ndarray:
        """Hash of each text's whole word sequence."""
        up, down = _RUNS.get(len(self.hashes) + 1)
        sums = np.zeros(len(self.hashes) + 1, dtype=_U)
        np.cumsum(self.hashes * up[:len(self.hashes)], out=sums[1:])
        return mix((sums[self.first[1:]] - sums[self.first[:-1]]) * down[self.first[:-1]] + self.counts().astype(_U))

    def run_ok(self, k: int) -> np.ndarray:
        """Whether the run from each word on stays within its text."""
        n = max(len(self.hashes) - k + 1, 0)
        ok = np.ones(n, dtype=bool)
        for back in range(1, k):
            at = self.first[1:-1] - back
            at = at[(at >= 0) & (at < n)]
            ok[at] = False
        return ok

    def doc_of(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def hash_run(hashes: np.ndarray) -> int:
    """``Words.runs(len(hashes))[0]`` of a plain list of word hashes."""
    n = len(hashes)
    up, _ = _RUNS.get(n + 1)
    return int(mix(np.array([(np.asarray(hashes, dtype=_U) * up[:n]).sum(dtype=_U) + _U(n)], dtype=_U))[0])


def slices(batch: pa.RecordBatch, text: int | str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows, in order, whose column ``text`` takes about ``size``
    bytes, so that what is made of the texts need not be held for a whole batch."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(lengths, dtype=np.int64)])
    for at, to in _cuts(ends, size):
        yield batch.slice(at, to - at)


def _cuts(ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """(from row, to row) of runs of about ``size`` bytes, of one row at least; row i spans ends[i]:ends[i + 1]."""
    at, n = 0, len(ends) - 1
    while at < n:
        to = int(np.searchsorted(ends, ends[at] + size, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def pieces(column: pa.Array, alphabet: Alphabet, chunk: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(from row, to row, Words) over a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.empty(0, dtype=np.uint8)
    if column.null_count:  # a null may span bytes of its own
        column = column.fill_null("")
        yield from pieces(column, alphabet, chunk)
        return
    for at, to in _cuts(ends, chunk):
        yield at, to, Words.over(data[ends[at]:ends[to]], ends[at:to + 1] - ends[at], alphabet)
