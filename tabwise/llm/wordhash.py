"""Word and shingle hashes of whole texts, vectorised with numpy.

Texts are handled as UTF-8 bytes. Separators and letter case are ASCII only, so
a byte table decides both, and no multi-byte character can be cut. Word hashes
are 64-bit polynomial sums finished by a mixing step; a text of any length is
worked through in pieces cut between words, so memory follows the piece, not the
text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes hashed at once. A word is never cut.
PIECE = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)

SPACES = b" \t\n\x0b\x0c\r"
#: Byte tables: every space byte becomes 0x20; one of them also lower-cases A-Z.
AS_SPACE = bytes(0x20 if b in SPACES else b for b in range(256))
LOWER_AS_SPACE = bytes(b + 32 if 65 <= b <= 90 else c for b, c in enumerate(AS_SPACE))

def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i < size, built by doubling."""
    n = 1
    up, down = np.ones(1, np.uint64), np.ones(1, np.uint64)
    while n < size:
        up = np.concatenate([up, up * np.uint64(pow(_BASE, n, 1 << 64))])
        down = np.concatenate([down, down * np.uint64(pow(_INVERSE, n, 1 << 64))])
        n *= 2
    return up, down


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    word = np.empty(len(data) + 2, np.int8)
    word[0] = word[-1] = 0
    np.not_equal(data, 32, out=word[1:-1].view(bool))
    edge = np.flatnonzero(np.diff(word))
    return edge[::2], edge[1::2]


def _pieces(data: bytes) -> Iterator[bytes]:
    at = 0
    while len(data) - at > PIECE:
        cut = data.rfind(b" ", at, at + PIECE)
        if cut <= at:  # one word longer than a piece: up to its end
            cut = data.find(b" ", at + PIECE)
            if cut < 0:
                break
        yield data[at:cut]
        at = cut
    yield data[at:]


class WordHasher:
    """Hashes words and runs of words; build one per task, it holds tables of powers."""

    def __init__(self, table: bytes = LOWER_AS_SPACE) -> None:
        self.table = table
        self.up, self.down = _power_tables(PIECE + 2)

    def _powers(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            self.up, self.down = _power_tables(size)
        return self.up, self.down

    def _hash_spans(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        up, down = self._powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _STEP)

    def _group(self, group: list[bytes]) -> Iterator[np.ndarray]:
        data = np.frombuffer(b" ".join(group), np.uint8)
        first = np.concatenate([[0], np.cumsum([len(g) + 1 for g in group])])
        start, end = _spans(data)
        hashes = self._hash_spans(data, start, end)
        cuts = np.searchsorted(start, first)
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield hashes[a:b]

    def words(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The word hashes of each text, in order; none for a null or blank text.

        Short texts are hashed together, long ones piece by piece.
        """
        group: list[bytes] = []
        size = 0
        for text in texts:
            raw = b"" if text is None else text.encode("utf-8", "replace").translate(self.table)
            if group and size + len(raw) > PIECE:
                yield from self._group(group)
                group, size = [], 0
            if len(raw) > PIECE:
                parts = []
                for piece in _pieces(raw):
                    data = np.frombuffer(piece, np.uint8)
                    parts.append(self._hash_spans(data, *_spans(data)))
                yield np.concatenate(parts)
            else:
                group.append(raw)
                size += len(raw) + 1
        if group:
            yield from self._group(group)

    def runs(self, words: np.ndarray, n: int) -> np.ndarray:
        """Hash of every run of ``n`` consecutive words; none when there are fewer."""
        if len(words) < n:
            return np.empty(0, np.uint64)
        m = len(words) - n + 1
        if n <= 12:
            out = words[:m].copy()
            for j in range(1, n):
                out = out * _STEP + words[j : j + m]
            return mix(out)
        up, down = self._powers(len(words) + 1)
        total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=total[1:])
        return mix((total[n:] - total[:-n]) * down[:m])

    def shingle_set(self, words: np.ndarray, n: int) -> np.ndarray:
        """Distinct ``n``-word shingles, sorted; a shorter text is one; none without words."""
        if len(words) == 0:
            return np.empty(0, np.uint64)
        return np.unique(self.runs(words, min(n, len(words))))
