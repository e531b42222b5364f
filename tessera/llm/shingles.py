"""Word shingles as sets of 64-bit hashes, for NumPy code inside tasks."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORDS = 5
#: Bytes that are hashed together; a longer word is hashed on its own.
BLOCK = 1 << 19
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
# odd multipliers, one per place in a shingle
_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                   0xA0761D6478BD642F], np.uint64)
_HALF = np.uint64(32)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = x + np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for _ in range(2):
        x = (x ^ (x >> _HALF)) * _PLACE[3]
    return x ^ (x >> _HALF)


class WordHasher:
    """Hashes of all words of a block at once: a word is a polynomial over its
    bytes' random numbers modulo 2**64, a difference of prefix sums."""

    BASE = 0xD1342543DE82EF95

    def __init__(self) -> None:
        n = 2 * BLOCK + 2
        self.value = mixed(np.arange(256, dtype=np.uint64), 17)
        self.space = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
        self.power, self.inverse = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, b, np.uint64)])
                                    for b in (self.BASE, pow(self.BASE, -1, 1 << 64)))

    def block(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes) of the words."""
        raw = np.frombuffer(data, np.uint8)
        edge = np.diff(np.r_[True, self.space[raw], True].astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.value[raw] * self.power[:len(raw)], out=sums[1:])
        return starts, mixed((sums[ends] - sums[starts]) * self.inverse[starts], 0) + (ends - starts).astype(np.uint64) * _PLACE[4]

    def _long(self, data: bytes) -> np.ndarray:
        """Hashes of the words of a text of more than a block."""
        out, at = [], 0
        while at < len(data):
            found = _SPACE.search(data, at + BLOCK)
            end = found.start() if found else len(data)
            if end - at <= 2 * BLOCK:
                out.append(self.block(data[at:end])[1])
            else:
                for word in data[at:end].split():
                    out.append(self.block(word)[1] if len(word) <= BLOCK else np.array([xxhash.xxh3_64_intdigest(word)], np.uint64))
            at = end
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """Hashes of each text's words, A to Z lower-cased (bytes.lower knows no
        others)."""
        out: list[np.ndarray] = []
        held: list[bytes] = []

        def flush() -> None:
            if held:
                starts, hashes = self.block(b" ".join(held))
                ends = np.cumsum([len(x) + 1 for x in held])
                out.extend(np.split(hashes, np.searchsorted(starts, ends[:-1])))
                held.clear()

        size = 0
        for text in texts:
            data = (text or "").encode("utf-8", "replace").lower()
            if len(data) > BLOCK:
                flush()
                out.append(self._long(data))
                size = 0
                continue
            if size + len(data) + 1 > BLOCK:
                flush()
                size = 0
            held.append(data)
            size += len(data) + 1
        flush()
        return out


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """The hash of the shingle at each place of a text."""
    n = max(0, len(words) - WORDS + 1)
    total = words[:n] * _PLACE[0]
    for k in range(1, WORDS):
        total += words[k:n + k] * _PLACE[k]
    return mixed(total)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than a shingle count as one."""
    if 0 < len(words) < WORDS:
        return mixed((words * _PLACE[:len(words)]).sum(keepdims=True), len(words))
    return np.unique(shingle_hashes(words))


def set_keys(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit digests of a set, as signed integers."""
    return int(mixed(s, 1).sum().astype(np.int64)), int(s.sum().astype(np.int64))
