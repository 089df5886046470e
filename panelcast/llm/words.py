"""Words of many texts as 64-bit hashes, computed in numpy on the UTF-8 bytes."""

from __future__ import annotations

import numpy as np

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: Bytes that are hashed at once; the working memory is about 40 times as much.
SEGMENT = 1 << 18
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a hash: every input bit changes every output bit (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_table() -> np.ndarray:
    """A random value per byte; A-Z have those of a-z, blanks 0."""
    codes = np.arange(256)
    codes[65:91] += 32
    table = mix((codes + 1).astype(np.uint64) * np.uint64(_ODD))
    table[BLANK] = 0
    return table


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]), dtype=np.uint64)


_TABLE = _byte_table()
_UP, _DOWN = _powers(_ODD, SEGMENT), _powers(pow(_ODD, -1, 1 << 64), SEGMENT)


def _hash_segment(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first bytes, hashes) of the words of a segment that ends with a blank."""
    global _UP, _DOWN
    if len(part) > len(_UP):  # one word longer than a segment
        _UP, _DOWN = _powers(_ODD, len(part)), _powers(pow(_ODD, -1, 1 << 64), len(part))
    inked = ~BLANK[part]
    first = np.flatnonzero(inked & np.concatenate([[True], ~inked[:-1]]))
    if not len(first):
        return first, np.zeros(0, np.uint64)
    sums = np.add.reduceat(_TABLE[part] * _UP[: len(part)], first)
    return first, mix(sums * _DOWN[first])


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of its text). Words are what blanks 09-0D and 20 leave; A-Z count as a-z."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    joined = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    begins = np.cumsum([0] + [len(r) + 1 for r in raw[:-1]]) if raw else np.zeros(0, int)
    starts, hashes, at = [], [], 0
    while at < len(joined):
        end = min(at + SEGMENT, len(joined))
        while not BLANK[joined[end - 1]]:
            tail = np.flatnonzero(BLANK[joined[at:end]])
            if len(tail):
                end = at + int(tail[-1]) + 1
            else:
                end = min(end + SEGMENT, len(joined))
        first, found = _hash_segment(joined[at:end])
        starts.append(first + at)
        hashes.append(found)
        at = end
    starts, hashes = np.concatenate(starts), np.concatenate(hashes)
    return hashes, np.searchsorted(begins, starts, side="right") - 1


def shingle_hashes(words: np.ndarray, owner: np.ndarray, n_texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every run of ``size`` words; a text of fewer words is one shingle, none gives none."""
    per_text = np.bincount(owner, minlength=n_texts)
    rolled = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for i in range(size):
        rolled = rolled * np.uint64(_ODD) + words[i : i + len(rolled)]
    whole = owner[: len(rolled)] == owner[size - 1 : size - 1 + len(rolled)] if len(rolled) else np.zeros(0, bool)
    hashes, owners = [mix(rolled[whole] + np.uint64(size))], [owner[: len(rolled)][whole]]
    short = np.flatnonzero((per_text > 0) & (per_text < size))
    if len(short):
        ends = np.cumsum(per_text)
        one = np.zeros(len(short), np.uint64)
        for i in range(size - 1):
            here = per_text[short] > i
            at = np.minimum(ends[short] - per_text[short] + i, len(words) - 1)
            one = np.where(here, one * np.uint64(_ODD) + words[at], one)
        hashes.append(mix(one + per_text[short].astype(np.uint64)))
        owners.append(short)
    return np.concatenate(hashes), np.concatenate(owners)
