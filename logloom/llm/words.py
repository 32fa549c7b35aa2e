"""Words, hashes and shingles of whole texts, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

# bytes.split() cuts at exactly the bytes 20 and 09-0D, so the words of a text
# are its runs of [^\x20\x09-\x0D]; UTF-8 never uses these bytes otherwise.

_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8; none for a null or blank text."""
    return text.encode("utf-8", "replace").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """The same with A-Z in lower case and all other characters as they are."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def hashes(items: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, items), np.uint64, len(items))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values once more, so that every output bit hangs on every input bit."""
    values = values ^ (values >> np.uint64(31))
    values = values * _MIX
    return values ^ (values >> np.uint64(29))


def window_hashes(hashed: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash per run of ``size`` words; empty if there are fewer words."""
    if len(hashed) < size:
        return np.empty(0, np.uint64)
    count = len(hashed) - size + 1
    out = mixed(hashed[:count])
    for shift in range(1, size):
        out = mixed(out + hashed[shift : shift + count])
    return out


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, a blank one none."""
    hashed = hashes(lower_words(text))
    if not len(hashed):
        return hashed
    return np.unique(window_hashes(hashed, min(size, len(hashed))))
