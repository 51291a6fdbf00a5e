"""64-bit hashes of words, shingles and windows, whole batches at a time in numpy.

Words are runs of bytes other than ASCII white space (0x20, 0x09-0x0D); UTF-8 bytes of
other characters belong to words. Equal words have equal hashes; two different ones
share a hash with a chance of about 2^-64.
"""

import re

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SLICE = 1 << 20  # bytes hashed at once, so that memory doesn't follow the longest text
_GAP = re.compile(rb"[ \t-\r]")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, size: int) -> np.ndarray:
    """Fixed pseudo-random uint64 values, the same everywhere."""
    steps = np.arange(1, size + 1, dtype=np.uint64)
    return mix(np.uint64(seed) + steps * np.uint64(0x9E3779B97F4A7C15))


_BYTES = stream(11, 256)


def _slices(text: bytes):
    at = 0
    while len(text) - at > SLICE:
        gap = _GAP.search(text, at + SLICE)
        if not gap:
            break
        yield text[at:gap.start()]
        at = gap.end()
    yield text[at:]


def _hashes(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~SPACE[buffer]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    firsts = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(firsts, sizes)
    factors = stream(23, int(sizes.max())) | np.uint64(1)
    parts = _BYTES[buffer[inside]] * factors[place]
    return starts, mix(np.add.reduceat(parts, firsts) + sizes.astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text."""
    found, counts = [], np.zeros(len(texts), np.int64)
    row = 0
    while row < len(texts):
        group, size = [], 0
        while row + len(group) < len(texts) and (not group or size < SLICE):
            group.append(texts[row + len(group)])
            size += len(group[-1]) + 1
        if len(group) == 1 and size > SLICE:
            for piece in _slices(group[0]):
                hashes = _hashes(np.frombuffer(piece, np.uint8))[1]
                found.append(hashes)
                counts[row] += len(hashes)
        else:
            starts, hashes = _hashes(np.frombuffer(b" ".join(group), np.uint8))
            begins = np.cumsum([0, *(len(x) + 1 for x in group)])
            counts[row:row + len(group)] = np.diff(np.searchsorted(starts, begins))
            found.append(hashes)
        row += len(group)
    return (np.concatenate(found) if found else np.empty(0, np.uint64)), counts


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct sorted hashes of ``size`` consecutive words; of all, if there are fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for place in range(size):
        total = mix(total + words[place:place + len(total)])
    return np.unique(total)


class Windows:
    """Hashes of any windows of one text's words, from prefix sums."""

    BASE = 0x9E3779B97F4A7C15
    _powers = np.ones((2, 1), np.uint64)  # of BASE and of its inverse, as long as ever needed

    @classmethod
    def powers(cls, size: int) -> np.ndarray:
        if cls._powers.shape[1] < size:
            steps = np.ones((2, 2 * size), np.uint64)
            steps[0, 1:], steps[1, 1:] = cls.BASE, pow(cls.BASE, -1, 1 << 64)
            cls._powers = np.cumprod(steps, axis=1, dtype=np.uint64)
        return cls._powers

    def __init__(self, words: np.ndarray):
        power, self.back = self.powers(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * power[:len(words)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mix(value + (ends - starts).astype(np.uint64))
