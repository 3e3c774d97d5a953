"""Words of many texts at once: byte arrays in, keyed 64-bit word and window hashes out.

A word is a maximal run of bytes other than space and 0x09-0x0D, which in UTF-8
is the same as the pattern `[^\\x20\\x09-\\x0D]+`. Words of up to 32 bytes are hashed eight bytes at a
time, each lane multiplied by numbers of the key and mixed; longer ones by keyed BLAKE2b. A key has
two independent sides of 64 bits. A run that draws its own key can not be given words with equal hashes on purpose.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np

SEGMENT = 1 << 18  # bytes hashed at once; sizes the scratch arrays, not the texts
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


SHORT = 32  # bytes of a word that is hashed by lanes
FIXED_KEY = bytes(range(16))  # for hashes that are only features


def lane_numbers(key: bytes, side: int) -> np.ndarray:
    """A start and, for each lane of a short word, an odd factor and an addend."""
    raw = b"".join(hashlib.blake2b(bytes([side, i]), key=key).digest() for i in range(2))
    numbers = np.frombuffer(raw, _U)[:1 + 2 * (SHORT // 8)].copy()
    numbers[1:1 + SHORT // 8] |= _U(1)
    return numbers


_BASES = {0: 0xD6E8FEB86659FD93, 1: 0xA0761D6478BD642F}
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i below n."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        base, inverse = _BASES[which], pow(_BASES[which], -1, 1 << 64)
        size = max(n, 1 << 16)
        have = []
        for b in (base, inverse):
            p = np.full(size, b, _U)
            p[0] = 1
            have.append(np.multiply.accumulate(p))
        if size <= 4 * SEGMENT:  # larger ones are not kept
            _POWERS[which] = tuple(have)
    return have[0][:n], have[1][:n]


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of every word of a byte array."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: bytes = FIXED_KEY, sides: int = 1) -> np.ndarray:
    """64-bit hashes of each byte span ([n], or [n, 2] for both sides); equal for equal bytes wherever they stand."""
    lengths = ends - starts
    lanes = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    out = np.empty((len(starts), sides), _U)
    numbers = [lane_numbers(key, side) for side in range(sides)]
    for side in range(sides):
        out[:, side] = numbers[side][0] + lengths.astype(_U)
    at, left, rows = starts, lengths, np.arange(len(starts))
    for i in range(SHORT // 8):
        if i:
            more = left > 0
            at, left, rows = at[more], left[more], rows[more]
        if not len(rows):
            break
        word = lanes[at] & (_U(0xFFFFFFFFFFFFFFFF) >> (_U(8) * (8 - np.minimum(left, 8)).astype(_U)))
        for side in range(sides):
            factor, addend = numbers[side][1 + i], numbers[side][1 + SHORT // 8 + i]
            with np.errstate(over="ignore"):
                out[rows, side] = mix((out[rows, side] ^ (word + addend)) * factor)
        at, left = at + 8, left - 8
    long = np.flatnonzero(lengths > SHORT)
    if len(long):
        digests = [hashlib.blake2b(data[a:b].tobytes(), key=key, digest_size=16).digest() for a, b in zip(starts[long].tolist(), ends[long].tolist())]
        out[long] = np.frombuffer(b"".join(digests), _U).reshape(-1, 2)[:, :sides]
    return out[:, 0] if sides == 1 else out


def pieces(text: bytes, size: int = SEGMENT) -> Iterator[bytes]:
    """The text cut after white space into parts of about `size` bytes; no word is cut."""
    if len(text) <= size:
        yield text
        return
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        while end < len(text) and text[end - 1] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[at:end]
        at = end


def batches(texts: Iterable[bytes], size: int = SEGMENT) -> Iterator[list[bytes]]:
    """Consecutive texts in lists of about `size` bytes."""
    held, total = [], 0
    for t in texts:
        held.append(t)
        total += len(t) + 1
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def hash_words(texts: list[bytes], key: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of all words of a few texts ([n, 2]), one after the other, and where each text begins (n + 1 entries)."""
    if len(texts) == 1:
        parts = []
        for part in pieces(texts[0]):
            data = np.frombuffer(part, np.uint8)
            parts.append(span_hashes(data, *spans(data), key, 2))
        hashes = np.concatenate(parts)
        return hashes, np.array([0, len(hashes)])
    if max(map(len, texts), default=0) > SEGMENT:
        each = [hash_words([t], key)[0] for t in texts]
        return np.concatenate(each), np.concatenate([[0], np.cumsum([len(h) for h in each])])
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    starts, ends = spans(data)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    return span_hashes(data, starts, ends, key, 2), np.searchsorted(starts, begin)


def window_sums(words: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Sum of `length` consecutive words times powers of a base, from every position of the array; the first word counts once."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, _U)
    up, down = powers(len(words), which)
    sums = np.zeros(len(words) + 1, _U)
    np.cumsum((mix(words ^ _U(0x5851F42D4C957F2D)) if which else words) * up, out=sums[1:])
    return (sums[length:] - sums[:n]) * down[:n]


def window_hashes(words: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of `length` consecutive words from every position of the array (texts are not told apart)."""
    return mix(window_sums(words, length, which))
