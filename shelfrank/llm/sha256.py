"""SHA-256 over many lanes at once with states that can be stored and resumed.

hashlib can copy a running hash but not write it to a table. Here the state
between blocks is an array of eight words a lane, so a Merkle parent keeps the
state before each child slot as 32 bytes, and another task resumes it. A child
enters its parent as 64 hex digits, which is one block of SHA-256.
"""

from __future__ import annotations

import numpy as np

from shelfrank.llm.common import ship

ship(__name__)

BLOCK = 64


def _primes(n: int) -> list[int]:
    found: list[int] = []
    x = 2
    while len(found) < n:
        if all(x % p for p in found):
            found.append(x)
        x += 1
    return found


def _root_bits(p: int, degree: int) -> int:
    """The first 32 bits of the fraction of the degree-th root of p."""
    target = p << (32 * degree)
    low, high = 0, 1 << 40
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if mid**degree <= target else (low, mid)
    return low & 0xFFFFFFFF


_K = [np.uint32(_root_bits(p, 3)) for p in _primes(64)]
START = np.array([_root_bits(p, 2) for p in _primes(8)], np.uint32)
#: The four hex digits of each 16-bit number, as one big-endian word.
_HEX = np.frombuffer("".join(f"{i:04x}" for i in range(1 << 16)).encode(), ">u4").astype(np.uint32)


def start(lanes: int) -> np.ndarray:
    return np.repeat(START[None, :], lanes, 0)


def _rotated(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def advance(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """States (lanes, 8) after one block (lanes, 16) of big-endian words."""
    w = list(np.ascontiguousarray(block.T))
    a, b, c, d, e, f, g, h = np.ascontiguousarray(state.T)
    with np.errstate(over="ignore"):
        for i in range(64):
            if i >= 16:
                x, y = w[i - 15], w[i - 2]
                s0 = _rotated(x, 7) ^ _rotated(x, 18) ^ (x >> np.uint32(3))
                s1 = _rotated(y, 17) ^ _rotated(y, 19) ^ (y >> np.uint32(10))
                w.append(w[i - 16] + s0 + w[i - 7] + s1)
            t = h + (_rotated(e, 6) ^ _rotated(e, 11) ^ _rotated(e, 25)) + (g ^ (e & (f ^ g))) + _K[i] + w[i]
            u = (_rotated(a, 2) ^ _rotated(a, 13) ^ _rotated(a, 22)) + ((a & b) | (c & (a | b)))
            a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
        return state + np.stack([a, b, c, d, e, f, g, h], 1)


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (lanes, 8) of messages of so many whole blocks each."""
    last = np.zeros((len(state), 16), np.uint32)
    last[:, 0] = 1 << 31
    bits = blocks.astype(np.uint64) * np.uint64(8 * BLOCK)
    last[:, 14] = bits >> np.uint64(32)
    last[:, 15] = bits & np.uint64(0xFFFFFFFF)
    return advance(state, last)


def as_block(digest: np.ndarray) -> np.ndarray:
    """The block (lanes, 16) that the hex digits of digests (lanes, 8) make."""
    out = np.empty((len(digest), 16), np.uint32)
    out[:, 0::2] = _HEX[digest >> np.uint32(16)]
    out[:, 1::2] = _HEX[digest & np.uint32(0xFFFF)]
    return out


def to_bytes(words: np.ndarray) -> bytes:
    return words.astype(">u4").tobytes()


def from_bytes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, ">u4").astype(np.uint32).reshape(-1, 8)


def hexes(digest: np.ndarray) -> list[str]:
    raw = to_bytes(digest).hex()
    return [raw[i : i + 64] for i in range(0, len(raw), 64)]
