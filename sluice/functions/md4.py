"""MD4 (RFC 1320) over a batch of byte strings, vectorised with numpy.

The Python standard library no longer ships MD4 on OpenSSL 3, and Spark has
no built-in for it, so this is the one digest computed in Python. It runs
inside an Arrow-batched pandas UDF: messages of similar length are hashed
together, one numpy operation per MD4 step for the whole group. Memory beyond
the input is two padded copies of at most ``_CHUNK_BYTES`` (or of one message).
"""

from __future__ import annotations

from typing import Sequence

import numpy as np

# Fixed values from RFC 1320: initial state, round constants, shift amounts
# and the message-word order of each round.
INIT_STATE = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
ROUND2_CONST = 0x5A827999
ROUND3_CONST = 0x6ED9EBA1
ROUND1_SHIFTS = (3, 7, 11, 19)
ROUND2_SHIFTS = (3, 5, 9, 13)
ROUND3_SHIFTS = (3, 9, 11, 15)
ROUND1_ORDER = (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
ROUND2_ORDER = (0, 4, 8, 12, 1, 5, 9, 13, 2, 6, 10, 14, 3, 7, 11, 15)
ROUND3_ORDER = (0, 8, 4, 12, 2, 10, 6, 14, 1, 9, 5, 13, 3, 11, 7, 15)

# Upper bound on the padded bytes hashed at once, to keep memory per task flat.
_CHUNK_BYTES = 16 << 20
# Below this many messages numpy's cost per call is larger than plain Python's.
_FEW = 12


def _f(b, c, d, t, u):
    # t = (b & c) | (~b & d)
    np.bitwise_and(b, c, out=t)
    np.invert(b, out=u)
    np.bitwise_and(u, d, out=u)
    np.bitwise_or(t, u, out=t)


def _g(b, c, d, t, u):
    # t = (b & c) | (b & d) | (c & d) == (b & (c | d)) | (c & d)
    np.bitwise_or(c, d, out=t)
    np.bitwise_and(t, b, out=t)
    np.bitwise_and(c, d, out=u)
    np.bitwise_or(t, u, out=t)


def _h(b, c, d, t, u):
    # t = b ^ c ^ d
    np.bitwise_xor(b, c, out=t)
    np.bitwise_xor(t, d, out=t)


_ROUNDS = (
    (_f, 0, ROUND1_ORDER, ROUND1_SHIFTS),
    (_g, ROUND2_CONST, ROUND2_ORDER, ROUND2_SHIFTS),
    (_h, ROUND3_CONST, ROUND3_ORDER, ROUND3_SHIFTS),
)


def _compress(state: list[np.ndarray], words: np.ndarray) -> list[np.ndarray]:
    """One 64-byte block for every row: ``words`` is (16, n) uint32, contiguous.

    All work happens in place in a few row-length buffers, one numpy call
    per bit operation of the round function.
    """
    a, b, c, d = (x.copy() for x in state)
    t = np.empty_like(a)
    u = np.empty_like(a)
    for func, const, order, shifts in _ROUNDS:
        k_const = np.uint32(const)
        for i, k in enumerate(order):
            s = shifts[i % 4]
            func(b, c, d, t, u)
            np.add(t, a, out=t)
            np.add(t, words[k], out=t)
            if const:
                np.add(t, k_const, out=t)
            # rotate left into a's buffer (its old value is used up), then
            # the register just written moves to position b
            np.left_shift(t, np.uint32(s), out=a)
            np.right_shift(t, np.uint32(32 - s), out=u)
            np.bitwise_or(a, u, out=a)
            a, b, c, d = d, a, b, c
    for acc, x in zip((a, b, c, d), state):
        np.add(acc, x, out=acc)
    return [a, b, c, d]


def _digest_group(msgs: list[bytes], nblocks: np.ndarray) -> np.ndarray:
    """(n, 16) uint8 digests of messages in descending order of their blocks.

    One padded buffer holds the messages; each block's words are laid out
    word by word only when the block's turn comes, for the rows that reach so
    far. The last few rows go on without numpy.
    """
    n, width = len(msgs), int(nblocks[0]) * 64
    buf = np.frombuffer(bytearray().join([(m + b"\x80").ljust(width, b"\0") for m in msgs]), dtype="<u4").reshape(n, width // 4)
    bits = np.fromiter((len(m) * 8 for m in msgs), dtype="<u8", count=n)
    buf.view("<u8")[np.arange(n), nblocks * 8 - 1] = bits

    state = [np.full(n, v, dtype=np.uint32) for v in INIT_STATE]
    live_rows = np.searchsorted(-nblocks, -np.arange(width // 64), side="left")  # rows with more than blk blocks
    for blk, live in enumerate(live_rows.tolist()):
        if live < _FEW:
            for i in range(live):
                now = tuple(int(x[i]) for x in state)
                for block in buf[i, blk * 16 : int(nblocks[i]) * 16].reshape(-1, 16):
                    now = _scalar_block(now, block.tolist())
                for x, v in zip(state, now):
                    x[i] = v
            break
        words = np.ascontiguousarray(buf[:live, blk * 16 : blk * 16 + 16].T, dtype=np.uint32)
        for x, v in zip(state, _compress([x[:live] for x in state], words)):
            x[:live] = v
    return np.stack(state, axis=1).astype("<u4").view(np.uint8).reshape(n, 16)


def _scalar_block(state: tuple[int, int, int, int], x: Sequence[int]) -> tuple[int, int, int, int]:
    a, b, c, d = state
    mask = 0xFFFFFFFF
    for rnd, (_, const, order, shifts) in enumerate(_ROUNDS):
        for i, k in enumerate(order):
            f = (b & c) | (~b & d) if rnd == 0 else (b & c) | (b & d) | (c & d) if rnd == 1 else b ^ c ^ d
            t = (a + f + x[k] + const) & mask
            s = shifts[i % 4]
            a, b, c, d = d, ((t << s) | (t >> (32 - s))) & mask, b, c
    return tuple((p + q) & mask for p, q in zip(state, (a, b, c, d)))


def md4_digests(values: Sequence[bytes | None]) -> list[bytes | None]:
    """Raw 16-byte MD4 digests; None stays None."""
    out: list[bytes | None] = [None] * len(values)
    idx = [i for i, v in enumerate(values) if v is not None]
    idx.sort(key=lambda i: -len(values[i]))
    nblocks = np.fromiter(((len(values[i]) + 72) // 64 for i in idx), dtype=np.int64, count=len(idx))
    s = 0
    while s < len(idx):
        e = s + max(1, _CHUNK_BYTES // (int(nblocks[s]) * 64))
        part = idx[s:e]
        for i, dgst in zip(part, _digest_group([values[i] for i in part], nblocks[s:e])):
            out[i] = dgst.tobytes()
        s = e
    return out


def md4_hex(values: Sequence[str | bytes | None], encoding: str = "utf-8") -> list[str | None]:
    """Lower-case hex MD4 of each value; text is hashed as its UTF-8 bytes."""
    raw = [v.encode(encoding) if isinstance(v, str) else v for v in values]
    return [None if d is None else d.hex() for d in md4_digests(raw)]
