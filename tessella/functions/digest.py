"""SHA-256 that can be put down and taken up again by another task."""

from __future__ import annotations

import ctypes
import struct

START = (0x6A09E667, 0xBB67AE85, 0x3C6EF372, 0xA54FF53A, 0x510E527F, 0x9B05688C, 0x1F83D9AB, 0x5BE0CD19)


def _roots() -> list[int]:
    """The first 32 bits of the fractions of the cube roots of the first 64 primes."""
    primes = [p for p in range(2, 312) if all(p % q for q in range(2, p))]
    out = []
    for p in primes:
        lo, hi = 0, 1 << 36
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if mid ** 3 <= p << 96 else (lo, mid)
        out.append(lo & 0xFFFFFFFF)
    return out


_K = _roots()


class _Context(ctypes.Structure):
    """OpenSSL's public SHA256_CTX."""
    _fields_ = [("h", ctypes.c_uint32 * 8), ("low", ctypes.c_uint32), ("high", ctypes.c_uint32),
                ("data", ctypes.c_uint32 * 16), ("num", ctypes.c_uint), ("length", ctypes.c_uint)]


def _library():
    """The OpenSSL that hashlib itself is linked to, where its functions can be called."""
    try:
        import _hashlib
        lib = ctypes.CDLL(_hashlib.__file__)
        lib.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
        return lib
    except (ImportError, OSError, AttributeError):
        return None


_LIB = _library()


def _blocks(h: tuple[int, ...], data: bytes) -> tuple[int, ...]:
    """The plain rounds, for a Python without OpenSSL."""
    m = 0xFFFFFFFF
    for at in range(0, len(data), 64):
        w = list(struct.unpack_from(">16I", data, at))
        for t in range(16, 64):
            x, y = w[t - 15], w[t - 2]
            s0 = (x >> 7 | x << 25) ^ (x >> 18 | x << 14) ^ x >> 3
            s1 = (y >> 17 | y << 15) ^ (y >> 19 | y << 13) ^ y >> 10
            w.append(w[t - 16] + (s0 & m) + w[t - 7] + (s1 & m) & m)
        a, b, c, d, e, f, g, i = h
        for t in range(64):
            s1 = ((e >> 6 | e << 26) ^ (e >> 11 | e << 21) ^ (e >> 25 | e << 7)) & m
            one = i + s1 + (e & f ^ ~e & m & g) + _K[t] + w[t]
            s0 = ((a >> 2 | a << 30) ^ (a >> 13 | a << 19) ^ (a >> 22 | a << 10)) & m
            a, b, c, d, e, f, g, i = one + s0 + (a & b ^ a & c ^ b & c) & m, a, b, c, d + one & m, e, f, g
        h = tuple(x + y & m for x, y in zip(h, (a, b, c, d, e, f, g, i), strict=True))
    return h


class Sha256:
    """``state`` is all that another instance needs to go on: chaining values, length, and the bytes of an open block."""

    def __init__(self, state: bytes | None = None):
        state = state or struct.pack(">8IQ", *START, 0)
        self.h, self.length, self.rest = struct.unpack_from(">8I", state), struct.unpack_from(">Q", state, 32)[0], state[40:]

    def update(self, data: bytes) -> None:
        whole = self.rest + data
        cut = len(whole) - len(whole) % 64
        self.length, self.rest = self.length + len(data), whole[cut:]
        if cut and _LIB is not None:
            c = _Context((ctypes.c_uint32 * 8)(*self.h), length=32)
            _LIB.SHA256_Update(ctypes.byref(c), whole, cut)
            self.h = tuple(c.h)
        elif cut:
            self.h = _blocks(self.h, whole[:cut])

    @property
    def state(self) -> bytes:
        return struct.pack(">8IQ", *self.h, self.length) + self.rest

    def hexdigest(self) -> str:
        end = Sha256(self.state)
        end.update(b"\x80" + bytes((55 - self.length) % 64) + struct.pack(">Q", 8 * self.length))
        return struct.pack(">8I", *end.h).hex()
