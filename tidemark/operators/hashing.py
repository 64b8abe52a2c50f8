"""Spark's xxhash64 of bigint values, for Python code that has to find the same cells as the JVM did."""

from __future__ import annotations

_M = (1 << 64) - 1
# The primes of the XXH64 algorithm.
_P1, _P2, _P3, _P4, _P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5


def _rot(x: int, r: int) -> int:
    return ((x << r) | (x >> (64 - r))) & _M


def _mix(h: int) -> int:
    h = ((h ^ (h >> 33)) * _P2) & _M
    h = ((h ^ (h >> 29)) * _P3) & _M
    return h ^ (h >> 32)


def _long(x: int, seed: int) -> int:
    h = (seed + _P5 + 8) & _M
    h ^= (_rot((x * _P2) & _M, 31) * _P1) & _M
    return _mix((_rot(h, 27) * _P1 + _P4) & _M)


def _int(x: int, seed: int) -> int:
    h = (seed + _P5 + 4) & _M
    h ^= ((x & 0xFFFFFFFF) * _P1) & _M
    return _mix((_rot(h, 23) * _P2 + _P3) & _M)


def xxhash64_longs(values: tuple[int, ...], last: int) -> int:
    """xxhash64(v1, v2, ..., int literal `last`) as a signed bigint."""
    h = 42
    for v in values:
        h = _long(v & _M, h)
    h = _int(last, h)
    return h - (1 << 64) if h >> 63 else h
