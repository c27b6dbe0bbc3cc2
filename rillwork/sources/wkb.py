"""Decoding of well-known binary geometries and of the container blobs that wrap them."""

from __future__ import annotations

import struct

#: Bytes of the envelope in a container blob, by its code in the flags.
_ENVELOPE = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}


def _unwrapped(blob: bytes) -> bytes:
    """The geometry inside a GeoPackage blob; anything else as it is."""
    if blob[:2] != b"GP":
        return blob
    return blob[8 + _ENVELOPE.get((blob[3] >> 1) & 7, 0) :]


def decode(blob: bytes | None) -> tuple[str, list] | None:
    """(kind, rings): a point as [[(x, y, z)]], a line as one ring, parts of multi geometries and rings of polygons as further ones.

    z is None for plane geometries. NULL, empty or cut-off blobs give None.
    """
    if not blob or (blob[:2] == b"GP" and blob[3] & 0x10):
        return None
    try:
        kind, parts, _ = _read(_unwrapped(bytes(blob)), 0)
    except (struct.error, ValueError, IndexError):
        return None
    return kind, parts


def _read(b: bytes, at: int) -> tuple[str, list, int]:
    order = "<" if b[at] else ">"
    (code,) = struct.unpack_from(order + "I", b, at + 1)
    at += 5
    has_z = bool(code & 0x80000000) or (code % 10000) // 1000 in (1, 3)
    has_m = bool(code & 0x40000000) or (code % 10000) // 1000 in (2, 3)
    if code & 0x20000000:
        at += 4
    base = (code & 0x0FFFFFFF) % 1000
    dims = 2 + has_z + has_m

    def points(n: int, at: int) -> tuple[list, int]:
        flat = struct.unpack_from(f"{order}{n * dims}d", b, at)
        return [(flat[k], flat[k + 1], flat[k + 2] if has_z else None) for k in range(0, n * dims, dims)], at + 8 * n * dims

    def count(at: int) -> tuple[int, int]:
        return struct.unpack_from(order + "I", b, at)[0], at + 4

    if base == 1:
        p, at = points(1, at)
        return "point", [p], at
    if base == 2:
        n, at = count(at)
        p, at = points(n, at)
        return "line", [p], at
    if base == 3:
        n, at = count(at)
        rings = []
        for _ in range(n):
            k, at = count(at)
            p, at = points(k, at)
            rings.append(p)
        return "polygon", rings, at
    if base in (4, 5, 6, 7):
        n, at = count(at)
        parts, kind = [], "collection"
        for _ in range(n):
            kind, p, at = _read(b, at)
            parts.extend(p)
        return kind, parts, at
    raise ValueError(f"geometry type {code}")


def encode_line(points: list[tuple[float, float]]) -> bytes:
    return struct.pack("<BII", 1, 2, len(points)) + b"".join(struct.pack("<2d", *p) for p in points)


def encode_point(x: float, y: float, z: float | None = None) -> bytes:
    return struct.pack("<BI2d", 1, 1, x, y) if z is None else struct.pack("<BI3d", 1, 1001, x, y, z)


def wrapped(wkb: bytes, srid: int) -> bytes:
    return b"GP" + struct.pack("<BBi", 0, 1, srid) + wkb
