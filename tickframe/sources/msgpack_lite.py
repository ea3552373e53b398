"""Minimal MessagePack reader/writer for positional telemetry records.

Runs inside executor Python workers (the ``msgpack`` package is not
available).  Supports the subset the telemetry uses: nil, bool, ints,
float32/64, str, bin, array and map.  ``iter_records`` streams top-level
objects; ``pack`` exists for writing fixtures.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

_U = {0xCC: (">B", 1), 0xCD: (">H", 2), 0xCE: (">I", 4), 0xCF: (">Q", 8)}
_I = {0xD0: (">b", 1), 0xD1: (">h", 2), 0xD2: (">i", 4), 0xD3: (">q", 8)}


class DecodeError(ValueError):
    pass


def _read(buf: memoryview, pos: int):
    if pos >= len(buf):
        raise DecodeError("truncated stream")
    b = buf[pos]
    pos += 1
    if b <= 0x7F:
        return b, pos
    if b >= 0xE0:
        return b - 0x100, pos
    if 0x90 <= b <= 0x9F:
        return _array(buf, pos, b & 0x0F)
    if 0xA0 <= b <= 0xBF:
        n = b & 0x1F
        return _text(buf, pos, n)
    if 0x80 <= b <= 0x8F:
        return _map(buf, pos, b & 0x0F)
    if b == 0xC0:
        return None, pos
    if b == 0xC2:
        return False, pos
    if b == 0xC3:
        return True, pos
    if b in _U or b in _I:
        fmt, n = _U.get(b) or _I[b]
        _need(buf, pos, n)
        return struct.unpack_from(fmt, buf, pos)[0], pos + n
    if b == 0xCA:
        _need(buf, pos, 4)
        return struct.unpack_from(">f", buf, pos)[0], pos + 4
    if b == 0xCB:
        _need(buf, pos, 8)
        return struct.unpack_from(">d", buf, pos)[0], pos + 8
    if b in (0xD9, 0xDA, 0xDB):
        fmt, k = {0xD9: (">B", 1), 0xDA: (">H", 2), 0xDB: (">I", 4)}[b]
        _need(buf, pos, k)
        n = struct.unpack_from(fmt, buf, pos)[0]
        return _text(buf, pos + k, n)
    if b in (0xC4, 0xC5, 0xC6):
        fmt, k = {0xC4: (">B", 1), 0xC5: (">H", 2), 0xC6: (">I", 4)}[b]
        _need(buf, pos, k)
        n = struct.unpack_from(fmt, buf, pos)[0]
        _need(buf, pos + k, n)
        return bytes(buf[pos + k:pos + k + n]), pos + k + n
    if b in (0xDC, 0xDD):
        fmt, k = (">H", 2) if b == 0xDC else (">I", 4)
        _need(buf, pos, k)
        return _array(buf, pos + k, struct.unpack_from(fmt, buf, pos)[0])
    if b in (0xDE, 0xDF):
        fmt, k = (">H", 2) if b == 0xDE else (">I", 4)
        _need(buf, pos, k)
        return _map(buf, pos + k, struct.unpack_from(fmt, buf, pos)[0])
    raise DecodeError(f"unsupported type byte 0x{b:02x}")


def _need(buf, pos, n):
    if pos + n > len(buf):
        raise DecodeError("truncated stream")


def _text(buf, pos, n):
    _need(buf, pos, n)
    return bytes(buf[pos:pos + n]).decode("utf-8"), pos + n


def _array(buf, pos, n):
    out = []
    for _ in range(n):
        v, pos = _read(buf, pos)
        out.append(v)
    return out, pos


def _map(buf, pos, n):
    out = {}
    for _ in range(n):
        k, pos = _read(buf, pos)
        v, pos = _read(buf, pos)
        out[k] = v
    return out, pos


def iter_records(data: bytes) -> Iterator[tuple[object, str | None]]:
    """Yield ``(object, None)`` per top-level object; on a corrupt tail yield
    ``(None, reason)`` once and stop (the rest of the stream is unreadable)."""
    buf = memoryview(data)
    pos = 0
    while pos < len(buf):
        try:
            obj, pos = _read(buf, pos)
        except (DecodeError, UnicodeDecodeError, struct.error) as e:
            yield None, f"decode error at byte {pos}: {e}"
            return
        yield obj, None


def pack(obj) -> bytes:
    """Encode ``obj`` (None/bool/int/float/str/bytes/list/dict)."""
    out = bytearray()
    _pack(obj, out)
    return bytes(out)


def _pack(o, out: bytearray):
    if o is None:
        out.append(0xC0)
    elif o is True:
        out.append(0xC3)
    elif o is False:
        out.append(0xC2)
    elif isinstance(o, int):
        if 0 <= o <= 0x7F:
            out.append(o)
        elif -32 <= o < 0:
            out.append(o + 0x100)
        elif o >= 0:
            out += b"\xcf" + struct.pack(">Q", o)
        else:
            out += b"\xd3" + struct.pack(">q", o)
    elif isinstance(o, float):
        out += b"\xcb" + struct.pack(">d", o)
    elif isinstance(o, str):
        data = o.encode("utf-8")
        out += b"\xdb" + struct.pack(">I", len(data)) + data
    elif isinstance(o, (bytes, bytearray)):
        out += b"\xc6" + struct.pack(">I", len(o)) + bytes(o)
    elif isinstance(o, (list, tuple)):
        out += b"\xdd" + struct.pack(">I", len(o))
        for v in o:
            _pack(v, out)
    elif isinstance(o, dict):
        out += b"\xdf" + struct.pack(">I", len(o))
        for k, v in o.items():
            _pack(k, out)
            _pack(v, out)
    else:
        raise TypeError(f"cannot pack {type(o).__name__}")
