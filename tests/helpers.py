"""Helpers that several test modules import."""

import struct
import zlib


def png(width, height, pixel):
    """PNG bytes; pixel(x, y) gives (red, green, blue)."""
    rows = b"".join(
        b"\0" + bytes(v for x in range(width) for v in pixel(x, y)) for y in range(height)
    )
    chunk = lambda kind, data: (
        struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    )
    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", header)
        + chunk(b"IDAT", zlib.compress(rows))
        + chunk(b"IEND", b"")
    )


def rows(df, *columns):
    """Sorted tuples of a result."""
    columns = columns or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
