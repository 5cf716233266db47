"""Picture sizes from file headers: no pixel is decoded.

A JPEG is walked from marker to marker to its start-of-frame segment, which holds the size; a PNG has it
in its first chunk. A file that ends before its end mark was cut off.
"""

import struct

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

# Bytes from either end of a file that are looked at first; a longer JPEG header is looked up in the whole file.
HEAD_BYTES, TAIL_BYTES = 1 << 16, 1 << 10

# Fixed values of the formats: marks at the start and the end, and JPEG markers by their second byte.
PNG_START, PNG_END = b"\x89PNG\r\n\x1a\n", b"IEND\xaeB`\x82"
JPEG_START, JPEG_END = b"\xff\xd8", b"\xff\xd9"
START_OF_FRAME = {0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF}
WITHOUT_LENGTH = {0x01, *range(0xD0, 0xD8)}
END_OF_IMAGE, START_OF_SCAN = 0xD9, 0xDA

SIZE = T.StructType().add("width", "integer").add("height", "integer").add("cut", "boolean")
NO_IMAGE = (0, 0, False)


def jpeg_size(head: bytes) -> tuple[int, int, bool]:
    """(width, height, whether the header goes on behind `head`); zeros if there is no size."""
    at = len(JPEG_START)
    while at + 4 <= len(head):
        if head[at] != 0xFF:
            return NO_IMAGE
        marker = head[at + 1]
        if marker == 0xFF:  # padding
            at += 1
        elif marker in WITHOUT_LENGTH:
            at += 2
        elif marker in (END_OF_IMAGE, START_OF_SCAN):
            return NO_IMAGE
        else:
            (length,) = struct.unpack_from(">H", head, at + 2)
            if marker in START_OF_FRAME:
                if at + 9 > len(head):
                    break
                height, width = struct.unpack_from(">HH", head, at + 5)
                return (width, height, False) if width and height else NO_IMAGE
            if length < 2:
                return NO_IMAGE
            at += 2 + length
    return 0, 0, True


def picture_size(head: bytes, tail: bytes) -> tuple[int, int, bool]:
    """(width, height, whether more of the file is needed) from the first and the last bytes; zeros if unreadable."""
    if head.startswith(PNG_START):
        if len(head) < 24 or head[12:16] != b"IHDR" or PNG_END not in tail:
            return NO_IMAGE
        width, height = struct.unpack_from(">II", head, 16)
        return (width, height, False) if 0 < width < 1 << 31 and 0 < height < 1 << 31 else NO_IMAGE
    if head.startswith(JPEG_START) and JPEG_END in tail:
        return jpeg_size(head)
    return NO_IMAGE


@F.arrow_udf(SIZE)
def _sizes(heads: pa.Array, tails: pa.Array) -> pa.Array:
    found = [
        NO_IMAGE if head is None else picture_size(head, tail) for head, tail in zip(heads.to_pylist(), tails.to_pylist())
    ]
    columns = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.bool_()))]
    return pa.StructArray.from_arrays(columns, ["width", "height", "cut"])


def header_size(content: Column) -> Column:
    """(width, height, cut) of a file's content from its ends; `cut` asks for `whole_size`."""
    return _sizes(F.substring(content, 1, HEAD_BYTES), F.substring(content, -TAIL_BYTES, TAIL_BYTES))


def whole_size(content: Column) -> Column:
    """As `header_size`, from the whole content."""
    return _sizes(content, F.substring(content, -TAIL_BYTES, TAIL_BYTES))
