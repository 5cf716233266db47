"""Frame sizes and boxes of annotation XML by one scan over the bytes of many texts.

Plain annotations (elements and numbers only, no attribute, entity, comment or declaration) are most
of what there is. Their tags are found in the bytes of a whole batch at once, their nesting is checked
by depth, and only the wanted numbers are read; no tree is built. Any text that is not plainly of that kind is
left to a full parser.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes scanned at a time.
SLICE_BYTES = 1 << 20
ROOT, DEEPEST = b"annotation", 4
BOX = ["xmin", "ymin", "xmax", "ymax"]

_BYTES = np.arange(256)
_NAME = (_BYTES == ord("_")) | np.array([chr(b).isascii() and chr(b).isalnum() for b in _BYTES])
_DIGIT = (_BYTES >= ord("0")) & (_BYTES <= ord("9"))
_SPACE = np.isin(_BYTES, list(b" \t\n\r"))
# Names are compared by their first sixteen bytes; longer ones are left to the parser.
LONGEST = 16
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def _code(name: bytes) -> tuple[int, int]:
    padded = name.ljust(LONGEST, b"\0")
    return int.from_bytes(padded[:8], "little"), int.from_bytes(padded[8:], "little")


def _named(low: np.ndarray, high: np.ndarray, name: str | bytes) -> np.ndarray:
    first, second = _code(name.encode() if isinstance(name, str) else name)
    return (low == first) & (high == second)


def _codes(data: np.ndarray, start: np.ndarray, length: np.ndarray):
    """The first sixteen bytes of names as two numbers."""
    padded = np.concatenate([data, np.zeros(LONGEST, np.uint8)])
    words = np.ndarray(len(data) + LONGEST - 8, "<u8", padded.data, strides=(1,))
    low = words[start] & _MASKS[np.clip(length, 0, 8)]
    high = words[start + 8] & _MASKS[np.clip(length - 8, 0, 8)]
    return low, high


class Tags:
    """The tags of the texts of a slice, and which texts are plain; text t has bytes offsets[t] .. offsets[t + 1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        self.plain = np.ones(n, bool)
        opens, closes = np.flatnonzero(data == ord("<")), np.flatnonzero(data == ord(">"))
        at_open, at_close = np.searchsorted(opens, offsets), np.searchsorted(closes, offsets)
        paired = np.diff(at_open) == np.diff(at_close)
        self.plain &= paired & (np.diff(at_open) > 0)
        # Texts with as many < as >: their tags pair up in order. Others are left out here.
        text = np.repeat(np.arange(n), np.diff(at_open))
        opens = opens[self.plain[text]]
        closes = closes[np.repeat(self.plain, np.diff(at_close))]
        text = text[self.plain[text]]
        self.text, self.start, self.end = text, opens, closes + 1
        same = text[1:] == text[:-1]
        good = closes > opens
        good[:-1] &= (closes[:-1] < opens[1:]) | ~same
        self.spoil(~good)
        self.closing = data[opens + 1] == ord("/")
        name = opens + 1 + self.closing
        length = closes - name
        self.spoil((length <= 0) | (length > LONGEST))
        outside = np.concatenate([[0], np.cumsum(~_NAME[data])])
        self.spoil(outside[np.maximum(closes, name)] != outside[name])
        self.low, self.high = _codes(data, name, np.clip(length, 0, LONGEST))
        # Depths: of an opening tag inside it, of a closing one before it.
        first = np.searchsorted(text, np.arange(n))
        depth = np.concatenate([[0], np.cumsum(np.where(self.closing, -1, 1))])
        base = depth[first[text]]
        self.level = depth[1:] - base + self.closing
        self.spoil((self.level < 1) | (self.level > DEEPEST))
        last = np.append(~same, True) if len(text) else same
        ends = np.flatnonzero(last)
        self.spoil_texts(text[ends[depth[ends + 1] != base[ends]]])
        # A closing tag names the element that was opened last on its level; the root is the only one on the first.
        index = np.arange(len(text))
        self.owner = np.zeros((DEEPEST + 1, len(text)), np.int64)
        for level in range(1, DEEPEST + 1):
            here = ~self.closing & (self.level == level)
            self.owner[level] = np.maximum.accumulate(np.where(here, index, 0)) if len(text) else index
        opened = self.owner[np.clip(self.level, 1, DEEPEST), index]
        self.spoil(self.closing & ((self.low[opened] != self.low) | (self.high[opened] != self.high)))
        is_first = np.append(True, ~same) if len(text) else same
        root = ~self.closing & (self.level == 1)
        self.spoil(root != is_first)
        self.spoil(is_first & ~_named(self.low, self.high, ROOT))
        # Only white space around the root, and no entity anywhere.
        solid = np.concatenate([[0], np.cumsum(~_SPACE[data])])
        self.spoil(is_first & (solid[opens] != solid[offsets[text]]))
        self.spoil(last & (solid[offsets[text + 1]] != solid[self.end]))
        self.spoil_texts(np.searchsorted(offsets, np.flatnonzero(data == ord("&")), "right") - 1)

    def spoil(self, tags: np.ndarray) -> None:
        """Texts of these tags are not plain."""
        self.spoil_texts(self.text[tags])

    def spoil_texts(self, texts: np.ndarray) -> None:
        self.plain[texts] = False

    def elements(self, level: int, name: str, inside: np.ndarray | None = None) -> np.ndarray:
        """Opening tags of a name on a level, in one of the elements `inside` of the level above."""
        found = ~self.closing & (self.level == level) & _named(self.low, self.high, name)
        if inside is not None:
            parent = np.zeros(len(found), bool)
            parent[inside] = True
            found &= parent[self.owner[level - 1]]
        return np.flatnonzero(found)

    def once(self, tags: np.ndarray, owner: np.ndarray) -> None:
        """Texts that have two of these elements in one owner are not plain."""
        again = owner[1:] == owner[:-1]
        self.spoil(tags[1:][again])

    def numbers(self, data: np.ndarray, tags: np.ndarray) -> np.ndarray:
        """The numbers that elements hold; texts where one holds anything but a plain number are not plain."""
        after = np.minimum(tags + 1, len(self.text) - 1)
        start, stop = self.end[tags], self.start[after]
        good = self.closing[after] & (after > tags) & (stop > start) & (stop - start <= LONGEST)
        digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
        dots = np.concatenate([[0], np.cumsum(data == ord("."))])
        stop = np.maximum(stop, start)
        n_digits, n_dots = digits[stop] - digits[start], dots[stop] - dots[start]
        good &= (n_digits + n_dots == stop - start) & (n_digits > 0) & (n_dots <= 1)
        self.spoil(tags[~good])
        out = np.zeros(len(tags))
        start, stop = start[good], stop[good]
        if len(start):
            cuts = np.zeros(len(start) + 1, np.int32)
            np.cumsum(stop - start, out=cuts[1:])
            body = data[np.repeat(start - cuts[:-1], stop - start) + np.arange(cuts[-1])]
            texts = pa.StringArray.from_buffers(len(start), pa.py_buffer(cuts), pa.py_buffer(body))
            out[good] = pc.cast(texts, pa.float64()).to_numpy()
        return out


def _scanned(data: np.ndarray, offsets: np.ndarray):
    """(plain, width, height, boxes per text, box corners) of the texts of a slice."""
    tags = Tags(data, offsets)
    n = len(offsets) - 1
    sizes = tags.elements(2, "size")
    tags.once(sizes, tags.text[sizes])
    sides = []
    for name in ("width", "height"):
        found = tags.elements(3, name, sizes)
        tags.once(found, tags.text[found])
        side = np.zeros(n)
        side[tags.text[found]] = tags.numbers(data, found)
        tags.spoil_texts(np.flatnonzero(side >= 1 << 31))
        sides.append(side)
    objects = tags.elements(2, "object")
    boxes = tags.elements(3, "bndbox", objects)
    tags.once(boxes, tags.owner[2][boxes])
    place = np.zeros(len(tags.text), np.int64)
    place[boxes] = np.arange(len(boxes))
    corners = np.zeros((len(boxes), len(BOX)))
    for k, name in enumerate(BOX):
        found = tags.elements(4, name, boxes)
        owner = tags.owner[3][found]
        tags.once(found, owner)
        corners[place[owner], k] = tags.numbers(data, found)
    kept = tags.plain[tags.text[boxes]]
    per_text = np.bincount(tags.text[boxes][kept], minlength=n)
    return tags.plain, sides[0], sides[1], per_text, corners[kept]


BOXED = pa.struct([(name, pa.float64()) for name in BOX])


def scan_annotations(texts: pa.Array) -> pa.Array:
    """Structs (plain, width, height, bbox) of annotations; of texts that are not plain only that is known."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    plain, width, height = np.zeros(n, bool), np.zeros(n, np.int32), np.zeros(n, np.int32)
    counts, corners, row = np.zeros(n, np.int64), [np.zeros((0, len(BOX)))], 0
    while row < n:
        end = min(max(int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1, row + 1), n)
        # Empty texts share their place with the next one and are not plain.
        full = row + np.flatnonzero(np.diff(offsets[row : end + 1]))
        if len(full):
            part = data[offsets[row] : offsets[end]]
            found = _scanned(part, np.append(offsets[full], offsets[end]) - offsets[row])
            plain[full] = found[0]
            width[full], height[full] = (np.where(found[0], side, 0).astype(np.int32) for side in found[1:3])
            counts[full] = found[3]
            corners.append(found[4])
        row = end
    corners = np.concatenate(corners)
    boxes = pa.StructArray.from_arrays([pa.array(corners[:, k]) for k in range(len(BOX))], fields=list(BOXED))
    cuts = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    columns = [pa.array(plain), pa.array(width), pa.array(height), pa.ListArray.from_arrays(cuts, boxes)]
    return pa.StructArray.from_arrays(columns, ["plain", "width", "height", "bbox"])
