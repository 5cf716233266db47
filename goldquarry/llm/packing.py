"""Packing of tokenised documents into sequences of a fixed length, best fit decreasing.

Overlong documents are cut into full windows and a rest. Best-fit decreasing looks at lengths only,
so it is planned once for the whole corpus from the number of pieces per length: at most as many
numbers as a sequence has tokens, whatever the corpus size. The plan says which ranks of a length
go to which sequences; pieces are ranked in parallel within hash slices of their length, so a length
that a third of the pieces share is spread as well.
"""

import re
import zlib
from bisect import bisect_right
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from goldquarry.llm.common import parts_for, small_batches, stage
from goldquarry.llm.kernels import cached

END_OF_TEXT = "<|endoftext|>"
# Texts are cut before white space after so many characters: no token of the vocabulary's pattern
# holds white space behind another character, so the ids stay the same and memory stays bounded.
CUT_CHARS = 1 << 20
SLICE_ROWS = 100_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


# Runs of white space so long that the fast encoder's pattern would need too deep a stack.
LONG_SPACE = re.compile(r"\s{20000}")


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return cached(("tokenizer", path), lambda: Tokenizer.from_file(path))


def _encoder(path: str):
    """A faster encoder with the vocabulary of the tokenizer's file; ids are the ranks of a byte-level BPE's merges."""
    import public_tokenizers
    import tiktoken

    def build():
        vocabulary, alphabet = _tokenizer(path).get_vocab(with_added_tokens=False), byte_alphabet()
        ranks = {bytes(map(alphabet.__getitem__, token)): i for token, i in vocabulary.items() if token != END_OF_TEXT}
        return tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens={END_OF_TEXT: len(ranks)},
        )

    return cached(("encoder", path), build)


def _blank(c: str) -> bool:
    """White space as the vocabulary's pattern has it: without the separators U+001C to U+001F."""
    return c.isspace() and not "\x1c" <= c <= "\x1f"


def _cuts(text: str):
    start = 0
    while len(text) - start > CUT_CHARS:
        end = start + CUT_CHARS
        while end < len(text) and not (_blank(text[end]) and not _blank(text[end - 1])):
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of a text, the end-of-text string read as its special token, then id 0."""
    encoder = _encoder(path)

    def encode(part):
        if LONG_SPACE.search(part):
            return np.array(_tokenizer(path).encode(part, add_special_tokens=False).ids, np.uint32)
        return np.asarray(encoder.encode_to_numpy(part, allowed_special="all"), np.uint32)

    return np.concatenate([*(encode(part) for part in _cuts(text) if part), np.zeros(1, np.uint32)])


def tokenize(docs: DataFrame, vocabulary: str, window: int, doc="doc_id", text="text", keep_ids=False) -> DataFrame:
    """Pieces of at most `window` ids: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, the ids.

    Every document has its ids and a closing 0, so an empty or null text is a piece of one id.
    """

    def pieces(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = {name: [] for name in ("doc", "start", "length", "crc", "tokens", "ids")}
                for key, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = token_ids(value or "", vocabulary).astype("<u4", copy=False)
                    for start in range(0, len(ids), window):
                        piece = ids[start : start + window]
                        out["doc"].append(key)
                        out["start"].append(start)
                        out["length"].append(len(piece))
                        out["crc"].append(zlib.crc32(piece))
                        out["tokens"].append(len(ids))
                        if keep_ids:
                            out["ids"].append(piece.tobytes())
                columns = [pa.array(out[n], pa.int64()) for n in ("doc", "start", "length", "crc", "tokens")]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    columns, names = [*columns, pa.array(out["ids"], pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(pieces, PIECES + (", ids binary" if keep_ids else ""))


class OpenWindows:
    """Segment tree over remaining capacities: how many windows are open at each."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.size)

    def add(self, remaining: int, n: int) -> None:
        at = remaining + self.size
        while at:
            self.counts[at] += n
            at //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity of at least `least` that an open window has."""
        at = least + self.size
        if self.counts[at]:
            return least
        while at > 1 and (at % 2 or not self.counts[at + 1]):
            at //= 2
        if at == 1:
            return None
        at += 1
        while at < self.size:
            at = 2 * at if self.counts[2 * at] else 2 * at + 1
        return at - self.size


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple]:
    """Best-fit decreasing for counts of piece lengths.

    Entries (length, first rank, pieces, first window, pieces per window, offset, ids in each window
    at the end). All pieces of a length are placed at once: the tightest open window takes as many
    as fit before the next is used, exactly as one by one. A window that takes a length keeps less
    than half of its room, so a range of windows is used at most log2(capacity) times, and at most
    three ranges arise per length: the plan's size depends on the capacity alone.
    """
    tree, ranges = OpenWindows(capacity), {r: deque() for r in range(capacity + 1)}
    placed, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                each = room // length
                first, n = opened, -(-left // each)
                opened += n
            else:
                each = room // length
                first, have = ranges[room].popleft()
                n = min(have, -(-left // each))
                if have > n:
                    ranges[room].appendleft((first + n, have - n))
                tree.add(room, -n)
            full = min(n, left // each)
            for start, windows, pieces in ((first, full, each), (first + full, n - full, left - full * each)):
                if windows:
                    placed.append((length, rank, windows * pieces, start, pieces, capacity - room))
                    rank, left = rank + windows * pieces, left - windows * pieces
                    rest = room - pieces * length
                    ranges[rest].append((start, windows))
                    tree.add(rest, windows)
    final = sorted((start, n, capacity - room) for room, group in ranges.items() for start, n in group)
    starts = [f[0] for f in final]
    plan = []
    for length, rank, pieces, first, each, offset in placed:
        end = first + pieces // each
        at = bisect_right(starts, first) - 1
        while first < end:
            n = min(end, final[at][0] + final[at][1]) - first
            plan.append((length, rank, n * each, first, each, offset, final[at][2]))
            rank, first, at = rank + n * each, first + n, at + 1
    return plan


def _ranked(pieces: DataFrame, total: int) -> DataFrame:
    """Rank of each piece among those of its length, counted by hash slices."""
    slices = parts_for(pieces, total, SLICE_ROWS)
    keyed = pieces.withColumn("slice", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(slices)))
    sizes = keyed.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "slice").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = keyed.withColumn("inside", F.row_number().over(inside) - 1)
    return (
        ranked.join(starts, ["length", "slice"])
        .withColumn("rank", F.col("before") + F.col("inside"))
        .drop("slice", "inside", "before")
    )


def pack(
    docs: DataFrame, vocabulary: str, window: int = 1024, doc="doc_id", text="text", keep_ids=False
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length.

    `vocabulary` is the `tokenizers` file of a byte-level BPE. Sequences hold at most `window` ids; offsets are
    gapless from 0. padded_length is `window`, or the sequence's own length where that is a power of
    two. Null and empty texts give one piece of one id; repeated rows are separate documents; an
    empty table gives no rows; other columns are ignored. With keep_ids, `ids` holds the piece's ids
    as little-endian unsigned 32-bit numbers.
    """
    small_batches(docs.sparkSession)
    pieces = stage(tokenize(docs, vocabulary, window, doc, text, keep_ids), "pieces")
    # One number per length: at most `window` rows.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = np.array(sorted(best_fit_plan(counts, window)), np.int64).reshape(-1, 7)
    keys = plan[:, 0] << 48 | plan[:, 1]

    def assign(batches):
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            row = plan[np.searchsorted(keys, length << 48 | rank, "right") - 1]
            at = rank - row[:, 1]
            used = row[:, 6]
            columns = {
                "sequence_id": row[:, 3] + at // row[:, 4],
                "offset": row[:, 5] + at % row[:, 4] * length,
                "padded_length": np.where(used & (used - 1) == 0, used, window),
            }
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in kept] + [pa.array(c, pa.int64()) for c in columns.values()],
                names=[*kept, *columns],
            )

    schema = PIECES + (", ids binary" if keep_ids else "") + ", sequence_id long, offset long, padded_length long"
    ranked = _ranked(pieces, sum(counts.values()))
    return ranked.select(*pieces.columns, "rank").mapInArrow(assign, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves from pieces with ids: sequence_id, ids (zero-padded), n_ids, n_pieces.

    A sequence has at most `window` ids, so its pieces are a bounded group.
    """
    parts = F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: F.hex(p["ids"]))
    # Eight hexadecimal digits are one id.
    return packed.groupBy("sequence_id").agg(
        F.unhex(F.rpad(F.array_join(parts, ""), F.first("padded_length").cast("int") * 8, F.lit("0"))).alias("ids"),
        F.sum("length").alias("n_ids"),
        F.count(F.lit(1)).alias("n_pieces"),
    )
