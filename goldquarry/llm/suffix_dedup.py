"""Exact removal of repeated byte strings, by run-length suffix indexes over shared passages.

A string of 50 bytes goes with the smallest hash of its 16-byte grams, so all copies of it meet in
one place. Neighbouring strings with the same smallest gram are one passage of 50 to 84 bytes:

1. Tasks cut texts into passages and keep, of equal ones, those of the smallest document; the rest
   is removed at once. So a passage that a third of the documents share is sent once per task.
2. Equal passages meet by hash; all but those of the smallest document are removed. Passages that
   share their smallest gram only (the edges of repeated text) are looked at as strings:
3. A gram's passages meet again with their bytes. Of the 34 other bytes of a common string, 17 or more
   lie on one side of the gram, so the passages of a very common gram are grouped by the gram and the
   17 bytes before it, and by the gram and the 17 bytes after it. Passages are trimmed to the strings
   that another document of their group has, by hash, and equal ones go but for the first. What is
   left is indexed by run-compressed Burrows-Wheeler transforms, and later documents' passages are
   streamed against those of earlier ones: one index per binary digit of the documents' order holds
   the passages with digit 0 for those with digit 1, so every passage meets all earlier ones only.

4. Passages of a gram that a task has often, or that very many have, don't meet by gram: it would be one
   group that grows with the corpus. Each of their 50-byte windows meets alone, by its hash, after tasks have
   kept those of their smallest document. A task that sends a gram this way says so where the gram's other
   passages meet, and they follow.

Arrays travel as binary columns, a row for each task and bucket, and texts travel compressed. Equal strings are found by 64-bit
hashes in the second and fourth step and by their bytes in the third.
"""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from goldquarry.llm.blobs import DEALT, dealt, doc_bucket, pack_columns, packed_texts, unpack_columns
from goldquarry.llm.common import freed_stage, parts_for, small_batches
from goldquarry.llm.kernels import SLICE_BYTES, Rolling, U64, merged, mix, ranges, run_ends, sliding_min, text_slices
from goldquarry.llm.run_index import RunIndex, ragged

MATCH_BYTES = 50
GRAM_BYTES = 16
GRAMS = MATCH_BYTES - GRAM_BYTES + 1
# Passages a task holds before it sends them on, and bytes of text per bucket.
HELD = 1 << 17
BUCKET_BYTES = 8 << 20
# Symbols of one index.
INDEX_SYMBOLS = 200_000
PLACE_BITS = U64(30)

SIDE_BYTES = GRAMS // 2
# Passages of one gram from which on it is grouped by its sides as well.
COMMON_GRAM = 500
# Passages of one gram in a task's chunk, and in all, from which on its windows meet one by one.
OFTEN, VERY_COMMON = 16, 5000
# Patterns streamed at once.
STREAMED = 20_000

# A row is named by its doc_id and a checksum of its text, should a doc_id occur with several texts.
OWNER = [("doc", "<i8"), ("crc", "<u4")]
PASSAGE = np.dtype([("gram", "<u4"), ("string", "<u8"), *OWNER, ("start", "<i4"), ("length", "u1")])
SPAN = np.dtype([*OWNER, ("start", "<i4"), ("length", "<i4")])
EDGE = np.dtype([*OWNER, ("start", "<i4"), ("length", "u1"), ("common", "u1")])
# The same within the row of their owner.
OWN_SPAN = np.dtype(SPAN.descr[len(OWNER) :])
OWN_EDGE = np.dtype(EDGE.descr[len(OWNER) :])
# What an edge meets by: its gram, the gram and a side of it, or each of its windows.
BY_GRAM, BY_SIDE, BY_WINDOW = 0, 1, 2
WINDOW = np.dtype([("hash", "<u8"), *OWNER, ("start", "<i4")])
SIDED = np.dtype([("side", "<u8"), *OWNER, ("start", "<i4"), ("length", "u1")])


def passages(data: np.ndarray, offsets: np.ndarray):
    """Passages of the texts of a slice: text, start, end, the hash of the gram, the hash of the string."""
    rolling = Rolling(data)
    grams = rolling.windows(GRAM_BYTES)
    n = len(data) - MATCH_BYTES + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.view(U64), empty.view(U64)
    # The high bits of the hash and the place in one number: its minimum is the first smallest gram.
    marked = (grams >> PLACE_BITS << PLACE_BITS) | np.arange(len(grams), dtype=U64)
    place = (sliding_min(marked, GRAMS) & ((U64(1) << PLACE_BITS) - U64(1))).astype(np.int64)
    inside = np.ones(len(data) + 1, bool)
    begins, ends = offsets[:-1], offsets[1:]
    short = np.minimum(ends - begins, MATCH_BYTES - 1)
    inside[ranges(ends - short, short)] = False
    inside = inside[:n]
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (place[1:] != place[:-1])
    last = inside.copy()
    last[:-1] &= ~inside[1:] | (place[1:] != place[:-1])
    # A passage never runs on into the next text: its last strings would cross the border.
    starts, ends = np.flatnonzero(new), np.flatnonzero(last) + MATCH_BYTES
    text = np.searchsorted(offsets, starts, "right") - 1
    return text, starts - offsets[text], ends - offsets[text], grams[place[starts]], rolling.between(starts, ends)


def _cut(buckets: int):
    """Step 1."""

    def send(held):
        rows = np.concatenate(held)
        rows = rows[np.lexsort((rows["start"], rows["doc"], rows["string"]))]
        first = np.append(True, rows["string"][1:] != rows["string"][:-1])
        least = rows["doc"][np.flatnonzero(first)][np.cumsum(first) - 1]
        repeated = rows["doc"] > least
        kept = rows[~repeated]
        kept = kept[np.argsort(kept["doc"], kind="stable")]
        grams, group, n = np.unique(kept["gram"], return_inverse=True, return_counts=True)
        often = (n >= OFTEN)[group]
        # A passage of no bytes tells the others of its gram.
        told = np.zeros(int((n >= OFTEN).sum()), PASSAGE)
        told["gram"] = grams[n >= OFTEN]
        sent = np.concatenate([kept[~often], told])
        yield dealt(sent, (sent["gram"] % np.uint32(buckets)).astype(np.int64), "passages")
        yield _edges(kept[often], np.full(int(often.sum()), BY_WINDOW), buckets)
        yield _spans(rows[repeated], buckets)

    def cut(batches):
        held, n = [], 0
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            for row, data, offsets in text_slices(batch.column(1)):
                text, start, end, gram, string = passages(data, offsets)
                crcs = np.array([zlib.crc32(data[a:b]) for a, b in zip(offsets, offsets[1:])], np.uint32)
                rows = np.empty(len(text), PASSAGE)
                rows["gram"], rows["string"] = (gram >> U64(32)).astype(np.uint32), string
                rows["doc"], rows["crc"] = docs[row + text], crcs[text]
                rows["start"], rows["length"] = start, end - start
                held.append(rows)
                n += len(rows)
                if n >= HELD:
                    yield from send(held)
                    held, n = [], 0
        if held:
            yield from send(held)

    return cut


def _spans(rows: np.ndarray, buckets: int) -> pa.RecordBatch:
    spans = np.empty(len(rows), SPAN)
    for name in SPAN.names:
        spans[name] = rows[name]
    return dealt(spans, doc_bucket(spans["doc"], buckets), "spans")


def _edges(rows: np.ndarray, common: np.ndarray, buckets: int) -> pa.RecordBatch:
    edges = np.empty(len(rows), EDGE)
    for name in SIDED.names[1:]:
        edges[name] = rows[name]
    edges["common"] = common
    return dealt(edges, doc_bucket(edges["doc"], buckets), "edges")


def _meet(buckets: int):
    """Step 2: spans to remove, and edges, passages that share a gram with other passages of other documents."""

    def meet(table: pa.Table) -> pa.Table:
        rows = unpack_columns(table.column("rows").to_pylist(), PASSAGE)
        told = np.unique(rows["gram"][rows["length"] == 0])
        rows = rows[rows["length"] > 0]
        rows = rows[np.lexsort((rows["start"], rows["doc"], rows["string"], rows["gram"]))]
        gram = np.append(True, rows["gram"][1:] != rows["gram"][:-1])[: len(rows)]
        string = gram | np.append(True, rows["string"][1:] != rows["string"][:-1])[: len(rows)]
        least = rows["doc"][np.flatnonzero(string)][np.cumsum(string) - 1]
        repeated = rows["doc"] > least
        spans = _spans(rows[repeated], buckets)
        rows, string = rows[~repeated], string[~repeated]
        # Grams with several strings, in several documents.
        group = np.cumsum(np.append(False, rows["gram"][1:] != rows["gram"][:-1])) if len(rows) else np.zeros(0, int)
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(rows) else np.zeros(0, int)
        if len(rows):
            strings = np.add.reduceat(string.astype(np.int64), first)
            low, high = np.minimum.reduceat(rows["doc"], first), np.maximum.reduceat(rows["doc"], first)
            n = np.bincount(group)
            elsewhere = np.isin(rows["gram"][first], told)
            several = (((strings > 1) & (low < high)) | elsewhere)[group]
            common = np.where(elsewhere | (n >= VERY_COMMON), BY_WINDOW, np.where(n >= COMMON_GRAM, BY_SIDE, BY_GRAM))
        else:
            several, common = np.zeros(0, bool), np.zeros(0, int)
        return pa.Table.from_batches([spans, _edges(rows[several], common[group[several]], buckets)])

    return meet


def _by_doc(kind: np.dtype, own: np.dtype, finish=lambda rows: rows):
    """Rows of one kind regrouped by document: (doc_id, crc, rows)."""

    def regroup(table: pa.Table) -> pa.Table:
        rows = unpack_columns(table.column("rows").to_pylist(), kind)
        rows = rows[np.lexsort((rows["start"], rows["crc"], rows["doc"]))]
        new = (rows["doc"][1:] != rows["doc"][:-1]) | (rows["crc"][1:] != rows["crc"][:-1])
        cuts = np.flatnonzero(np.append(True, new))
        blobs = [pack_columns(finish(part)) for part in np.split(rows[list(own.names)], cuts[1:])]
        owners = {"doc_id": pa.array(rows["doc"][cuts]), "crc": pa.array(rows["crc"][cuts].astype(np.int64))}
        return pa.table(owners | {"rows": pa.array(blobs, pa.binary())})

    return regroup


def _merge(spans: np.ndarray) -> np.ndarray:
    start, end = merged(spans["start"].astype(np.int64), spans["start"].astype(np.int64) + spans["length"])
    out = np.empty(len(start), OWN_SPAN)
    out["start"], out["length"] = start, end - start
    return out


def _sides(data: np.ndarray, lengths: np.ndarray, common: np.ndarray):
    """(string, key) for the gram of each string; BY_SIDE with the bytes before it and with those after it; none BY_WINDOW."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    rolling = Rolling(data)
    grams = rolling.windows(GRAM_BYTES)
    marked = (grams >> PLACE_BITS << PLACE_BITS) | np.arange(len(grams), dtype=U64)
    # Grams of one string lie between its start and its end; those across strings are passed over.
    cuts = np.stack([starts, ends - GRAM_BYTES + 1], 1).ravel()
    cuts = cuts[cuts < len(marked)]
    place = (np.minimum.reduceat(marked, cuts)[::2] & ((U64(1) << PLACE_BITS) - U64(1))).astype(np.int64)
    alone = np.flatnonzero(common == BY_GRAM)
    found = [(alone, mix(grams[place[alone]]))]
    for salt, low, high in ((1, place - SIDE_BYTES, place + GRAM_BYTES), (2, place, place + GRAM_BYTES + SIDE_BYTES)):
        there = np.flatnonzero((common == BY_SIDE) & (low >= starts) & (high <= ends))
        found.append((there, mix(rolling.between(low[there], high[there]) + U64(salt))))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _first_ones(rows: np.ndarray):
    """Windows of the smallest document with their hash, and all others."""
    rows = rows[np.lexsort((rows["start"], rows["doc"], rows["hash"]))]
    new = np.append(True, rows["hash"][1:] != rows["hash"][:-1])[: len(rows)]
    later = rows["doc"] > rows["doc"][np.flatnonzero(new)][np.cumsum(new) - 1]
    return rows[~later], rows[later]


def _window_spans(rows: np.ndarray) -> np.ndarray:
    """The bytes of windows, those that follow one another in one span."""
    rows = rows[np.lexsort((rows["start"], rows["crc"], rows["doc"]))]
    step = np.any([rows[n][1:] != rows[n][:-1] for n in ("doc", "crc")], axis=0) | (np.diff(rows["start"]) > MATCH_BYTES)
    begin = np.flatnonzero(np.append(True, step)[: len(rows)])
    end = run_ends(begin, len(rows)) - 1
    spans = np.empty(len(begin), SPAN)
    for name in ("doc", "crc", "start"):
        spans[name] = rows[name][begin]
    spans["length"] = rows["start"][end] + MATCH_BYTES - rows["start"][begin]
    return spans


def _window_rows(edges: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The windows of edges, whose bytes lie one after another."""
    lengths = edges["length"].astype(np.int64)
    counts = lengths - MATCH_BYTES + 1
    string, window = np.repeat(np.arange(len(edges)), counts), ranges(np.zeros(len(edges)), counts)
    starts = (np.cumsum(lengths) - lengths)[string] + window
    rows = np.empty(len(string), WINDOW)
    rows["hash"] = _hashes(data, starts, np.full(len(starts), MATCH_BYTES))
    for name in ("doc", "crc"):
        rows[name] = edges[name][string]
    rows["start"] = edges["start"][string] + window
    return rows


def _edge_strings(buckets: int):
    """Bytes of the edges of documents, by side, and hashes of windows: (kind, bucket, rows, strings)."""

    def plain(batch: pa.RecordBatch) -> pa.RecordBatch:
        empty = pa.array([b""] * batch.num_rows, pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns, empty], names=["kind", "bucket", "rows", "strings"])

    def send(held):
        first, later = _first_ones(np.concatenate(held))
        first = first[np.lexsort((first["start"], first["doc"]))]
        yield plain(dealt(first, (first["hash"] % U64(buckets)).astype(np.int64), "windows"))
        yield plain(_spans(_window_spans(later), buckets))

    def cut(batches):
        held, n = [], 0
        for edges, data, batch in by_side(batches):
            yield batch
            chosen = edges["common"] == BY_WINDOW
            lengths = edges["length"].astype(np.int64)
            own = data[ranges((np.cumsum(lengths) - lengths)[chosen], lengths[chosen])]
            held.append(_window_rows(edges[chosen], own))
            n += len(held[-1])
            if n >= HELD:
                yield from send(held)
                held, n = [], 0
        if n:
            yield from send(held)

    def by_side(batches):
        expand = zstandard.ZstdDecompressor().decompress
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            rows, strings = [], []
            owners = zip(*(batch.column(n).to_pylist() for n in ("doc_id", "crc", "data", "rows")))
            for doc, crc, data, blob in owners:
                own, data = unpack_columns([blob], OWN_EDGE), expand(data)
                edges = np.empty(len(own), EDGE)
                edges["doc"], edges["crc"] = doc, crc
                for name in OWN_EDGE.names:
                    edges[name] = own[name]
                rows.append(edges)
                strings += [data[s : s + n] for s, n in zip(edges["start"].tolist(), edges["length"].tolist())]
            edges = np.concatenate(rows)
            data = np.frombuffer(b"".join(strings), np.uint8)
            string, side = _sides(data, edges["length"].astype(np.int64), edges["common"])
            bucket = (side % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rows = np.empty(len(string), SIDED)
            rows["side"] = side
            for name in SIDED.names[1:]:
                rows[name] = edges[name][string]
            cuts = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)) if len(order) else []
            out = np.split(order, cuts[1:]) if len(order) else []
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(["sides"] * len(out), pa.string()),
                    pa.array([int(bucket[o[0]]) for o in out], pa.int64()),
                    pa.array([pack_columns(rows[o]) for o in out], pa.binary()),
                    pa.array([b"".join(strings[i] for i in string[o].tolist()) for o in out], pa.binary()),
                ],
                names=["kind", "bucket", "rows", "strings"],
            )
            yield edges, data, batch

    return cut


def repeated_windows(group, order, lengths, data, k=MATCH_BYTES):
    """For strings with a group and an order in it: which of their k-byte windows an earlier string of the group has.

    Strings of the same order don't count for each other. Returns (string, window) pairs.
    """
    ends = np.cumsum(lengths)
    found = [np.zeros((2, 0), np.int64)]
    for digit in range(int(order.max(initial=0)).bit_length()):
        side = order >> digit & 1
        tag = np.unique(np.stack([group, order >> (digit + 1)]), axis=1, return_inverse=True)[1].ravel()
        has = np.zeros((2, int(tag.max(initial=0)) + 1), bool)
        has[side, tag] = True
        useful = (has[0] & has[1])[tag]
        own = np.flatnonzero(useful)
        own = own[np.argsort(tag[own], kind="stable")]
        indexed, streamed = own[side[own] == 0], own[side[own] == 1]
        symbols = lambda at: data[ranges(ends[at] - lengths[at], lengths[at])].astype(np.int64) + np.repeat(tag[at] << 8, lengths[at])
        # An index of bounded size holds the strings of some tags, or a part of those of one tag.
        part = np.cumsum(lengths[indexed]) // INDEX_SYMBOLS
        for p in np.unique(part):
            held = indexed[part == p]
            index = RunIndex(symbols(held), lengths[held])
            asked = streamed[np.isin(tag[streamed], tag[held])]
            for at in range(0, len(asked), STREAMED):
                now = asked[at : at + STREAMED]
                patterns = ragged(symbols(now), lengths[now], 0)
                string, window = np.nonzero(index.has_windows(patterns, lengths[now], k))
                found.append(np.stack([now[string], window]))
    return np.unique(np.concatenate(found, axis=1), axis=1)


def _hashes(data, starts, lengths) -> np.ndarray:
    """Hashes of substrings in the order of their start, from a slice of the data at a time."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        end = int(np.searchsorted(starts, starts[at] + SLICE_BYTES))
        upto = int((starts[at:end] + lengths[at:end]).max())
        rolling = Rolling(data[starts[at] : upto])
        low = starts[at:end] - starts[at]
        out[at:end] = rolling.between(low, low + lengths[at:end])
        at = end
    return out


def repeated_parts(group, order, lengths, data, k=MATCH_BYTES):
    """(string, start, length) of the parts of strings that earlier strings of their group have, k bytes at least."""
    starts, counts = np.cumsum(lengths) - lengths, np.maximum(lengths - k + 1, 0)
    string = np.repeat(np.arange(len(lengths)), counts)
    window = ranges(np.zeros(len(lengths)), counts)
    # Windows that more than one order has.
    hashes = _hashes(data, starts[string] + window, np.full(len(string), k))
    hashes = mix(hashes + mix(group.astype(U64))[string])
    by_hash = np.argsort(hashes)
    first = np.flatnonzero(np.append(True, np.diff(hashes[by_hash]) != 0)) if len(hashes) else np.zeros(0, int)
    shared = np.zeros(len(hashes), bool)
    if len(hashes):
        orders = order[string[by_hash]]
        several = np.minimum.reduceat(orders, first) < np.maximum.reduceat(orders, first)
        shared[by_hash] = np.repeat(several, np.diff(np.append(first, len(hashes))))
    # Strings trimmed to such windows.
    string, window = string[shared], window[shared]
    new = np.flatnonzero(np.append(True, np.diff(string) != 0)) if len(string) else np.zeros(0, int)
    left, last = string[new], run_ends(new, len(string)) - 1
    low, high = window[new], window[last] + k
    # Of equal ones those of the first order stay.
    hashes = mix(_hashes(data, starts[left] + low, high - low) + mix(group[left].astype(U64)))
    by_hash = np.lexsort((order[left], hashes))
    new = np.append(True, np.diff(hashes[by_hash]) != 0) if len(left) else np.zeros(0, bool)
    least = order[left][by_hash][np.flatnonzero(new)][np.cumsum(new) - 1]
    equal = np.zeros(len(left), bool)
    equal[by_hash] = order[left][by_hash] > least
    rest = np.flatnonzero(~equal)
    lengths = (high - low)[rest]
    trimmed = data[ranges((starts[left] + low)[rest], lengths)]
    string, window = repeated_windows(group[left][rest], order[left][rest], lengths, trimmed, k)
    # Windows one after another are one part.
    new = np.append(True, (np.diff(string) != 0) | (np.diff(window) != 1)) if len(string) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    end = run_ends(begin, len(string)) - 1
    parts = rest[string[begin]]
    return (
        np.concatenate([left[equal], left[parts]]),
        np.concatenate([low[equal], low[parts] + window[begin]]),
        np.concatenate([(high - low)[equal], window[end] - window[begin] + k]),
    )


def _stream(buckets: int):
    """Steps 3 and 4."""

    def stream(table: pa.Table) -> pa.Table:
        kind = table.column("kind")[0].as_py()
        if kind == "spans":
            return table.select(["kind", "bucket", "rows"])
        if kind == "windows":
            _, later = _first_ones(unpack_columns(table.column("rows").to_pylist(), WINDOW))
            return pa.Table.from_batches([_spans(_window_spans(later), buckets)])
        edges = unpack_columns(table.column("rows").to_pylist(), SIDED)
        data = np.frombuffer(b"".join(table.column("strings").to_pylist()), np.uint8)
        lengths = edges["length"].astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        by_doc = np.lexsort((edges["doc"], edges["side"]))
        edges, starts, lengths = edges[by_doc], starts[by_doc], lengths[by_doc]
        # Documents numbered within their group, in the order of their ids.
        new_group = np.append(True, edges["side"][1:] != edges["side"][:-1])
        group = np.cumsum(new_group) - 1
        new_doc = np.cumsum(new_group | np.append(True, edges["doc"][1:] != edges["doc"][:-1])) - 1
        first = np.flatnonzero(new_group)
        order = new_doc - new_doc[first][group]
        # Whole groups of about a megabyte at a time.
        before = (np.cumsum(lengths) - lengths)[first]
        part = (before // (4 * SLICE_BYTES))[group]
        cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(edges)).tolist()
        found = []
        for a, b in zip(cuts, cuts[1:]):
            own = data[ranges(starts[a:b], lengths[a:b])]
            string, start, length = repeated_parts(group[a:b], order[a:b], lengths[a:b], own)
            spans = np.empty(len(string), SPAN)
            for name in ("doc", "crc"):
                spans[name] = edges[name][a:b][string]
            spans["start"], spans["length"] = edges["start"][a:b][string] + start, length
            found.append(spans)
        spans = np.concatenate(found)
        return pa.Table.from_batches([dealt(spans, doc_bucket(spans["doc"], buckets), "spans")])

    return stream


RESULT = T.StructType().add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
RESULT = RESULT.add("kept_sha256", "string").add("kept", "string")


def remove_repeats(docs: DataFrame, doc="doc_id", text="text", keep_columns=False, keep_text=True) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (what remains, as text).

    Every byte is removed that lies in a 50-byte string which also starts in a document with a smaller
    doc_id, judged on the input. Matches never cross documents. A character of which only a part
    remains is left out of `kept`, not of the digest. Null texts count as empty; rows with a null
    doc_id are neither sources nor changed; rows with the same doc_id are no sources for each other
    and judged each by its own text. With keep_columns the other columns stay; without keep_text,
    `kept` is null. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = rows.where("doc_id is not null")
    size = ordered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = parts_for(docs, size, BUCKET_BYTES)
    cut = ordered.mapInArrow(_cut(buckets), DEALT)
    met = freed_stage(cut.groupBy("kind", "bucket").applyInArrow(_pass_or_meet(buckets), DEALT), "passages-met")
    by_doc = "doc_id long, crc long, rows binary"
    edges = met.where("kind = 'edges'").groupBy("bucket").applyInArrow(_by_doc(EDGE, OWN_EDGE), by_doc)
    edges = freed_stage(edges, "edges-by-document")
    strings = packed_texts(ordered).join(edges, ["doc_id", "crc"])
    strings = strings.mapInArrow(_edge_strings(buckets), "kind string, bucket long, rows binary, strings binary")
    streamed = strings.groupBy("kind", "bucket").applyInArrow(_stream(buckets), DEALT)
    spans = met.where("kind = 'spans'").unionByName(streamed)
    spans = freed_stage(spans.groupBy("bucket").applyInArrow(_by_doc(SPAN, OWN_SPAN, _merge), by_doc), "spans-by-document")
    others = [c for c in docs.columns if keep_columns and c not in (doc, text, "doc_id", "text", *RESULT.names)]
    rest = [F.struct(*others).alias("rest")] if others else []
    full = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *rest)
    joined = packed_texts(full).join(spans, ["doc_id", "crc"], "left")
    names = ["doc_id", *(["rest"] if others else [])]
    schema = T.StructType([f for f in full.schema.fields if f.name in names] + RESULT.fields)
    kept = joined.mapInArrow(_finish(names, keep_text), schema)
    return kept.select("doc_id", *([F.col("rest.*")] if others else []), *RESULT.names)


def _pass_or_meet(buckets: int):
    meet = _meet(buckets)

    def apply(table: pa.Table) -> pa.Table:
        return meet(table) if table.column("kind")[0].as_py() == "passages" else table

    return apply


def _finish(names, keep_text):
    def finish(batches):
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = {f.name: [] for f in RESULT.fields}
                for data, blob in zip(part.column("data").to_pylist(), part.column("rows").to_pylist()):
                    data, spans = expand(data), unpack_columns([blob] if blob else [], OWN_SPAN)
                    kept, upto = [], 0
                    for start, length in zip(spans["start"].tolist(), spans["length"].tolist()):
                        kept.append(data[upto:start])
                        upto = start + length
                    kept = b"".join([*kept, data[upto:]])
                    out["n_bytes"].append(len(data))
                    out["n_removed"].append(len(data) - len(kept))
                    out["n_spans"].append(len(spans))
                    out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    out["kept"].append(kept.decode(errors="ignore") if keep_text else None)
                kinds = [pa.int64()] * 3 + [pa.string()] * 2
                columns = [pa.array(out[f.name], k) for f, k in zip(RESULT.fields, kinds)]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + columns, names=[*names, *RESULT.names])

    return finish
