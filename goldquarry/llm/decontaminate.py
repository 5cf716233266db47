"""Benchmark decontamination by winnowing.

Of every window of six 5-word hashes the smallest is kept (the rightmost of equal ones), for
benchmark items and documents alike. Equal passages of ten words then share a kept hash at the same
place, so joining kept hashes finds every shared passage; each hit is extended word by word.
Documents only send the hashes that pass a filter of the benchmark's, a bit table of fixed size:
it saves traffic and never changes the result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from goldquarry.llm.common import row_keys, small_batches, stage
from goldquarry.llm.kernels import LETTERS_AND_DIGITS, U64, run_hashes, signed, text_slices, winnowed, word_hashes

WINDOW_WORDS = 10
GRAM_WORDS = 5
GRAMS_PER_WINDOW = WINDOW_WORDS - GRAM_WORDS + 1
# Words around a kept gram that can belong to a window with it.
REACH = WINDOW_WORDS - GRAM_WORDS
CONTEXT_WORDS = 2 * REACH + GRAM_WORDS
FILTER_BITS = 23


def _positions(hashes: np.ndarray, first: np.ndarray):
    """Kept grams of texts of at least ten words: index of the first word, and the hash."""
    return winnowed(hashes, first, GRAM_WORDS, GRAMS_PER_WINDOW)


def _contexts(hashes, first, at, pad: int) -> np.ndarray:
    """Hashes of the words around kept grams; `pad` where the text has none."""
    text = np.searchsorted(first, at, "right") - 1
    index = at[:, None] + np.arange(-REACH, GRAM_WORDS + REACH)
    there = (index >= first[text][:, None]) & (index < first[text + 1][:, None])
    return np.where(there, hashes[np.clip(index, 0, max(len(hashes) - 1, 0))], U64(pad))


def _short_runs(hashes, first, k):
    """All runs of k words inside texts."""
    grams = run_hashes(hashes, k)
    at = np.arange(len(grams))
    text = np.searchsorted(first, at, "right") - 1
    at = at[at + k <= first[text + 1]]
    return at, grams[at]


ITEMS = "item_id string, fp long, words int, context binary"


def _item_rows(batches):
    for batch in batches:
        for row, data, offsets in text_slices(batch.column(1)):
            hashes, first = word_hashes(data, offsets, LETTERS_AND_DIGITS)
            ids = batch.column(0).slice(row, len(offsets) - 1)
            sizes = np.diff(first)
            at, fps = _positions(hashes, first)
            text = np.searchsorted(first, at, "right") - 1
            contexts = _contexts(hashes, first, at, 1)
            yield _item_batch(ids, text, fps, np.full(len(at), GRAM_WORDS), contexts)
            for k in range(1, WINDOW_WORDS):
                short = np.flatnonzero(sizes == k)
                if len(short):
                    fps = run_hashes(hashes, k)[first[short]]
                    yield _item_batch(ids, short, fps, np.full(len(short), -k), [None] * len(short))


def _item_batch(ids, text, fps, sizes, contexts):
    context = pa.array([None if c is None else c.tobytes() for c in contexts], pa.binary())
    columns = [ids.take(pa.array(text)), pa.array(signed(fps)), pa.array(sizes, pa.int32()), context]
    return pa.RecordBatch.from_arrays(columns, names=["item_id", "fp", "words", "context"])


def _filter_places(fps: np.ndarray) -> np.ndarray:
    return (fps.astype(U64) >> U64(7)) & U64((1 << FILTER_BITS) - 1)


def item_fingerprints(items: DataFrame, item="item_id", text="text") -> DataFrame:
    """Kept hashes of benchmark items; items of fewer than ten words are one run (words negative)."""
    rows = items.select(F.col(item).cast("string").alias("item_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_item_rows, ITEMS)


def _filter_bits(fingerprints: DataFrame) -> bytes:
    """A bit table of the fingerprints, of fixed size for any benchmark."""
    places = fingerprints.select(F.expr(f"shiftrightunsigned(fp, 7) & {(1 << FILTER_BITS) - 1}L").alias("place"))
    parts = places.select(F.expr("shiftright(place, 5)").alias("word"), F.expr("shiftleft(1L, int(place % 32))").alias("bits"))
    table = np.zeros(1 << (FILTER_BITS - 5), np.int64)
    for word, bits in parts.groupBy("word").agg(F.bit_or("bits")).collect():
        table[word] = bits
    return table.astype("<u4").tobytes()


SCANNED = "row long, doc_id long, n_words long, hits array<struct<fp:long,words:int,at:int,context:binary>>"
HIT = pa.struct([("fp", pa.int64()), ("words", pa.int32()), ("at", pa.int32()), ("context", pa.binary())])


def _scan(docs: DataFrame, bits: bytes, short: list[int]) -> DataFrame:
    """Per document its number of words and the kept hashes that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def scan(batches):
        table = np.frombuffer(shared.value, "<u4")
        keys = row_keys()

        def passing(at, fps):
            place = _filter_places(fps)
            there = (table[place >> U64(5)] >> (place & U64(31)).astype(np.uint32)) & 1
            chosen = np.flatnonzero(there)
            return at[chosen], fps[chosen]

        for batch in batches:
            for row, data, offsets in text_slices(batch.column(1)):
                hashes, first = word_hashes(data, offsets, LETTERS_AND_DIGITS)
                n = len(offsets) - 1
                at, fps = passing(*_positions(hashes, first))
                found = [(at, fps, np.full(len(at), GRAM_WORDS), [c.tobytes() for c in _contexts(hashes, first, at, 0)])]
                for k in short:
                    at, fps = passing(*_short_runs(hashes, first, k))
                    found.append((at, fps, np.full(len(at), -k), [None] * len(at)))
                at, fps, sizes = (np.concatenate([f[i] for f in found]) for i in range(3))
                contexts = [c for f in found for c in f[3]]
                text = np.searchsorted(first, at, "right") - 1
                order = np.argsort(text, kind="stable")
                hits = pa.StructArray.from_arrays(
                    [
                        pa.array(signed(fps[order])),
                        pa.array(sizes[order], pa.int32()),
                        pa.array((at - first[text])[order], pa.int32()),
                        pa.array([contexts[i] for i in order], pa.binary()),
                    ],
                    fields=list(HIT),
                )
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(text[order], np.arange(n + 1)), pa.int32()), hits
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([next(keys) for _ in range(n)], pa.int64()),
                        batch.column(0).slice(row, n),
                        pa.array(np.diff(first), pa.int64()),
                        lists,
                    ],
                    names=["row", "doc_id", "n_words", "hits"],
                )

    return docs.mapInArrow(scan, SCANNED)


def _extended(batches):
    """Passages of joined hashes: the run of equal words around the gram, if it is long enough."""
    for batch in batches:
        sizes = batch.column("words").to_numpy()
        at = batch.column("at").to_numpy().astype(np.int64)
        start, end, hit = at.copy(), at - sizes, sizes < 0
        long = np.flatnonzero(sizes > 0)
        if len(long):
            chosen = pa.array(long)
            one, two = (
                np.frombuffer(b"".join(batch.column(n).take(chosen).to_pylist()), U64).reshape(-1, CONTEXT_WORDS)
                for n in ("context", "item_context")
            )
            same = one == two
            left = np.cumprod(same[:, :REACH][:, ::-1], axis=1).sum(axis=1)
            right = np.cumprod(same[:, REACH + GRAM_WORDS :], axis=1).sum(axis=1)
            center = same[:, REACH : REACH + GRAM_WORDS].all(axis=1)
            start[long], end[long] = at[long] - left, at[long] + GRAM_WORDS + right
            hit[long] = center & (left + GRAM_WORDS + right >= WINDOW_WORDS)
        chosen = np.flatnonzero(hit)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row").take(pa.array(chosen)),
                batch.column("item_id").take(pa.array(chosen)),
                pa.array(start[chosen]),
                pa.array(end[chosen]),
            ],
            names=["row", "item_id", "start", "end"],
        )


def decontaminate(
    docs: DataFrame, items: DataFrame, doc="doc_id", text="text", item="item_id", item_text="text"
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (ids, sorted as strings) and passages (start, end in words; they may overlap).

    A word is a run of ASCII letters, digits and characters beyond ASCII of the lower-cased text. Null
    texts have no words; items without words match nothing; items of fewer than ten words match as a
    whole. Repeated rows each get a row, also with the same doc_id; other columns are ignored; an
    empty benchmark gives no hits. Word equality is equality of 64-bit hashes.
    """
    small_batches(docs.sparkSession)
    prints = stage(item_fingerprints(items, item, item_text), "benchmark-prints")
    short = sorted(-r[0] for r in prints.where("words < 0").select("words").distinct().collect())
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scanned = stage(_scan(rows, _filter_bits(prints), short), "benchmark-scan")
    near = scanned.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    pairs = near.join(prints.withColumnRenamed("context", "item_context"), ["fp", "words"])
    passages = pairs.mapInArrow(_extended, "row long, item_id string, start long, end long")
    # Union of a document's passages: each adds the words behind all earlier ones.
    spans = F.sort_array(F.collect_set(F.struct("start", "end")))
    found = passages.groupBy("row").agg(spans.alias("passages"), F.sort_array(F.collect_set("item_id")).alias("items"))
    none = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n"))
    step = lambda s, p: F.struct(
        F.greatest(s["upto"], p["end"]).alias("upto"),
        (s["n"] + F.greatest(F.lit(0).cast("long"), p["end"] - F.greatest(s["upto"], p["start"]))).alias("n"),
    )
    counted = found.withColumn("n_hit", F.aggregate("passages", none, step, lambda s: s["n"]))
    return (
        scanned.select("row", "doc_id", "n_words")
        .join(counted, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(F.coalesce("items", F.array())).cast("long").alias("n_items"),
            F.coalesce("items", F.array()).alias("items"),
            F.coalesce("passages", F.array()).alias("passages"),
        )
    )
