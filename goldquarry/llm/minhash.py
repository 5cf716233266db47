"""Near-duplicate documents by bottom-k sketches of word shingles.

One hash function orders the shingles of a document; its sketch is the k smallest. Documents with
equal sets are one class. Inverted lists of retained values bring classes together:

* Two sets at the threshold share at least `LEAST_SHARED` of their sketch values (all but a share of
  about 1e-5 of pairs at the very threshold do). So, with the values of a sketch ordered from rare
  to common, a pair meets in a list of the first `k - LEAST_SHARED + 1` values of both; values that
  many documents share are mostly left out of the lists.
* The first and last member of a list are compared with all others. Union sketches filter these
  pairs, full sets verify them.
* Lists whose other members are not in one component yet are compared in full, in blocks, by tasks
  that hold the members' full sets and emit only links that connect something.

So a group of near copies costs its lists' length, not all its pairs as rows, and no link between
components is lost.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from goldquarry.llm.common import broadcast_if_small, small_batches, stage
from goldquarry.llm.components import connected_components
from goldquarry.llm.groups import sorted_groups
from goldquarry.llm.kernels import BLANK_SEPARATED, U64, run_hashes, signed, text_slices, word_hashes

SHINGLE_WORDS = 5
THRESHOLD = 75
SKETCH = 32
LEAST_SHARED = 12
BLOCK_ROWS = 1024


def shingle_sets(column, words: int = SHINGLE_WORDS):
    """(row, sorted distinct shingle hashes) of every text; shorter texts are one shingle, texts without words none."""
    for row, data, offsets in text_slices(column):
        hashes, first = word_hashes(data, offsets, BLANK_SEPARATED)
        runs = run_hashes(hashes, words)
        for i in range(len(offsets) - 1):
            start, end = first[i], first[i + 1]
            if end - start >= words:
                yield row + i, np.unique(runs[start : end - words + 1])
            elif end > start:
                yield row + i, run_hashes(hashes[start:end], int(end - start)) + U64(end - start)
            else:
                yield row + i, np.zeros(0, U64)


def _lists(arrays) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate(arrays) if arrays else np.zeros(0, U64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(signed(values)))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n, set_key, sketch) of every row (doc_id, text)."""

    def sign(batches):
        for part in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
            sets = [s for _, s in shingle_sets(part.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    _lists([s[:SKETCH] for s in sets]),
                ],
                names=["doc_id", "n", "set_key", "sketch"],
            )

    return docs.mapInArrow(sign, "doc_id long, n long, set_key binary, sketch array<long>")


def _full_sets(docs: DataFrame) -> DataFrame:
    """(rep, shingles): the full sets of chosen documents."""

    def build(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = _lists([s for _, s in shingle_sets(part.column(1))])
                yield pa.RecordBatch.from_arrays([part.column(0), sets], names=["rep", "shingles"])

    return docs.mapInArrow(build, "rep long, shingles array<long>")


def list_entries(classes: DataFrame) -> DataFrame:
    """(v, rep, n): the values under which a class is listed, those that at least two sketches retain."""
    entries = classes.select("rep", F.explode("sketch").alias("v"))
    # Stored, so that both sides of the join are plain and a common value's rows can be split.
    counts = stage(entries.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "sketch-values")
    shared = entries.join(counts, "v").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("values"))
    kept = F.least(F.col("n"), F.lit(SKETCH))
    needed = F.least(F.ceil(F.col("n") * THRESHOLD / 100), F.lit(LEAST_SHARED))
    # Values of one sketch only come first in the order; they list nothing.
    listed = kept - needed + 1 - (kept - F.size("values"))
    return (
        shared.join(classes.select("rep", "n"), "rep")
        .where(listed > 0)
        .select("rep", "n", F.explode(F.slice("values", F.lit(1), listed.cast("int"))).alias("value"))
        .select("value.v", "rep", "n")
    )


def _hub_pairs(lists: DataFrame, entries: DataFrame, classes: DataFrame) -> DataFrame:
    """(hub, rep): a list's first and last member with all others, as far as sizes and union sketches allow."""
    ends = lists.select("v", F.explode(F.array_distinct(F.array("first", "last"))).alias("hub"))
    pairs = entries.join(ends, "v").where("hub.rep <> rep")
    sizes = F.least("n", "hub.n") * 100 >= F.greatest("n", "hub.n") * THRESHOLD
    pairs = pairs.where(sizes).select(F.col("hub.rep").alias("hub"), "rep").distinct()
    one = classes.select(F.col("rep").alias("hub"), F.col("sketch").alias("hub_sketch"), F.col("n").alias("hub_n"))
    both = pairs.join(one, "hub").join(classes.select("rep", "sketch", "n"), "rep")
    union = F.slice(F.array_sort(F.array_union("sketch", "hub_sketch")), 1, SKETCH)
    common = F.size(F.array_intersect(union, F.array_intersect("sketch", "hub_sketch")))
    needed = F.least(F.ceil(F.least("n", "hub_n") * THRESHOLD / 100), F.lit(LEAST_SHARED))
    return both.where(common >= needed).select("hub", "rep")


def _overlaps(indexes, offsets, size, one):
    """Sizes of the intersections of one set with all sets."""
    mark = np.zeros(size, bool)
    mark[indexes[offsets[one] : offsets[one + 1]]] = True
    hits = np.zeros(len(indexes) + 1, np.int64)
    np.cumsum(mark[indexes], out=hits[1:])
    return hits[offsets[1:]] - hits[offsets[:-1]]


def _compare(batches):
    """Links between the members of a group that are not in one component yet; only those that connect."""
    for group in sorted_groups(batches, ["key", "one", "two"]):
        rep, component, block = (group.column(c).to_numpy() for c in ("rep", "component", "block"))
        hub = group.column("hub").to_numpy(zero_copy_only=False)
        one, two = group.column("one").to_numpy()[0], group.column("two").to_numpy()[0]
        sets = group.column("shingles").combine_chunks()
        sizes = pc.list_value_length(sets).to_numpy()
        offsets = np.append(0, np.cumsum(sizes))
        values, indexes = np.unique(pc.list_flatten(sets).to_numpy(), return_inverse=True)
        roots = {}

        def root(x):
            while roots.get(x, x) != x:
                x = roots[x]
            return x

        if hub.any():
            left = np.flatnonzero(hub)
        else:
            # A pair of two components has a member outside the largest.
            names, counts = np.unique(component, return_counts=True)
            left = np.flatnonzero(component != names[counts.argmax()])
        links = []
        for i in left.tolist():
            other = (component != component[i]) & (np.minimum(sizes, sizes[i]) * 100 >= np.maximum(sizes, sizes[i]) * THRESHOLD)
            if one != two:
                other &= block != block[i]
            if not other.any():
                continue
            common = _overlaps(indexes, offsets, len(values), i)
            near = other & (common * 100 >= (sizes + sizes[i] - common) * THRESHOLD)
            for j in np.flatnonzero(near).tolist():
                x, y = root(component[i]), root(component[j])
                if x != y:
                    roots[max(x, y)] = min(x, y)
                    links.append((rep[i], rep[j]))
        if links:
            a, b = np.array(links, np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _linked(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of groups (key, one, two, block, hub, rep, component); each task has its groups' full sets."""
    order = ["key", "one", "two"]
    held = groups.join(sets, "rep").select(*order, "block", "hub", "rep", "component", "shingles")
    return held.repartition(*order).sortWithinPartitions(*order).mapInArrow(_compare, "a long, b long")


def _hub_groups(pairs: DataFrame) -> DataFrame:
    """Groups of a hub and at most about BLOCK_ROWS others; a hub of more is in several groups."""
    parts = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("parts"))
    hubs = parts.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("one"), F.col("hub").alias("rep"))
    others = pairs.join(parts, "hub").select("hub", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("one"), "rep")
    both = hubs.withColumn("is_hub", F.lit(True)).unionByName(others.withColumn("is_hub", F.lit(False)))
    return both.select(
        F.col("hub").alias("key"),
        "one",
        F.col("one").alias("two"),
        F.lit(0).alias("block"),
        F.col("is_hub").alias("hub"),
        "rep",
        F.col("rep").alias("component"),
    )


def _list_groups(lists: DataFrame, entries: DataFrame, components: DataFrame) -> DataFrame:
    """Groups of what is left of the lists, as pairs of blocks: those with members of several components."""
    labelled = entries.join(components, entries.rep == components.id, "left").select(
        "v", "rep", F.coalesce("component", "rep").alias("component")
    )
    ends = lists.where("members > 3").select("v", F.col("first.rep").alias("first"), F.col("last.rep").alias("last"))
    rest = labelled.join(ends, "v").where("rep <> first and rep <> last").select("v", "rep", "component")
    open_lists = (
        rest.groupBy("v")
        .agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("v", F.ceil(F.col("m") / BLOCK_ROWS).cast("int").alias("blocks"))
    )
    blocked = rest.join(open_lists, "v").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    return blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.col("v").alias("key"),
        F.least("block", "other").alias("one"),
        F.greatest("block", "other").alias("two"),
        "block",
        F.lit(False).alias("hub"),
        "rep",
        "component",
    )


def near_duplicates(docs: DataFrame, doc="doc_id", text="text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * |A and B| >= 75 * |A or B| for their sets of 5-word shingles
    (fewer words: the whole sequence), compared by 64-bit hashes. Null texts, texts without words and
    null doc_ids link with nothing. Rows with the same doc_id are judged each by its own text, and sets
    with the same smallest doc_id are one node. An empty table gives no rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed_docs = stage(signatures(rows), "signatures")
    able = signed_docs.where("n > 0 and doc_id is not null")
    classes = able.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = stage(classes, "set-classes")
    entries = stage(list_entries(classes), "list-entries")
    member = F.struct("rep", "n")
    lists = entries.groupBy("v").agg(
        F.count(F.lit(1)).alias("members"), F.min(member).alias("first"), F.max(member).alias("last")
    )
    lists = stage(lists.where("members > 1"), "lists")
    pairs = stage(_hub_pairs(lists, entries, classes), "hub-pairs")
    listed = entries.join(lists.select("v"), "v", "left_semi").select(F.col("rep").alias("doc_id")).distinct()
    sets = stage(_full_sets(rows.join(broadcast_if_small(stage(listed, "listed")), "doc_id")), "full-sets")
    links = stage(_linked(_hub_groups(pairs), sets), "hub-links")
    rest = _linked(_list_groups(lists, entries, stage(connected_components(links), "hub-components")), sets)
    components = stage(connected_components(links.unionByName(rest)), "components")
    reps = classes.join(components, classes.rep == components.id, "left")
    reps = reps.select("set_key", F.coalesce("component", "rep").alias("component"))
    linked = signed_docs.where("n > 0").join(reps, "set_key", "left")
    empty = signed_docs.where("n = 0").withColumn("component", F.col("doc_id"))
    return linked.unionByName(empty, allowMissingColumns=True).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"),
    )
