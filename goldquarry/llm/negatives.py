"""Hard negatives: for an anchor and each of its best positives, the best rows of other labels in a band below.

Every anchor is scored against every row, exactly, by the Four Russians' method. Components are
integers. For each group of eight dimensions, a table holds the sums of an anchor's components over
all 256 subsets of the group. A row is kept as bit planes: for each bit of its components and each
group, one byte that says which of the eight have the bit. The byte is the place in the table,
and the sums of the planes are shifted and added, the sign's plane subtracted.

Rows are packed into planes where they are read. Blocks of anchors meet blocks of rows in tasks of
bounded size, which keep the best of what they have seen for each anchor.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from goldquarry.llm.common import broadcast_if_small, row_keys, stage
from goldquarry.llm.kernels import U64, mix

# Components beyond this magnitude, after scaling, are as good as infinite: scores would not fit.
MOST = 1 << 24
# Rows and anchors that meet in one task, at most about; rows and anchors scored at a time.
TASK_ROWS, TASK_ANCHORS = 1 << 18, 1 << 12
LEAST_TASK_ROWS = 1 << 12
BLOCK_ROWS, BLOCK_ANCHORS = 4096, 64

PACKED = "task long, dims int, planes int, ids binary, labels binary, bits binary"


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Bytes [plane, group, row] of integers [row, dimension] in two's complement; the last plane is the sign's."""
    rows, dims = values.shape
    groups = -(-dims // 8)
    planes = int(max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))).bit_length() + 1
    padded = np.zeros((rows, groups * 8), np.int64)
    padded[:, :dims] = values
    bits = (padded[None] >> np.arange(planes)[:, None, None]) & 1
    packed = np.packbits(bits.astype(np.uint8).reshape(planes, rows, groups, 8), axis=3, bitorder="little")
    return np.ascontiguousarray(packed[..., 0].transpose(0, 2, 1))


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Sums [group, subset, anchor] of the components of each group of eight dimensions, by doubling."""
    n, dims = anchors.shape
    groups = -(-dims // 8)
    padded = np.zeros((n, groups * 8), np.int64)
    padded[:, :dims] = anchors
    members = padded.T.reshape(groups, 8, n)
    sums = np.zeros((groups, 256, n), np.int64)
    for k in range(8):
        sums[:, 1 << k : 2 << k] = sums[:, : 1 << k] + members[:, k, None]
    return sums


def scores(sums: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Inner products [row, anchor] of rows given as bit planes, from an anchor block's sums."""
    planes, groups, rows = bits.shape
    total = np.zeros((rows, sums.shape[2]), sums.dtype)
    for plane in range(planes - 1, -1, -1):
        total += total
        for group in range(groups):
            if plane == planes - 1:
                total -= sums[group][bits[plane, group]]
            else:
                total += sums[group][bits[plane, group]]
    return total


def _small_sums(sums: np.ndarray, planes: int) -> np.ndarray:
    """In 32 bits where no score of rows with so many planes can leave them."""
    most = int(np.abs(sums).max(initial=0)) * sums.shape[0] << planes
    return sums.astype(np.int32) if most < 1 << 31 else sums


class Best:
    """For each slot, the `most` entries with greatest score, ties by smaller id, of all that were offered."""

    def __init__(self, slots: int, most: int):
        self.most = most
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        # A score below this is no longer wanted.
        self.least = np.full(slots, np.iinfo(np.int64).min)

    def offer(self, slot, score, ids) -> None:
        slot, score, ids = np.append(self.slot, slot), np.append(self.score, score), np.append(self.id, ids)
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.searchsorted(slot, slot)
        kept = np.arange(len(slot)) - first < self.most
        self.slot, self.score, self.id = slot[kept], score[kept], ids[kept]
        last = np.arange(len(slot)) - first == self.most - 1
        self.least[slot[last]] = score[last]


def _blocks(packed: pa.Table):
    """(dims, ids, labels, bits) of bounded blocks of rows with equal dimensions and planes."""
    parts: dict = {}
    for row in packed.to_pylist():
        shape = (row["planes"], -(-row["dims"] // 8), -1)
        part = parts.setdefault((row["dims"], row["planes"]), ([], [], []))
        part[0].append(np.frombuffer(row["ids"], np.int64))
        part[1].append(np.frombuffer(row["labels"], np.int64))
        part[2].append(np.frombuffer(row["bits"], np.uint8).reshape(shape if row["dims"] else (row["planes"], 0, len(part[0][-1]))))
    for (dims, _), (ids, labels, bits) in sorted(parts.items()):
        ids, labels, bits = np.concatenate(ids), np.concatenate(labels), np.concatenate(bits, axis=2)
        for at in range(0, len(ids), BLOCK_ROWS):
            end = at + BLOCK_ROWS
            yield dims, ids[at:end], labels[at:end], bits[:, :, at:end]


def _anchor_blocks(anchors: pa.Table):
    """(dims, places in the table, components) of bounded blocks of anchors of equal dimensions."""
    components = [np.frombuffer(v, np.int64) for v in anchors.column("components").to_pylist()]
    dims = np.array([len(c) for c in components])
    for d in np.unique(dims):
        places = np.flatnonzero(dims == d)
        for at in range(0, len(places), BLOCK_ANCHORS):
            here = places[at : at + BLOCK_ANCHORS]
            yield int(d), here, np.stack([components[i] for i in here])


def _scored(packed: pa.Table, anchors: pa.Table):
    """(places of anchors, ids, labels, scores) of all blocks of anchors with all blocks of rows."""
    rows = list(_blocks(packed))
    for dims, places, components in _anchor_blocks(anchors):
        sums = subset_sums(components)
        for of, ids, labels, bits in rows:
            if of == dims:
                yield places, ids, labels, scores(_small_sums(sums, len(bits)), bits)


def _positives(most: int):
    def best(packed: pa.Table, anchors: pa.Table) -> pa.Table:
        anchor_ids, own = (anchors.column(c).to_numpy() for c in ("anchor_id", "label"))
        kept = Best(len(anchor_ids), most)
        for places, ids, labels, score in _scored(packed, anchors):
            wanted = (labels[:, None] == own[places]) & (ids[:, None] != anchor_ids[places]) & (score >= kept.least[places])
            row, column = np.nonzero(wanted)
            kept.offer(places[column], score[row, column].astype(np.int64), ids[row])
        columns = [pa.array(anchor_ids[kept.slot]), pa.array(kept.id), pa.array(kept.score)]
        return pa.table(columns, names=["anchor_id", "positive_id", "positive_score"])

    return best


def _negatives(most: int, low: int, high: int):
    def best(packed: pa.Table, anchors: pa.Table) -> pa.Table:
        own = anchors.column("label").to_numpy()
        pairs = anchors.column("positives").to_pylist()
        each = max(map(len, pairs), default=0)
        reach = np.zeros((len(pairs), each), np.int64)
        known = np.zeros((len(pairs), each), bool)
        for i, found in enumerate(pairs):
            reach[i, : len(found)] = [p["positive_score"] for p in found]
            known[i, : len(found)] = True
        least, greatest = -(-low * reach // 100), high * reach // 100
        kept = Best(len(pairs) * each, most)
        for places, ids, labels, score in _scored(packed, anchors):
            other = labels[:, None] != own[places]
            for j in range(each):
                slot = places * each + j
                floor = np.where(known[places, j], np.maximum(least[places, j], kept.least[slot]), np.iinfo(np.int64).max)
                row, column = np.nonzero(other & (score >= floor) & (score <= greatest[places, j]))
                kept.offer(slot[column], score[row, column].astype(np.int64), ids[row])
        named = [pairs[s // each][s % each] for s in kept.slot.tolist()]
        ids = anchors.column("anchor_id").to_numpy()
        columns = {
            "anchor_id": pa.array(ids[kept.slot // max(each, 1)], pa.int64()),
            "positive_id": pa.array([p["positive_id"] for p in named], pa.int64()),
            "positive_score": pa.array([p["positive_score"] for p in named], pa.int64()),
            "negative_id": pa.array(kept.id),
            "negative_score": pa.array(kept.score),
        }
        return pa.table(list(columns.values()), names=list(columns))

    return best


def _usable(vectors: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, components) of the rows that take part, one for each id."""
    known = F.col(vector).isNotNull() & F.col(label).isNotNull() & F.col(key).isNotNull()
    scaled = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * float(scale)).cast("long"))
    sound = F.forall(F.col(vector), lambda x: F.coalesce(F.abs(x.cast("double") * float(scale)) <= MOST, F.lit(False)))
    rows = vectors.where(known & sound & ~F.exists(F.col(vector), F.isnan)).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), scaled.alias("components")
    )
    repeated = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    repeated = broadcast_if_small(stage(repeated, "repeated-vectors"))
    first = rows.join(repeated, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "components")).alias("row"))
    return rows.join(repeated, "id", "left_anti").unionByName(first.select("id", "row.*"))


def _packed(rows: DataFrame, tasks: int) -> DataFrame:
    """Blocks of rows as bit planes, dealt to tasks."""

    def pack(batches):
        keys = row_keys()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                ids, labels = (part.column(c).to_numpy() for c in ("id", "label"))
                lists = part.column("components")
                sizes = np.diff(lists.offsets.to_numpy())
                flat, begins = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
                for dims in np.unique(sizes).tolist():
                    here = np.flatnonzero(sizes == dims)
                    bits = bit_planes(flat[begins[here][:, None] + np.arange(dims)].reshape(len(here), dims))
                    task = int(mix(np.array([next(keys)], U64))[0] % U64(tasks))
                    values = [[task], [dims], [len(bits)], [ids[here].tobytes()], [labels[here].tobytes()], [bits.tobytes()]]
                    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                    names = ["task", "dims", "planes", "ids", "labels", "bits"]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)

    return rows.mapInArrow(pack, PACKED)


def _bytes_of(components: Column) -> Column:
    """Little-endian 64-bit integers of an array of longs, for numpy."""
    swap = lambda h: F.array_join(F.transform(F.sequence(F.lit(15), F.lit(1), F.lit(-2)), lambda i: F.substring(h, i, F.lit(2))), "")
    digits = F.transform(components, lambda x: swap(F.lpad(F.hex(x), 16, "0")))
    return F.unhex(F.array_join(digits, ""))


def _met(packed: DataFrame, anchors: DataFrame, tasks: int, slices: int, work, schema: str) -> DataFrame:
    """The results of all tasks, each a block of rows and a block of anchors."""
    all_slices, all_tasks = (F.explode(F.sequence(*(F.lit(x).cast("long") for x in (0, n - 1)))) for n in (slices, tasks))
    rows = packed.withColumn("slice", all_slices)
    sought = anchors.withColumn("slice", F.pmod(F.xxhash64("anchor_id"), F.lit(slices))).withColumn("task", all_tasks)
    return rows.groupBy("task", "slice").cogroup(sought.groupBy("task", "slice")).applyInArrow(work, schema)


def _ranked(df: DataFrame, keys: list[str], score: str, ident: str, most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(ident))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine_negatives(
    vectors: DataFrame, anchor: Column, key="vec_id", vector="embedding", label="label", positives: int = 5,
    negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `anchor` says which rows are anchors. A component x counts as floor(scale * x). An anchor's
    positives are the `positives` best other rows of its label; each has up to `negatives` best rows
    of other labels with low % to high % of the positive's score, ranked from 1. Higher scores come first, ties by
    smaller id. Anchors without positives, and positives without such rows, have no rows.

    Rows with a null id, label or vector, with a null or non-finite component, or one beyond 2 ** 24
    after scaling take no part. Vectors meet those of their own length. Of rows with one id, the one
    with the least label and vector counts. Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    marked = vectors.select(F.col(key).alias("_key"), F.col(vector).alias("_vector"), F.col(label).alias("_label"))
    rows = _usable(marked, "_key", "_vector", "_label", scale)
    # The anchors' rows by id, as given by the caller's columns.
    sought = vectors.where(anchor).select(F.col(key).cast("long").alias("id")).distinct()
    anchors = rows.join(sought, "id", "left_semi").select(
        F.col("id").alias("anchor_id"), "label", _bytes_of(F.col("components")).alias("components")
    )
    anchors = stage(anchors, "anchors")
    n_rows, n_anchors = rows.count(), anchors.count()
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = min(max(n_rows // max(wanted, 1), LEAST_TASK_ROWS), TASK_ROWS)
    tasks, slices = max(1, -(-n_rows // size)), max(1, -(-n_anchors // TASK_ANCHORS))
    packed = stage(_packed(rows, tasks), "bit-planes")
    schema = "anchor_id long, positive_id long, positive_score long"
    near = _met(packed, anchors, tasks, slices, _positives(positives), schema)
    near = stage(_ranked(near, ["anchor_id"], "positive_score", "positive_id", positives).drop("rank"), "positives")
    listed = near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    schema += ", negative_id long, negative_score long"
    found = _met(packed, anchors.join(listed, "anchor_id"), tasks, slices, _negatives(negatives, low, high), schema)
    ranked = _ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
