"""Near-duplicate vectors by sorted projection passes.

In each pass the signs of random projections, one after another, are a vector's key; vectors are
centred on the mean of their label, ordered by label and key, and each is compared with the next ones
in order. Each pass measures how many signs set a vector apart from those beyond its window, and with
that the chance that it missed a pair at the threshold. Vectors whose chance is still too high take
part in further passes, or are compared with each other in blocks where that is less work. Verified
pairs are united to components; within a component all pairs are compared, so a vector's links
are counted in full however many it has. Equal vectors are one class from the start.
"""

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from goldquarry.llm.common import broadcast_if_small, stage
from goldquarry.llm.components import connected_components
from goldquarry.llm.groups import sorted_groups

COSINE = 0.93
WINDOW = 32
KEY_BITS = 64
# Share of pairs at the very threshold that all passes together may miss.
MISSED = 0.005
BLOCK_ROWS = 1024
# Vectors are compared in blocks if they are no more than so many for each comparison of their passes.
BLOCKS_FOR = 8
CENTRES = 1000
SEED = 20240611


def passes_for(vectors: int, cosine: float = COSINE, window: int = WINDOW, missed: float = MISSED) -> int:
    """Passes that find a pair at the threshold with probability 1 - missed among evenly spread vectors: the first ones.

    Two vectors are neighbours if their first log2(vectors / window) signs agree, each of which does
    with probability 1 - angle / pi.
    """
    agree = 1 - math.acos(cosine) / math.pi
    found = agree ** max(0.0, math.log2(max(vectors, 1) / window))
    return 1 if found >= 1 else max(1, math.ceil(math.log(missed) / math.log1p(-found)))


def usable(vector: str, label: str, key: str):
    """Vectors that can link: label and id known, not empty, all components finite, not all zero."""
    v = F.col(vector)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fine = F.col(label).isNotNull() & F.col(key).isNotNull() & v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)
    return F.coalesce(fine, F.lit(False))


def _matrix(column) -> np.ndarray:
    """Unit rows in double precision; all vectors of a batch part have one length."""
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(1, keepdims=True)  # no overflow of squares
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _centres(classes: DataFrame) -> DataFrame:
    """(label, dim, centre): the mean unit vector, summed by task first."""
    kind = {f.name: f.dataType.simpleString() for f in classes.schema.fields}["label"]

    def add(batches):
        for group in sorted_groups(batches, ["label", "dim"], most=8192):
            total = _matrix(group.column("vector")).sum(0)
            yield pa.RecordBatch.from_arrays(
                [group.column("label").combine_chunks()[:1], group.column("dim").combine_chunks()[:1]]
                + [pa.array([total.tolist()], pa.list_(pa.float64())), pa.array([group.num_rows], pa.int64())],
                names=["label", "dim", "total", "n"],
            )

    def mean(table: pa.Table) -> pa.Table:
        total = np.array(table.column("total").to_pylist()).sum(0) / sum(table.column("n").to_pylist())
        # Rounded, so that the order of the sum is of no matter.
        centre = pa.array([np.round(total, 6).tolist()], pa.list_(pa.float64()))
        return pa.table({"label": table.column("label")[:1], "dim": table.column("dim")[:1], "centre": centre})

    sums = classes.sortWithinPartitions("label", "dim").mapInArrow(add, f"label {kind}, dim int, total array<double>, n long")
    return sums.groupBy("label", "dim").applyInArrow(mean, f"label {kind}, dim int, centre array<double>")


def _agreeing(radius2: np.ndarray, cosine: float) -> np.ndarray:
    """Chance that a sign of a vector and of one at the threshold agree, seen from a centre at that squared distance."""
    seen = 1 - (1 - cosine) / np.maximum(radius2, 1e-12)
    return 1 - np.arccos(np.clip(seen, -1, 1)) / np.pi


def _keyed(classes: DataFrame, passes: range, cosine: float) -> DataFrame:
    """Every class once for each pass, with its key."""
    names = ["label", "dim", "tie", "rep", "vector"]

    def project(batches):
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            for dim in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                centre = pc.list_flatten(part.column("centre")).to_numpy(zero_copy_only=False).reshape(-1, int(dim))
                seen = _matrix(part.column("vector")) - centre
                agree = _agreeing((seen * seen).sum(1), cosine)
                for k in passes:
                    planes = np.random.default_rng([SEED, k, int(dim)]).standard_normal((int(dim), KEY_BITS))
                    signs = np.packbits(seen @ planes >= 0, axis=1)
                    # Big-endian with the first bit flipped: numbers order as the signs do.
                    signs[:, 0] ^= 0x80
                    keys = signs.copy().view(">i8").astype(np.int64).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(seen), k, np.int32)), pa.array(keys), pa.array(agree)]
                        + [part.column(n) for n in names],
                        names=["pass", "key", "agree", *names],
                    )

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema.fields}
    schema = f"pass int, key long, agree double, label {kinds['label']}, dim int, tie long, rep long, vector {kinds['vector']}"
    return classes.withColumn("tie", F.xxhash64("rep")).mapInArrow(project, schema)


def _forest(pairs: np.ndarray, n: int) -> np.ndarray:
    """Those pairs that join two groups not yet joined by earlier ones."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = []
    for i, (x, y) in enumerate(pairs.tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            keep.append(i)
    return pairs[keep]


def _common_signs(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Leading signs that keys have in common."""
    other = (one ^ two).view(np.uint64)
    high, low = (other >> np.uint64(32)).astype(np.float64), (other & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, 32 - np.frexp(high)[1], 64 - np.frexp(low)[1])


def _neighbours(cosine: float, window: int):
    """Verified neighbours in the order of the rows, only pairs that connect something new: (a, b).

    And for every row (a, null, log of the chance that the pass missed a pair at the threshold).
    """

    def key(group):
        return [group.column(c)[0].as_py() for c in ("pass", "label", "dim")]

    def compared(before, group, after):
        unit, rep, keys = _matrix(group.column("vector")), group.column("rep").to_numpy(), group.column("key").to_numpy()
        n = len(unit)
        found = []
        for k in range(1, min(window, n - 1) + 1):
            near = np.flatnonzero(np.einsum("ij,ij->i", unit[:-k], unit[k:]) >= cosine)
            found.append(np.stack([near, near + k], 1))
        pairs = _forest(np.concatenate(found), n) if found else np.empty((0, 2), np.int64)
        # Signs that part a row from those beyond its window on either side; beyond a task's rows nothing is known.
        first, last = before is None or key(before) != key(group), after is None or key(after) != key(group)
        signs = np.zeros(n, np.int64)
        if n > window:
            shared = _common_signs(keys[:-window], keys[window:]) + 1
            np.maximum.at(signs, np.arange(n - window), shared)
            np.maximum.at(signs, np.arange(window, n), shared)
        chance = group.column("agree").to_numpy() ** signs
        if before is None and TaskContext.get().partitionId():
            chance[:window] = 0
        if after is None:
            chance[max(n - window, 0) :] = 0
        own = slice(0 if first else window, n if last else n - window)
        missed = np.log1p(-np.minimum(chance[own], 1 - 1e-9))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([rep[pairs[:, 0]], rep[own]])),
                pa.concat_arrays([pa.array(rep[pairs[:, 1]]), pa.nulls(len(missed), pa.int64())]),
                pa.concat_arrays([pa.nulls(len(pairs), pa.float64()), pa.array(missed)]),
            ],
            names=["a", "b", "missed"],
        )

    def compare(batches):
        before = group = None
        for after in sorted_groups(batches, ["pass", "label", "dim"], most=8192, overlap=2 * window):
            if group is not None:
                yield from compared(before, group, after)
            before, group = group, after
        if group is not None:
            yield from compared(before, group, None)

    return compare


def _blocks(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Rows with `blocks` once for each pair of blocks that they belong to, sorted by groups and blocks."""
    paired = (
        rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("one", F.least("block", "other"))
        .withColumn("two", F.greatest("block", "other"))
    )
    order = [*groups, "one", "two"]
    return paired.select(*order, "block", "rep", "n", "vector").repartition(*order).sortWithinPartitions(*order)


def _all_pairs(cosine: float):
    """Verified pairs of block pairs; only those that connect something new."""

    def compare(batches):
        for group in sorted_groups(batches, ["label", "dim", "one", "two"]):
            unit, rep, block = _matrix(group.column("vector")), group.column("rep").to_numpy(), group.column("block").to_numpy()
            left, right = (np.flatnonzero(block == group.column(c).to_numpy()[0]) for c in ("one", "two"))
            one, two = np.nonzero(unit[left] @ unit[right].T >= cosine)
            pairs = np.stack([left[one], right[two]], 1)
            pairs = _forest(pairs[pairs[:, 0] != pairs[:, 1]], len(unit))
            yield pa.RecordBatch.from_arrays([pa.array(rep[pairs[:, 0]]), pa.array(rep[pairs[:, 1]])], names=["a", "b"])

    return compare


def _pairs(classes: DataFrame, cosine: float, window: int) -> DataFrame:
    """Pairs that connect all linked vectors of a label, each link at the threshold missed with a probability of MISSED at most."""
    centres = broadcast_if_small(stage(_centres(classes), "vector-centres"), CENTRES)
    todo = classes.join(centres, ["label", "dim"]).withColumn("missed", F.lit(0.0))
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    order = ["pass", "label", "dim", "key", "tie"]
    found, done, passes = [], 0, passes_for(largest, cosine, window)
    while passes:
        keyed = _keyed(todo, range(done, done + passes), cosine).repartitionByRange(*order).sortWithinPartitions(*order)
        met = stage(keyed.mapInArrow(_neighbours(cosine, window), "a long, b long, missed double"), "vector-pairs")
        found.append(met.where("b is not null").select("a", "b"))
        done += passes
        chances = met.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("missed").alias("more"))
        left = todo.join(chances, "rep", "left").withColumn("missed", F.col("missed") + F.coalesce("more", F.lit(0.0)))
        left = stage(left.where(F.col("missed") > math.log(MISSED)).select(*todo.columns), "vectors-left")
        # Passes that a vector needs as things are; none that missed everything are enough for its label.
        need = F.when(F.col("missed") < 0, math.log(MISSED) / F.col("missed") * done)
        groups = left.groupBy("label", "dim").agg(
            F.count(F.lit(1)).alias("m"), F.avg(F.least(F.coalesce(need, F.lit(1e9)), F.lit(1e9))).alias("need")
        )
        groups = stage(groups.withColumn("whole", F.col("need") * window * BLOCKS_FOR >= F.col("m")), "vector-groups")
        side = broadcast_if_small(groups, CENTRES)
        both = left.join(side, ["label", "dim"])
        blocks = both.where("whole").withColumn("blocks", F.ceil(F.col("m") / BLOCK_ROWS).cast("int"))
        compared = _blocks(blocks, ["label", "dim"]).mapInArrow(_all_pairs(cosine), "a long, b long")
        found.append(stage(compared, "vector-block-pairs"))
        todo = both.where(~F.col("whole")).select(*todo.columns)
        most = groups.where(~F.col("whole")).agg(F.max("need")).first()[0]
        passes = min(max(-(-done // 4), math.ceil(most - done)), done) if most is not None else 0
    return reduce(DataFrame.unionByName, found)


def _links(cosine: float):
    """Rows linked to each member of a component, block pair by block pair."""

    def count(batches):
        for group in sorted_groups(batches, ["component", "one", "two"]):
            unit, n = _matrix(group.column("vector")), group.column("n").to_numpy()
            rep, block = group.column("rep").to_numpy(), group.column("block").to_numpy()
            one, two = (group.column(c).to_numpy()[0] for c in ("one", "two"))
            left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
            near = unit[left] @ unit[right].T >= cosine
            if one == two:
                np.fill_diagonal(near, False)
                out = [(left, near @ n[right])]
            else:
                out = [(left, near @ n[right]), (right, near.T @ n[left])]
            for rows, linked in out:
                yield pa.RecordBatch.from_arrays([pa.array(rep[rows]), pa.array(linked.astype(np.int64))], names=["rep", "linked"])

    return count


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, window: int = WINDOW, key="vec_id", vector="embedding", label="label"
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Rows are compared only where labels (and lengths) are equal. Null, empty and zero vectors, null or
    non-finite components, null labels and null ids link with nothing. Copies of a vector link with
    each other and share all other links. Repeated rows each count. An empty table gives no rows.
    """
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows = rows.withColumn("usable", usable("vector", "label", "vec_id"))
    good = rows.where("usable")
    classes = good.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = stage(classes.withColumn("dim", F.size("vector")), "vector-classes")
    pairs = _pairs(classes, cosine, window)
    components = stage(connected_components(pairs), "vector-components")

    # All pairs within a component, in blocks of bounded size.
    sizes = components.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    members = classes.join(components, classes.rep == components.id).join(sizes, "component")
    counted = _blocks(members, ["component"]).mapInArrow(_links(cosine), "rep long, linked long")
    linked = counted.groupBy("rep").agg(F.sum("linked").alias("linked"))
    classed = classes.join(linked, "rep", "left").join(components, classes.rep == components.id, "left")
    classed = classed.select("label", "vector", "rep", "n", "linked", "component")
    # Unusable rows need no partner: they take no part in the join.
    joined = good.join(classed, ["label", "vector"]).select(
        "vec_id",
        (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
