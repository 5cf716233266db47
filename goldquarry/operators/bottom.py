"""The first n rows of every group, by a mergeable aggregate.

Every task keeps, for each group, the first n rows it has seen and lets go of all others at once;
the rows kept by tasks are merged by a few tasks for each group, and those by one. No group is
sorted or held anywhere, however large it is: a task holds n rows a group at most.
"""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

# Tasks that merge the rows of one group before the last one does.
MERGERS = 32


def _first(table: pa.Table, order: list[str], n: int) -> pa.Table:
    if table.num_rows <= n:
        return table
    keys = [(name, "ascending") for name in order]
    return table.take(pc.select_k_unstable(table, n, keys))


def _keeper(groups: list[str], order: list[str], n: int):
    """A function over batches that keeps the first n rows of each group."""

    def keep(batches):
        kept: dict[tuple, pa.Table] = {}
        # The greatest leading order value a full group keeps: rows beyond it are not looked at.
        bound: dict[tuple, pa.Scalar] = {}
        schema = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            schema = table.schema
            if not table.num_rows:
                continue
            for key in table.select(groups).group_by(groups).aggregate([]).to_pylist():
                at, mask = tuple(key[g] for g in groups), None
                for name, value in key.items():
                    test = pc.is_null(table[name]) if value is None else pc.equal(table[name], value)
                    mask = test if mask is None else pc.and_kleene(mask, test)
                if at in bound:
                    mask = pc.and_kleene(mask, pc.less_equal(table[order[0]], bound[at]))
                rows = table.filter(mask)
                if not rows.num_rows:
                    continue
                both = pa.concat_tables([kept[at], rows]) if at in kept else rows
                kept[at] = _first(both, order, n).combine_chunks()
                if kept[at].num_rows == n:
                    bound[at] = pc.max(kept[at][order[0]])
        for table in kept.values():
            yield from table.to_batches()

    return keep


def bottom_n(df: DataFrame, groups: list[str], order: list[str], n: int) -> DataFrame:
    """The first `n` rows of each group by the `order` columns, ascending; rows equal in all of them are interchangeable.

    Order columns must not be null. Copies of a row are rows of their own. The columns must be ones that Arrow can carry.
    """
    if n <= 0:
        return df.where(F.lit(False))
    keep = _keeper(groups, order, n)
    schema = df.schema
    local = df.mapInArrow(keep, schema).withColumn("_merger", F.pmod(F.spark_partition_id(), F.lit(MERGERS)))
    some = local.repartition(*groups, "_merger").drop("_merger").mapInArrow(keep, schema)
    return some.repartition(*groups).mapInArrow(keep, schema)
