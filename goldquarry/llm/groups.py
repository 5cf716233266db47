"""Groups of rows in sorted Arrow batches."""

import numpy as np
import pyarrow as pa


def _changes(table: pa.Table, keys) -> np.ndarray:
    """Rows whose key differs from the row before."""
    new = np.zeros(max(table.num_rows - 1, 0), bool)
    for key in keys:
        values = table.column(key).combine_chunks()
        values = values.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new |= values[1:] != values[:-1]
    return np.flatnonzero(new) + 1


def sorted_groups(batches, keys, most: int | None = None, overlap: int = 0):
    """Tables of equal keys from batches sorted by them.

    With `most`, long groups are given in parts of about that many rows, each part beginning with the
    last `overlap` rows of the one before.
    """
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        cuts = [0, *_changes(table, keys).tolist()]
        for start, end in zip(cuts, cuts[1:]):
            yield table.slice(start, end - start)
        rest = table.slice(cuts[-1])
        if most is not None and rest.num_rows > most:
            yield rest
            rest = rest.slice(rest.num_rows - overlap)
    if rest is not None and rest.num_rows:
        yield rest
