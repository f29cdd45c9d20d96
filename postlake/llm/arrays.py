"""Vectors of an Arrow batch as numpy matrices."""

import numpy as np
import pyarrow as pa


def by_width(batch: pa.RecordBatch, column: str):
    """(width, places in the batch, matrix) of the vectors of each width, none of them null."""
    lists = batch.column(batch.schema.get_field_index(column))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    begins = np.cumsum(sizes) - sizes
    for width in np.unique(sizes).tolist():
        places = np.flatnonzero(sizes == width)
        yield width, places, flat[begins[places][:, None] + np.arange(width)]
