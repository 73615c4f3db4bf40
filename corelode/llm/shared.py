"""Tables looked up by part.

Executors may be lost at any time, so nothing here relies on blocks held by an
executor: an intermediate result that is read more than once is written to the
shared folder (:mod:`corelode.lineage`).

Texts are larger than anything that is found out about them, so they are not
shuffled to meet it.  :func:`parted` writes a table once, in parts; what a part
needs to know is computed by joins of narrow rows, written beside it
(:class:`Side`), and read by the task that scans the part.  No such table is sent
through the driver or held whole by a task, whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lineage import fresh, store, written

__all__ = ["Side", "fresh", "parted", "parts", "written"]

ROW = "_row"
PARTS_OF_SIDE = 4  # tasks that share one slice of a side table
_SHIFT = 33 + (PARTS_OF_SIDE - 1).bit_length()  # the upper bits of a row number are those of its task


def parted(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written down in parts: ``_row`` numbers the rows, and its upper bits are the part."""
    return written(df.withColumn(ROW, F.monotonically_increasing_id()), tag)


def parts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(part, rows of the batch) for each part in it."""
    part = batch.column(ROW).to_numpy() >> _SHIFT
    for p in np.unique(part).tolist():
        yield p, np.flatnonzero(part == p)


class Side:
    """A table by part below the shared folder; a task reads the slice of the part it scans."""

    def __init__(self, rows: DataFrame, tag: str, *order: str):
        """``rows`` have a column ``part``; a slice is sorted by ``order`` where that is given."""
        if order:
            rows = rows.repartition("part").sortWithinPartitions("part", *order)
        self.path = store(rows, tag, "part")
        self._last: tuple[int, object] | None = None

    def of(self, part: int, make):
        """``make(slice)``, or ``make(None)`` for a part without rows; kept until another part is asked for."""
        if self._last is None or self._last[0] != part:
            where, root = fs.FileSystem.from_uri(self.path)
            files = [f for f in where.get_file_info(fs.FileSelector(f"{root}/part={part}", allow_not_found=True)) if f.path.endswith(".parquet")]
            tables = [pq.ParquetFile(where.open_input_file(f.path)).read() for f in sorted(files, key=lambda f: f.path)]
            self._last = part, make(pa.concat_tables(tables) if tables else None)
        return self._last[1]
