"""Wide-column cell tables: batch put, get and delete.

A table is one row per cell:
``cells(row_key string, family string, qualifier string, value string, version long)``.
Rows are sparse - each row key has only the cells that were put.

* ``put_cells``    - newest version of each cell wins; on equal versions
                     the later batch wins, then the larger value (so the
                     result never depends on task order).
* ``get_rows``     - the cells of a batch of row keys (left semi join).
* ``delete_rows``  - the table without a batch of row keys (left anti join).

Put is an aggregate over the union of table and batch: partial maxima are
taken in each map task, so a row key holding a third of all cells does not
land in one task unreduced.  Get and delete are joins on the row key; AQE
broadcasts the key batch when it is small and splits skewed partitions
when it is not.  Parquet files cannot change in place, so a caller stores
the result as a new table version (``save_version``) and swaps names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

CELL_KEY = ["row_key", "family", "qualifier"]
CELL_COLUMNS = CELL_KEY + ["value", "version"]
CELL_SCHEMA = "row_key string, family string, qualifier string, value string, version long"


def put_cells(cells: DataFrame, *batches: DataFrame) -> DataFrame:
    """The table after applying the batches of puts in order."""
    parts = [cells.select(*CELL_COLUMNS, F.lit(0).alias("seq"))]
    for i, b in enumerate(batches, start=1):
        parts.append(b.select(*CELL_COLUMNS, F.lit(i).alias("seq")))
    allc = parts[0]
    for p in parts[1:]:
        allc = allc.unionByName(p)
    newest = F.max(F.struct("version", "seq", "value")).alias("m")
    return (allc.groupBy(*CELL_KEY).agg(newest)
                .select(*CELL_KEY, F.col("m.value").alias("value"), F.col("m.version").alias("version")))


def merge_cells(table: DataFrame, batch: DataFrame) -> DataFrame:
    """``put_cells(table, batch)`` for a stored table: the batch is reduced to
    its newest row per cell first, so that a batch with many puts of one cell
    adds one row to the merge.  NULL keys are ordinary keys, a NULL version is
    the oldest, and a table that holds a cell twice comes out with it once -
    the same rows as ``put_cells`` at any size."""
    newest = F.max(F.struct("version", "value")).alias("m")
    latest = (batch.groupBy(*CELL_KEY).agg(newest)
              .select(*CELL_KEY, F.col("m.value").alias("value"), F.col("m.version").alias("version")))
    return put_cells(table, latest)


def get_rows(cells: DataFrame, keys: DataFrame, key_col: str = "row_key") -> DataFrame:
    """``(row_key, family, qualifier, value)`` of the requested row keys."""
    k = keys.select(F.col(key_col).alias("row_key"))
    return cells.join(k, "row_key", "left_semi").select("row_key", "family", "qualifier", "value")


def delete_rows(cells: DataFrame, keys: DataFrame, key_col: str = "row_key") -> DataFrame:
    """The table without the requested row keys."""
    k = keys.select(F.col(key_col).alias("row_key"))
    return cells.join(k, "row_key", "left_anti").select(*CELL_COLUMNS)


def save_version(cells: DataFrame, path: str) -> None:
    """Write a table version (a new folder); readers switch when it is complete."""
    cells.write.mode("errorifexists").parquet(path)
