"""The daily store view, kept up to date by the changes of its fact table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from ..files import empty
from ..operators.changes import taken_out
from ..operators.star import SUM_KEYS, add_up, fact_sums, view_of_sums
from .keyed import KeyedTable
from .versioned import VersionedTable


class MaintainedView:
    """Stores sums per store and date key; a batch of changes adds its signed sums.

    The sums do not depend on the dimensions, which are joined when the view is read. So a
    changed or late dimension row shows at once and no fact has to be read again for it.
    """

    def __init__(self, spark: SparkSession, root: str, fact: T.StructType, buckets: int = 16,
                 to_fact: Callable[[DataFrame], DataFrame] = lambda df: df):
        """``to_fact`` maps rows, or images with their ``op``, to the fact columns."""
        self.to_fact = to_fact
        shape = fact_sums(empty(spark, fact)).schema
        self.sums = VersionedTable(spark, root, shape, lambda df, also: add_up(df, [*also, *SUM_KEYS]),
                                   SUM_KEYS, ["ss_store_sk"], buckets)

    def apply(self, images: DataFrame, batch_id: int) -> bool:
        """Add the signed sums of a batch of row images (+I, -U, +U, -D).

        Several changes of one row need no ordering: each image that an earlier change puts in
        and a later one takes out cancels in the sum.
        """
        return self.sums.apply(self._typed(fact_sums(self.to_fact(images), taken_out())), batch_id, merged=True)

    def rebuild(self, fact: DataFrame, table: KeyedTable | None = None) -> None:
        """Compute the sums anew from the whole fact table, between two batches.

        ``table`` is where ``fact`` was read from: the view then counts the batches that the table
        counts, and goes on with the next one. Without it the view's own batches stay counted.
        """
        streams = table.table.manifest().streams if table else None
        self.sums.replace(self._typed(fact_sums(self.to_fact(fact))), streams, merged=True)

    def _typed(self, sums: DataFrame) -> DataFrame:
        return sums.select(*[sums[f.name].cast(f.dataType) for f in self.sums.schema.fields])

    def rows(self, date_dim: DataFrame, store: DataFrame) -> DataFrame:
        return view_of_sums(self.sums.rows(), date_dim, store)


def apply_to_both(changes: DataFrame, batch_id: int, table: KeyedTable,
                  view: MaintainedView) -> bool:
    """Take a batch of changes without before-images into a table and the view over it.

    The rows that the batch replaces are looked up in the table while it does not count the
    batch yet. The view comes first: if the job fails in between, the batch is delivered again,
    the view skips it and the table takes it in.
    """
    staged = table.stage(changes, batch_id)
    if staged is None:
        return False
    view.apply(table.images(staged), batch_id)
    table.table.commit(staged)
    return True
