"""Sales and returns as two streams, joined batch by batch."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from .. import files
from ..operators.pairs import RETURN_WITHIN, returned_sales
from ..sources.sinks import stream_of
from . import jobs

_SALE, _RETURN = "_sale", "_return"
_MATCHED, _OLD = "_matched", "_old"
_DELAY = "spark.watermarkDelayMs"


@dataclass
class _Done:
    """The last batch that counts, its stream, and each side's watermark and the join's after it (milliseconds)."""

    batch: int = -1
    stream: str = ""
    marks: dict[str, int] = field(default_factory=lambda: {_SALE: 0, _RETURN: 0})
    mark: int = 0


class PairedStreams:
    """``returned_sales`` on two streams with watermarks, for streams of few large batches.

    Spark's own stream join writes each row to a state store, looks it up, reads it and deletes it there, one
    by one. Here the rows of a batch meet each other and those still open from the batches before in one
    ordinary join, and what is open after the batch is kept as files.

    The rules are those of Spark's join. Each side's watermark trails its latest time, and the join's is the earlier one
    (policy ``min``) or the later one (``max``); rows not after the join's watermark are late and dropped. A sale
    is open until the watermark has passed its bound, and is given out without a return then if it had none; a
    return is open until the watermark has reached it, as no sale before it can come after that. Each pair is
    given out once, with the batch that has its later row.

    Some things differ. What a batch's watermark closes goes out with that batch, without a further one that has no rows.
    Returns without a ticket or item move their side's watermark as all others do (Spark filters them out below
    it), and a side's watermark outlives a restart.

    Everything of a batch lies in folders of its number and counts from the moment its note is published: a batch that
    fails half-way is written over when it is delivered again, and one that counts already is skipped.
    """

    def __init__(self, sales: DataFrame, returns: DataFrame, root: str, policy: str = "min", keep: list[str] | None = None,
                 within: str = RETURN_WITHIN, sold: str = "sold_at", returned: str = "returned_at", **names: tuple[str, str]):
        """``keep`` has the columns to give out (all by default), ``names`` the operator's ticket and item columns."""
        delays = [df.schema[time].metadata.get(_DELAY) for df, time in ((sales, sold), (returns, returned))]
        if None in delays:
            raise ValueError(f"both streams need a watermark, on {sold} and {returned}")
        self.spark, self.root, self.policy, self.within, self.names = sales.sparkSession, root, policy, within, names
        self.sold, self.returned, self.delays = sold, returned, dict(zip((_SALE, _RETURN), delays))
        self.sale, self.back = _plain(sales.schema), _plain(returns.schema)
        self.keep = keep or [*self.sale.names, *self.back.names]
        self.both = sales.select(F.struct(*self.sale.names).alias(_SALE), F.lit(None).cast(self.back).alias(_RETURN)).unionByName(
            returns.select(F.lit(None).cast(self.sale).alias(_SALE), F.struct(*self.back.names).alias(_RETURN)))

    def start(self, name: str, checkpoint: str, **trigger) -> StreamingQuery:
        return jobs.with_watermark_policy(self.spark, self.policy, lambda: jobs.for_each_batch(
            self.both, self.apply, name, checkpoint, **trigger))

    def rows(self) -> DataFrame:
        """All that the batches which count have given out."""
        last, kinds = self._done().batch, {f.name: f for f in [*self.sale, *self.back]}
        schema = T.StructType([kinds[c] for c in self.keep])
        found = [n for n in files.names(self.spark, f"{self.root}/out") if int(n) <= last]
        if not found:
            return files.empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/out/{n}" for n in found])

    def apply(self, batch: DataFrame, batch_id: int) -> bool:
        """Take a batch in; False when it was taken in before."""
        done = self._done()
        if done.batch >= 0 and done.stream != stream_of(batch_id):
            raise ValueError(f"{self.root} belongs to another stream")
        if batch_id <= done.batch:
            return False
        after = self._marks_after(batch, batch_id, done)
        self._write_out(batch, batch_id, done, after)
        self._write_open(batch, batch_id, done, after)
        files.publish_text(self.spark, f"{self.root}/done/{after.batch:012d}.json", json.dumps(vars(after)))
        self._clear(batch_id)
        return True

    # -- one batch -----------------------------------------------------------------------

    def _marks_after(self, batch: DataFrame, batch_id: int, done: _Done) -> _Done:
        latest = batch.agg(*[F.unix_millis(F.max(t)).alias(side) for side, t in self._times().items()]).first()
        marks = {side: mark if latest[side] is None else max(mark, latest[side] - self.delays[side])
                 for side, mark in done.marks.items()}
        mark = min(marks.values()) if self.policy == "min" else max(marks.values())
        return _Done(int(batch_id), stream_of(batch_id), marks, max(done.mark, mark))

    def _write_out(self, batch: DataFrame, batch_id: int, done: _Done, after: _Done) -> None:
        new = self._in_time(batch, done)
        pairs = self._joined(self._sales(new, done), self._returns(new, done))
        given = F.when(F.col(f"{_RETURN}{_OLD}").isNotNull(), ~(F.col(f"{_SALE}{_OLD}") & F.col(f"{_RETURN}{_OLD}"))) \
            .otherwise(~F.col(_MATCHED) & self._passed(F.col(self.sold), after))
        pairs.filter(given).select(*self.keep).write.mode("overwrite").parquet(f"{self.root}/out/{batch_id:012d}")

    def _write_open(self, batch: DataFrame, batch_id: int, done: _Done, after: _Done) -> None:
        home = self._open(batch_id)
        # Only sales that stay open, and returns that these may have, are looked at again.
        times = self._times()
        last = F.coalesce(self._passed(times[_SALE], after), F.col(_SALE).isNull()) \
            & F.coalesce(self._passed(times[_RETURN], after), F.lit(True))
        self._in_time(batch, done).filter(~last).write.mode("overwrite").parquet(f"{home}/near")
        near = batch.sparkSession.read.schema(batch.schema).parquet(f"{home}/near")
        sales = self._sales(near, done).filter(~F.coalesce(self._passed(F.col(self.sold), after), F.lit(False)))
        returns = self._returns(near, done)
        with_return = self._joined(sales, returns, "left_semi").withColumn(_MATCHED, F.lit(True))
        without = self._joined(sales, returns, "left_anti")
        with_return.unionByName(without).select(*self.sale.names, _MATCHED).write.mode("overwrite").parquet(f"{home}/sales")
        returns.filter(F.col(self.returned) > _instant(after.mark)).select(*self.back.names) \
            .write.mode("overwrite").parquet(f"{home}/returns")

    def _joined(self, sales: DataFrame, returns: DataFrame, how: str = "left_outer") -> DataFrame:
        return returned_sales(sales, returns, self.within, self.sold, self.returned, how=how, **self.names)

    def _times(self) -> dict[str, Column]:
        return {_SALE: F.col(f"{_SALE}.{self.sold}"), _RETURN: F.col(f"{_RETURN}.{self.returned}")}

    def _in_time(self, batch: DataFrame, done: _Done) -> DataFrame:
        late = F.coalesce(*self._times().values()) <= _instant(done.mark)
        return batch.filter(~F.coalesce(late, F.lit(False)))

    def _passed(self, time: Column, after: _Done) -> Column:
        """Whether no return can come any more for a sale of that time; NULL without a time."""
        return time + F.expr(f"interval {self.within}") < _instant(after.mark)

    def _sales(self, new: DataFrame, done: _Done) -> DataFrame:
        rows = new.filter(F.col(_SALE).isNotNull()).select(f"{_SALE}.*", F.lit(False).alias(_MATCHED), F.lit(False).alias(f"{_SALE}{_OLD}"))
        return self._with_open(rows, done, "sales", f"{_SALE}{_OLD}", T.StructType([*self.sale, T.StructField(_MATCHED, T.BooleanType())]))

    def _returns(self, new: DataFrame, done: _Done) -> DataFrame:
        rows = new.filter(F.col(_RETURN).isNotNull()).select(f"{_RETURN}.*", F.lit(False).alias(f"{_RETURN}{_OLD}"))
        return self._with_open(rows, done, "returns", f"{_RETURN}{_OLD}", self.back)

    def _with_open(self, rows: DataFrame, done: _Done, side: str, old: str, schema: T.StructType) -> DataFrame:
        if done.batch < 0:
            return rows
        kept = rows.sparkSession.read.schema(schema).parquet(f"{self._open(done.batch)}/{side}")
        return rows.unionByName(kept.withColumn(old, F.lit(True)))

    # -- what counts ---------------------------------------------------------------------

    def _open(self, batch_id: int) -> str:
        return f"{self.root}/open/{batch_id:012d}"

    def _done(self) -> _Done:
        notes = [n for n in files.names(self.spark, f"{self.root}/done") if n.endswith(".json") and not n.startswith(".")]
        return _Done(**json.loads(files.read_text(self.spark, f"{self.root}/done/{notes[-1]}"))) if notes else _Done()

    def _clear(self, batch_id: int) -> None:
        """Only the last batch's open rows are read again."""
        files.delete(self.spark, f"{self._open(batch_id)}/near")
        for part, last in (("open", f"{batch_id:012d}"), ("done", f"{batch_id:012d}.json")):
            for name in files.names(self.spark, f"{self.root}/{part}"):
                if name < last:
                    files.delete(self.spark, f"{self.root}/{part}/{name}")


def _plain(schema: T.StructType) -> T.StructType:
    """Without the watermark's notes."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def _instant(millis: int) -> Column:
    return F.timestamp_millis(F.lit(millis))
