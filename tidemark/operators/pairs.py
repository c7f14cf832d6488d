"""Sales with their returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Returns that come later than this after the sale count as not belonging to it.
RETURN_WITHIN = "30 days"


def returned_sales(sales: DataFrame, returns: DataFrame, within: str = RETURN_WITHIN, sold: str = "sold_at",
                   returned: str = "returned_at", ticket: tuple[str, str] = ("ss_ticket_number", "sr_ticket_number"),
                   item: tuple[str, str] = ("ss_item_sk", "sr_item_sk"), how: str = "left_outer") -> DataFrame:
    """Every sale with each return of its ticket and item up to ``within`` after it; NULLs without any.

    ``how`` may ask for the sales alone that have a return (``left_semi``) or none (``left_anti``).

    On streams both sides carry watermarks. A sale then waits in the state for its returns until both
    watermarks have passed the bound, and is given out without a return only then; a return waits
    until no sale before it can come any more. So state holds the sales of the bound, not all of them.
    ``streaming.pairs`` does the same for large batches, with the open rows as files.
    """
    same = (F.col(ticket[0]) == F.col(ticket[1])) & (F.col(item[0]) == F.col(item[1]))
    in_time = (F.col(returned) >= F.col(sold)) & (F.col(returned) <= F.col(sold) + F.expr(f"interval {within}"))
    return sales.join(returns, same & in_time, how)
