"""Joining a small aggregate or dimension onto row-level data.

The planner cannot know the size of an aggregate before it runs, so a
``rows JOIN group_totals`` is planned as a sort-merge join and the row side
is shuffled even when AQE later sees that the totals are tiny. Here the
small side is materialised once (reliable checkpoint), its row count is
checked, and only then is it broadcast; above the bound the join stays a
shuffle join (AQE can still split skewed partitions).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from strataforge.session import ensure_checkpoint_dir

BROADCAST_ROWS = 2_000_000


def join_bounded(big: DataFrame, small: DataFrame, on, how: str = "left",
                 max_rows: int = BROADCAST_ROWS, null_safe: bool = False) -> DataFrame:
    """``big.join(small, on, how)`` with ``small`` broadcast only when its
    checked row count is at most ``max_rows``. ``null_safe`` (column names in
    ``on``) lets null keys meet."""
    from pyspark.sql import functions as F

    ensure_checkpoint_dir(small.sparkSession)
    small = small.checkpoint(eager=True)
    n = small.count()
    if null_safe:
        on = [on] if isinstance(on, str) else list(on)
        small = small.withColumnsRenamed({c: f"__on_{c}" for c in on})
        same = [big[c].eqNullSafe(small[f"__on_{c}"]) for c in on]
        joined = big.join(F.broadcast(small) if n <= max_rows else small, reduce(lambda a, b: a & b, same), how)
        return joined.drop(*[f"__on_{c}" for c in on])
    return big.join(F.broadcast(small) if n <= max_rows else small, on, how)
