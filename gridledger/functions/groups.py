"""Rows joined with what is known of their group, however uneven the groups are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sizing import BROADCAST_BYTES, ROW_OVERHEAD

#: A group is hot if it holds more than one in so many rows. Fewer than this many groups can, so hot
#: ones are broadcast whatever the size of the data, and no other group fills a task.
HOT_SHARE = 1 << 16


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: list[str],
    count: str = "n",
    group_bytes: int = 64,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """``rows`` with the columns of their group; rows whose group is not listed, or with a null key, go.

    ``groups`` has one row for each key and the number of its rows in the column ``count``; it is read
    up to four times, so pass a stored table. ``group_bytes`` bounds the size of its rows. If all
    groups fit, they are broadcast. Else only the hot ones are, and the rest is shuffled: no task
    then gets more than one in ``hot_share`` rows of a single group.
    """
    seen = groups.agg(F.expr("count(*) as groups"), F.expr(f"coalesce(sum(`{count}`), 0) as total")).first()
    if seen["groups"] * (group_bytes + ROW_OVERHEAD) <= broadcast_bytes:
        return rows.join(F.broadcast(groups), keys)
    is_hot = F.expr(f"`{count}` * {hot_share}L > {seen['total']}L")
    hot = F.broadcast(groups.where(is_hot))
    few = rows.join(hot, keys)
    many = rows.join(hot.select(*keys), keys, "left_anti").join(groups.where(~is_hot).hint("merge"), keys)
    return few.unionByName(many)
