"""Joining rows with a table of their classes where one class may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.llm.columns import free_name

HEAVY_CLASSES = 1000


def spread_join(rows: DataFrame, classes: DataFrame, key: str, members: str, spread_by: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with the one row that ``classes`` has for their ``key``.

    ``members`` counts the rows of a class. A class with more than a thousandth of all counted rows, of which there are
    fewer than a thousand, is dealt over a thousand times its share of parts: its row is repeated, and each row picks a part by
    the hash of ``spread_by``. The heavy keys are broadcast, all others follow the plan that Spark picks by size.
    """
    salt, salts, total = (free_name(n, rows.columns, classes.columns) for n in ("salt", "salts", "total"))
    counted = classes.agg(F.coalesce(F.sum(members), F.lit(0)).alias(total)).first()[0]
    parts = F.greatest(F.ceil(F.col(members) * HEAVY_CLASSES / max(counted, 1)), F.lit(1)).cast("bigint")
    repeated = classes.withColumn(salts, parts)
    heavy = repeated.where(F.col(salts) > 1).select(key, salts)
    dealt = rows.join(F.broadcast(heavy), key, "left").withColumn(
        salt, F.pmod(F.xxhash64(spread_by), F.coalesce(salts, F.lit(1).cast("bigint")))
    ).drop(salts)
    copies = repeated.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(salts) - 1))).drop(salts)
    return dealt.join(copies, [key, salt], how).drop(salt)
