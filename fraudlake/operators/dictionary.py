"""M3 for columns of any number of categories: the dictionary is a table, not a list on the driver.

The categories of all columns are numbered in one order (column, then category), so the number
is the place of the category's feature in one sparse vector. Encoding is a join. Values that are
frequent in the rows to encode, at most ``HOT`` a column by their own definition, are joined by
broadcast; the other rows are shuffled, and none of their keys has more than 1 / ``HOT`` of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .ordered import running_sums
from .prep import OneHot

HOT = 256


@dataclass
class Dictionary:
    """``table``: one row ``(place, value, idx)`` per training category; ``size``: the number of features."""
    modes: dict[str, object]
    table: DataFrame
    size: int

    @classmethod
    def fit(cls, train: DataFrame, cols: list[str]) -> "Dictionary":
        """Categories of the training rows, text order within a column, NULL as the column's mode.

        A column without any value has no category.
        """
        spark = train.sparkSession
        modes = OneHot.fit_modes(train, cols)
        values = _long(train, cols, []).filter(F.col("value").isNotNull()).distinct()
        numbered = running_sums(values, ["place", "value"], [])
        path = scratch_path(spark, "dictionary")
        numbered.select("place", "value", (F.col("rn") - 1).alias("idx")).write.parquet(path)
        table = spark.read.schema("place int, value string, idx long").parquet(path)
        return cls(modes, table, table.count())

    def indices(self, df: DataFrame, id_col: str) -> DataFrame:
        """``(id_col, indices)``: the features of each row that are 1, in order.

        Ids are unique and not NULL. NULL counts as the mode; a category that training hadn't
        has no feature. A row's array has at most one entry per column.
        """
        cols = list(self.modes)
        filled = df.fillna({c: v for c, v in self.modes.items() if v is not None})
        long = _long(filled, cols, [id_col]).filter(F.col("value").isNotNull())
        per_value = long.groupBy("place", "value").agg(F.count(F.lit(1)).alias("n"))
        total = per_value.groupBy("place").agg(F.sum("n").alias("total"))  # one row a column
        coded = per_value.join(F.broadcast(total), "place").join(self.table, ["place", "value"], "left")
        path = scratch_path(df.sparkSession, "coded")
        coded.select("place", "value", "idx", (F.col("n") * HOT >= F.col("total")).alias("hot")).write.parquet(path)
        coded = df.sparkSession.read.schema("place int, value string, idx long, hot boolean").parquet(path)
        known = long.join(F.broadcast(coded.filter("hot")), ["place", "value"], "left")
        rare = known.filter(F.col("hot").isNull()).select(id_col, "place", "value")
        found = known.filter("hot").select(id_col, "idx").unionByName(
            rare.join(coded.filter(~F.col("hot")).select("place", "value", "idx"), ["place", "value"]).select(id_col, "idx"))
        per_row = found.filter(F.col("idx").isNotNull()).groupBy(id_col).agg(F.array_sort(F.collect_list("idx")).alias("indices"))
        return df.select(id_col).join(per_row, id_col, "left").select(
            id_col, F.coalesce("indices", F.array().cast("array<bigint>")).alias("indices"))


def _long(df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """One row ``(*keep, place, value)`` per row and column; ``place`` is the column's."""
    pairs = F.array(*[F.struct(F.lit(i).alias("place"), F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)])
    return df.select(*keep, F.inline(pairs))
