"""Filtering whole documents by verdicts on their ids and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.shared import written


def keep_marked(docs: DataFrame, marks: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows that ``marks`` (_id, raw: xxhash64 of the text, stay) names: of the rows with this id and text none stays
    (stay = 0) or one (stay = 1). Rows without a mark all stay.

    Only the rows that go are marked, which are fewer than those that stay: where they are few enough to be broadcast no text is moved.
    """
    named = marks.select(F.col("_id").alias("__td_mark_id"), F.col("raw").alias("__td_mark_raw"), "stay")
    named = written(named, "marks")
    once = written(named.where("stay = 1"), "marks-once")
    rows = docs.withColumn("__td_raw", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    match = F.col(id_col).eqNullSafe(F.col("__td_mark_id")) & (F.col("__td_raw") == F.col("__td_mark_raw"))
    out = rows.join(named, match, "left_anti")
    if not once.isEmpty():
        out = out.union(rows.join(once, match, "left_semi").dropDuplicates([id_col, "__td_raw"]))
    return out.select(*docs.columns)
