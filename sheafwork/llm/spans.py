"""Matches of a text joined into spans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPAN = "start:int,end:int,first_doc_id:bigint"


def joined_spans(matches: DataFrame, least: int) -> DataFrame:
    """``doc_id``, ``mark``, ``spans`` from rows ``doc_id``, ``mark``, ``start``, ``end``, ``first_doc_id``.

    Matches that overlap or touch are one span, under the least original; spans shorter than ``least``
    are left out, and so are texts without any. The matches of one text are bounded by its length.
    """
    match = F.struct("start", "end", "first_doc_id")
    per_text = matches.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list(match)).alias("found"))
    shape = f"struct<done:array<struct<{_SPAN}>>,{_SPAN}>"
    empty = F.from_json(F.lit('{"done":[],"start":-1,"end":-1}'), shape)

    def closed(acc):
        span = F.struct(acc["start"].alias("start"), acc["end"].alias("end"), acc["first_doc_id"].alias("first_doc_id"))
        return F.when(acc["end"] - acc["start"] >= least, F.concat(acc["done"], F.array(span))).otherwise(acc["done"])

    def step(acc, m):
        joins = m["start"] <= acc["end"]
        return F.struct(
            F.when(joins, acc["done"]).otherwise(closed(acc)).alias("done"),
            F.when(joins, acc["start"]).otherwise(m["start"]).alias("start"),
            F.when(joins, F.greatest(acc["end"], m["end"])).otherwise(m["end"]).alias("end"),
            F.when(joins, F.least(acc["first_doc_id"], m["first_doc_id"])).otherwise(m["first_doc_id"]).alias("first_doc_id"),
        ).cast(shape)

    spans = per_text.select("doc_id", "mark", F.aggregate("found", empty, step, closed).alias("spans"))
    return spans.filter(F.size("spans") > 0)
