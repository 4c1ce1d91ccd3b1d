"""Exact quantiles of many columns by group, narrowed together.

Every (group, column, wanted rank) has an open interval of values that holds the rank, first the whole column. While some interval
holds more than ``window_rows`` values, a round narrows all of them at once: one sketch pass for two candidates around each
rank, one count pass for what lies below and at each candidate. A rank among a candidate's ties is found; else its
interval loses at least one distinct value, usually all but a ten-thousandth. What is left is picked from the
(value, count) rows inside the intervals. State is a table with a row for each rank wanted, written every round; rows are aggregated by
(group, column, rank) before they are shuffled, so a group with a third of all rows costs what any other does.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from appraise.operators.joins import broadcast_small
from appraise.sources import io

#: State rows that may be broadcast to the scan; a larger state is joined by shuffle.
BROADCAST_STATE = 100_000


def _long(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """by (missing groups by their own key), _c (column number), _v, without missing values."""
    cells = F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(cols)])
    return df.select(*_keys(by), F.explode(cells).alias("_x")).select(*_names(by), "_x._c", "_x._v").where("_v is not null")


def _keys(by):
    """A group column as text and a flag for missing, so that plain equi-joins keep missing groups."""
    return [k for i, c in enumerate(by) for k in (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_g{i}"), F.col(c).isNull().alias(f"_n{i}"))]


def _names(by):
    return [k for i in range(len(by)) for k in (f"_g{i}", f"_n{i}")]


def _met(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(broadcast_small(state, BROADCAST_STATE), keys)


def grouped_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), *, window_rows: int = 100_000,
                      accuracy: int = 10_000) -> DataFrame:
    """by, column, n (present values), q0, q1, ...: type-7 quantiles at ``probs`` of every column in every group that has a value of it.
    A group column keeps its text; a missing group is its own, with a missing name."""
    names, probs = _names(by), [float(p) for p in probs]
    values, keys = _long(df, by, cols), [*_names(by), "_c"]
    counts = values.groupBy(*keys).agg(F.count("*").alias("_n"))
    wanted = F.array(*[F.struct(F.lit(i).alias("_p"), F.floor((F.col("_n") - 1) * p).alias("_at"), ((F.col("_n") - 1) * p).alias("_h")) for i, p in enumerate(probs)])
    asked = counts.select(*keys, "_n", F.explode(wanted).alias("w")).select(*keys, "_n", "w.*")
    asked = io.checkpoint_table(asked, "quantiles-asked")
    ranks = asked.select(*keys, "_n", F.explode(F.array("_at", F.least(F.col("_at") + 1, F.col("_n") - 1))).alias("_r")).distinct()
    none = F.lit(None).cast("double")
    state = io.checkpoint_table(ranks.select(*keys, "_r", none.alias("lo"), none.alias("hi"), F.lit(0).cast("long").alias("below"),
                                             F.col("_n").alias("inside"), none.alias("value")), "quantiles-state")
    inside = (F.col("lo").isNull() | (F.col("_v") > F.col("lo"))) & (F.col("hi").isNull() | (F.col("_v") < F.col("hi")))
    margin = 2.0 / accuracy
    steps = [i / 256 for i in range(257)]
    while not (wide := state.where(F.col("value").isNull() & (F.col("inside") > window_rows))).isEmpty():
        spans = wide.select(*keys, "lo", "hi").distinct()
        # one sketch an interval: a grid of quantiles, sharpened around the rank by its own share
        sketch = _met(values, spans, keys).where(inside).groupBy(*keys, "lo", "hi").agg(F.percentile_approx("_v", steps, accuracy).alias("grid"))
        share = (F.col("_r") - F.col("below")) / F.col("inside")
        near = wide.join(sketch.withColumnsRenamed({"lo": "_lo", "hi": "_hi"}), keys).where(F.col("lo").eqNullSafe(F.col("_lo")) & F.col("hi").eqNullSafe(F.col("_hi")))
        low, high = (F.least(F.greatest(F.floor((share - margin) * 256), F.lit(0)), F.lit(255)) + 1, F.least(F.ceil((share + margin) * 256), F.lit(256)) + 1)
        cand = near.select(*keys, "_r", F.element_at("grid", low.cast("int")).alias("a"), F.element_at("grid", high.cast("int")).alias("b"))
        cand = io.checkpoint_table(cand, "quantiles-candidates")
        v = F.col("_v")
        seen = _met(values, cand, keys).groupBy(*keys, "_r").agg(
            F.first("a").alias("a"), F.first("b").alias("b"), F.count_if(v < F.col("a")).alias("ba"), F.count_if(v == F.col("a")).alias("ea"),
            F.count_if(v < F.col("b")).alias("bb"), F.count_if(v == F.col("b")).alias("eb"))
        r, end = F.col("_r"), F.col("below") + F.col("inside")
        at_a, at_b = ((r >= F.col(x)) & (r < F.col(x) + F.col(y)) for x, y in (("ba", "ea"), ("bb", "eb")))
        past_a, past_b = r >= F.col("ba") + F.col("ea"), r >= F.col("bb") + F.col("eb")
        found = F.when(F.col("value").isNotNull(), F.col("value")).when(at_a, F.col("a")).when(at_b, F.col("b"))
        floor_at = F.when(past_b, F.col("bb") + F.col("eb")).when(past_a, F.col("ba") + F.col("ea")).otherwise(F.col("below"))
        top_at = F.when(r < F.col("ba"), F.col("ba")).when(r < F.col("bb"), F.col("bb")).otherwise(end)
        low_at = F.when(past_b, F.col("b")).when(past_a, F.col("a")).otherwise(F.col("lo"))
        high_at = F.when(r < F.col("ba"), F.col("a")).when(r < F.col("bb"), F.col("b")).otherwise(F.col("hi"))
        old = F.col("a").isNull()
        joined = state.join(seen, [*keys, "_r"], "left")
        state = io.checkpoint_table(joined.select(
            *keys, "_r", F.when(old, F.col("lo")).otherwise(low_at).alias("lo"), F.when(old, F.col("hi")).otherwise(high_at).alias("hi"),
            F.when(old, F.col("below")).otherwise(floor_at).alias("below"), F.when(old, F.col("inside")).otherwise(top_at - floor_at).alias("inside"),
            F.when(old, F.col("value")).otherwise(found).alias("value")), "quantiles-state")
    bound = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lo", "hi")]
    left = state.where("value is null").withColumn("_s", F.concat_ws("|", *bound))  # an interval's name: ranks may share one bound only
    spans = left.select(*keys, "_s", "lo", "hi", "below").distinct()
    cells = _met(values, spans, keys).where(inside).groupBy(*keys, "_s", "below", "_v").agg(F.count("*").alias("_m"))
    upto = Window.partitionBy(*keys, "_s").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.select(*keys, "_s", "_v", "_m", (F.sum("_m").over(upto) + F.col("below")).alias("_end"))
    picked = left.select(*keys, "_s", "_r").join(cells, [*keys, "_s"]).where((F.col("_r") < F.col("_end")) & (F.col("_r") >= F.col("_end") - F.col("_m")))
    known = picked.select(*keys, "_r", F.col("_v").alias("value")).union(state.where("value is not null").select(*keys, "_r", "value"))
    known = io.checkpoint_table(known, "quantiles-known")
    low = known.select(*keys, F.col("_r").alias("_at"), F.col("value").alias("x"))
    high = known.select(*keys, F.col("_r").alias("_next"), F.col("value").alias("y"))
    got = asked.withColumn("_next", F.least(F.col("_at") + 1, F.col("_n") - 1)).join(low, [*keys, "_at"]).join(high, [*keys, "_next"])
    d = F.col("_h") - F.col("_at")
    got = got.withColumn("q", F.when(d == 0, F.col("x")).otherwise(F.col("x") + (F.col("y") - F.col("x")) * d))
    wide = got.groupBy(*keys).agg(F.first("_n").alias("n"), *[F.max(F.when(F.col("_p") == i, F.col("q"))).alias(f"q{i}") for i in range(len(probs))])
    column = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_c") + 1).alias("column")
    back = [F.when(~F.col(f"_n{i}"), F.col(f"_g{i}")).cast(df.schema[c].dataType).alias(c) for i, c in enumerate(by)]
    return wide.select(*back, column, "n", *[f"q{i}" for i in range(len(probs))])
