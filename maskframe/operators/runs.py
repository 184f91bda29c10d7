"""Records of runs: timings, caches, reuse of results, and log tails."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Phases whose sum is a run's total.
PHASES = ["import_seconds", "device_seconds", "load_seconds", "inference_seconds", "startup_seconds", "read_seconds", "write_seconds"]


def timing_rollup(steps: DataFrame) -> DataFrame:
    """(run, key, seconds): the largest start-up time, since it is shared, and the sum of every other key."""
    value = F.when(F.col("key") == "startup_seconds", F.max("seconds")).otherwise(F.sum("seconds"))
    return steps.groupBy("run", "key").agg(value.alias("seconds"))


def timing_total(rollup: DataFrame) -> DataFrame:
    """A run's total over the phases; detail keys don't count."""
    return rollup.groupBy("run").agg(F.coalesce(F.sum(F.when(F.col("key").isin(*PHASES), F.col("seconds"))), F.lit(0.0)).alias("total_seconds"))


def result_reuse(steps: DataFrame) -> DataFrame:
    """Within a run and timepoint equal keys are computed once, at their first step that didn't fail; later ones take no time."""
    same = Window.partitionBy("run", "timepoint", "key").orderBy("seq")
    done = F.first(F.when(~F.col("failed"), F.col("seq")), ignorenulls=True).over(same.rowsBetween(Window.unboundedPreceding, -1))
    return steps.withColumn("reused_from", done).withColumns({"result_cache_hit": F.col("reused_from").isNotNull(), "runtime_seconds": F.when(F.col("reused_from").isNotNull(), 0.0).otherwise(F.col("seconds"))})


def cache_rollup(steps: DataFrame) -> DataFrame:
    """By run: results taken from the cache, and model loads and reuses among the others."""
    hit, model = F.col("result_cache_hit"), F.col("model_cache_hit")
    count = lambda c: F.sum(c.cast("long"))
    return steps.groupBy("run").agg(count(hit).alias("result_hits"), count(~hit & model).alias("model_hits"), count(~hit & ~model).alias("model_misses"), F.sum("runtime_seconds").alias("runtime_seconds"))


def compact_log(lines: DataFrame, starts: str, ends: list[str], drops: str) -> DataFrame:
    """Lines of a polled log: outside a tail all stay; within one, between a line with `starts` and one with any of `ends`
    or `drops`, each text stays once. The lines that open a tail and those with `drops` go. (log, line, text) -> the same."""
    text = F.col("text")
    opens, shuts, gone = text.contains(starts), functools.reduce(operator.or_, (text.contains(e) for e in ends)), text.contains(drops)
    mark = F.when(opens, True).when(shuts | gone, False)
    order = Window.partitionBy("log").orderBy("line")
    state = lines.withColumn("inside", F.coalesce(F.last(mark, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))).withColumn("role", F.when(opens, "open").when(F.col("inside") & gone, "drop").when(F.col("inside") & shuts, "shut").when(F.col("inside"), "tail").otherwise("plain"))
    payload = F.trim(F.regexp_replace(text, r"^\s*\*\s?", ""))
    first = F.row_number().over(Window.partitionBy("log", "role", "payload").orderBy("line")) == 1
    kept = state.withColumn("payload", payload).withColumn("first", first).filter("role = 'plain' or role = 'shut' or (role = 'tail' and payload <> '' and first)")
    return kept.select("log", "line", F.when(F.col("role") == "tail", F.concat(F.lit("\t* "), "payload")).otherwise(text).alias("text"))
