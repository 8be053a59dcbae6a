"""Click trails: the ordered distinct pages a visitor saw before first
reaching a target page.

Two input forms:

* **event table** (one row per event; scales with trails of any length) —
  :func:`path_to_target`.  A partial aggregate to the first sights, then one
  shuffle by trail; no join.
* **JSON trail** (one row per trail holding a JSON array whose first element
  is a header) — :func:`path_to_target_json` and :func:`trail_events`, pure
  per-row array expressions over Variant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.json import json_array, json_get, json_has


def _substring_dedup(pages: Column) -> Column:
    """Keep a page only if it is not a substring of the pages accepted so far
    joined with trailing commas (compatibility with a string-based de-dup)."""
    init = F.struct(F.lit("").alias("s"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(pages, init, lambda acc, p: F.when(
        F.contains(acc["s"], p), acc).otherwise(F.struct(
            F.concat(acc["s"], p, F.lit(",")).alias("s"),
            F.array_append(acc["out"], p).alias("out"))))["out"]


def path_to_target(events: DataFrame, trail_cols: list[str], ts_col: str, page_col: str, target: str,
                   order_col: str | None = None, type_col: str | None = None, type_value: str | None = None,
                   dedup: str = "exact") -> DataFrame:
    """One row per trail that reaches ``target`` after at least one other page:
    ``trail_cols..., path array<string>`` in order of first sight.

    A page lies before the first hit of the target exactly when its *first*
    sighting does, so no join back to the events is needed: the first sight
    of every (trail, page) is a partial aggregate (a hot trail or page costs
    one row per task before the shuffle).  The target's own first sight cuts
    each trail before its pages are collected, in the partitioning of that
    collection.  Events without a time have no place in a trail and are
    dropped.  ``order_col`` breaks ties of ``ts_col`` (e.g. an event id).
    When ``type_col`` is given only events with ``type_value`` count, both as
    pages and as the hit.
    """
    order_fields = [F.col(ts_col).alias("ts")] + ([F.col(order_col).alias("o")] if order_col else [])
    ev = events.select(*trail_cols, F.col(page_col).alias("_page"), F.struct(*order_fields).alias("_at"),
                       *([F.col(type_col)] if type_col else []))
    if type_col:
        ev = ev.where(F.col(type_col) == F.lit(type_value))
    ev = ev.where(F.col("_page").isNotNull() & F.col("_at.ts").isNotNull())

    firsts = ev.groupBy(*trail_cols, "_page").agg(F.min("_at").alias("_first"))
    hit = F.min(F.when(F.col("_page") == target, F.col("_first"))).over(Window.partitionBy(*trail_cols))
    before = firsts.withColumn("_hit", hit).where(F.col("_first") < F.col("_hit"))
    paths = (before.groupBy(*trail_cols)
             .agg(F.array_sort(F.collect_list(F.struct("_first", "_page"))).alias("_steps"))
             .select(*trail_cols, F.transform("_steps", lambda s: s["_page"]).alias("path")))
    if dedup == "substring":
        paths = paths.withColumn("path", _substring_dedup(F.col("path")))
    elif dedup != "exact":
        raise ValueError(f"unknown dedup {dedup!r}")
    return paths


def _steps(arr: Column) -> Column:
    elems = F.slice(arr, 2, F.greatest(F.size(arr) - 1, F.lit(0)))   # skip the header element
    return F.transform(elems, lambda x: F.struct(
        json_get(x, "$.feet.page").alias("page"),
        json_get(x, "$.feet.type").alias("type"),
        json_get(x, "$.t").alias("t"),
        (json_has(x, "$.t") & json_has(x, "$.feet.page") & json_has(x, "$.feet.type")).alias("ok")))


def _parsed(df: DataFrame, column: str, keep: list[str] | None) -> DataFrame:
    """``keep..., _steps``: each trail is parsed once and its steps are taken once, each behind a one-row
    generator whose output later uses read instead of computing it again."""
    parsed = df.select(*(keep or []), F.explode(F.array(json_array(column))).alias("_elements"))
    return parsed.select(*(keep or []), F.explode(F.array(_steps(F.col("_elements")))).alias("_steps"))


def trail_events(df: DataFrame, column: str, keep: list[str] | None = None) -> DataFrame:
    """Explode a JSON trail into one row per element after the header:
    ``keep..., step (0-based), t, page, type``.  Malformed trails give no rows."""
    return (_parsed(df, column, keep).select(*(keep or []), F.posexplode("_steps").alias("step", "e"))
            .select(*(keep or []), "step", "e.t", "e.page", "e.type"))


_DEDUPS = {"exact": F.array_distinct, "substring": _substring_dedup}


def path_to_target_json(df: DataFrame, column: str, target: str = "recommend", type_value: str = "pageshow",
                        keep: list[str] | None = None, strict: bool = False,
                        dedup: str | tuple[str, ...] = "exact") -> DataFrame:
    """Path to target for JSON trails, one row in, at most one row out.

    ``strict=True`` also drops a trail when any element before the hit lacks
    ``t``, ``feet.page`` or ``feet.type``; elements after the hit never matter.
    With several ways of ``dedup`` there is a row for each, told by a column
    ``dedup``; the trails are read and parsed once for all of them.
    """
    ways = (dedup,) if isinstance(dedup, str) else tuple(dedup)
    steps = F.col("_steps")
    hit = F.array_position(F.transform(steps, lambda s: (s["type"] == type_value) & (s["page"] == target)), True)
    before = F.when(hit > 1, F.slice(steps, 1, hit - 1))
    pages = F.transform(F.filter(before, lambda s: (s["type"] == type_value) & s["page"].isNotNull()),
                        lambda s: s["page"])
    # the pages are taken once, behind a generator, whatever the number of ways
    parsed = _parsed(df, column, keep).select(*(keep or []), F.explode(F.array(F.struct(
        pages.alias("pages"), F.forall(before, lambda s: s["ok"]).alias("ok")))).alias("_seen"))
    if strict:
        parsed = parsed.where(F.col("_seen.ok"))
    paths = F.array(*[F.struct(F.lit(w).alias("dedup"), _DEDUPS[w](F.col("_seen.pages")).alias("path")) for w in ways])
    out = parsed.select(*(keep or []), F.explode(paths).alias("_way")).select(*(keep or []), "_way.dedup", "_way.path")
    out = out.where(F.size("path") > 0)
    return out.drop("dedup") if isinstance(dedup, str) else out
