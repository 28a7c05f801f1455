"""Roll-ups of traces, findings, runs and glossaries.  Several groupings of one table are one pass (grouping sets)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import cases, hotspot_hint
from ..functions.text import all_matches


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def call_metrics(trace: DataFrame, ok: Column) -> DataFrame:
    """Totals over all, by step and by model in one pass; level names the grouping.

    Needs step, model, batch_rows, latency_ms, prompt, completion, cost.  Unknown steps and unnamed models get no row
    of their own.
    """
    t = trace.withColumn("_ok", ok)
    out = t.groupingSets([[], ["step"], ["model"]], "step", "model").agg(
        F.grouping_id("step", "model").alias("_g"), F.count("*").alias("batches"), F.sum("batch_rows").alias("rows"), F.sum(F.when(F.col("_ok"), F.col("batch_rows")).otherwise(0)).alias("success"),
        F.sum(F.when(~F.col("_ok"), F.col("batch_rows")).otherwise(0)).alias("failed"), F.sum("latency_ms").alias("latency_ms"), F.sum("prompt").alias("prompt"), F.sum("completion").alias("completion"), F.round(F.sum("cost"), 6).alias("cost"),
    )
    level = cases([(F.col("_g") == 3, "all"), (F.col("_g") == 1, "step")], "model")
    key = F.coalesce("step", "model", F.lit(""))
    return out.withColumns({"level": level, "key": key}).filter((F.col("level") == "all") | ~F.col("key").isin("", "unknown", "unspecified")).drop("_g", "step", "model")


def trace_cost(trace: DataFrame) -> DataFrame:
    return trace.groupBy("step", "model").agg(F.count("*").alias("calls"), F.round(F.sum("cost"), 4).alias("cost"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.min_by("request_id", F.struct("ts", "seq")).alias("first_id"))


def at_limit(trace: DataFrame, completion: str, limit: Column, share: float = 0.98) -> DataFrame:
    """One row: calls, calls at ``share`` of their limit, ratio."""
    hit = F.col(completion) >= limit * share
    return trace.agg(F.count("*").alias("calls"), F.count_if(hit).alias("hits")).withColumn("ratio", F.round(F.col("hits") / F.greatest(F.col("calls"), F.lit(1)), 6))


def limit_anomalies(trace: DataFrame, completion: str, limit: str, share: float = 0.98, most: int = 5) -> DataFrame:
    """One row: calls, calls at ``share`` of their (positive) limit, ratio, and the steps and models that have most of them.

    Counts are by step and model first, so the lists are made of a few rows; ties go by name.
    """
    hit = (F.col(limit) > 0) & (F.coalesce(F.col(completion), F.lit(0)) >= F.col(limit) * share)
    per = trace.groupBy("step", "model").agg(F.count("*").alias("calls"), F.count_if(hit).alias("hits"))
    whole = per.agg(F.sum("calls").alias("calls"), F.sum("hits").alias("hits")).withColumn("ratio", F.round(F.col("hits") / F.greatest(F.col("calls"), F.lit(1)), 4))
    for name in ("step", "model"):
        top = per.groupBy(name).agg(F.sum("hits").alias("n")).filter("n > 0").orderBy(F.desc("n"), name).limit(most)
        listed = top.agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct(-F.col("n"), name))), lambda x: x[name])).alias(f"top_{name}s"))
        whole = whole.crossJoin(F.broadcast(listed))  # one row each
    return whole


def reconciled(initial: Column, reported: Column) -> Column:
    return F.greatest(reported - initial, F.lit(0))


def indexed_percentile(values: Column, share: float) -> Column:
    """Element int(n * share) of the sorted values (the last at most); an aggregate over a bounded group."""
    xs = F.array_sort(F.collect_list(values))
    return F.get(xs, F.least(F.floor(F.size(xs) * share), F.size(xs) - 1).cast("int"))


def ranked_percentile(df: DataFrame, keys: Sequence[str], value: str, tie: str, share: float) -> DataFrame:
    """The same by rank, for groups of any size: no list is gathered."""
    w = Window.partitionBy(*keys)
    ranked = df.withColumns({"_r": F.row_number().over(w.orderBy(value, tie)) - 1, "_n": F.count("*").over(w)})
    return ranked.filter(F.col("_r") == F.least(F.floor(F.col("_n") * share), F.col("_n") - 1)).select(*keys, F.col(value).alias("percentile"))


def call_diagnostics(trace: DataFrame, last: int = 2000) -> DataFrame:
    """Of the last calls by time: counts by step and status, mean latency, splits."""
    recent = trace.orderBy(F.desc("ts"), "request_id").limit(last)
    return recent.groupBy("step", "status").agg(F.count("*").alias("n"), F.round(F.avg("latency_ms"), 4).alias("avg_latency_ms"), F.count_if(F.col("batch_rows") == 1).alias("singles"))


def validation_score(missing: Column, escalation: Column, parse: Column, cost_norm: Column) -> Column:
    return F.greatest(F.lit(0.0), 100 - 40 * missing - 30 * escalation - 20 * parse - 10 * F.least(cost_norm, F.lit(1.0)))


def batch_gate(df: DataFrame, keys: Sequence[str], valid: Column, returned: Column, expected: Column, least: float = 0.99) -> DataFrame:
    """Rates of valid JSON, equal counts and covered ids; the gate passes when all reach ``least``."""
    rate = lambda x: F.avg(x.cast("int"))
    out = df.groupBy(*keys).agg(rate(valid).alias("valid_rate"), rate(returned == expected).alias("count_rate"), (F.sum(F.least(returned, expected)) / F.sum(expected)).alias("coverage"))
    return out.withColumn("passed", F.least("valid_rate", "count_rate", "coverage") >= least)


def strict_trials(batches: DataFrame, model: str, trial: str, passed: Column, trials: int = 3) -> DataFrame:
    """A trial passes iff all its batches do; a model iff all of at least ``trials`` trials do."""
    per = batches.groupBy(model, trial).agg(F.bool_and(passed).alias("ok"))
    return per.groupBy(model).agg(F.count_if("ok").alias("passed_trials"), (F.bool_and("ok") & (F.count("*") >= trials)).alias("gate"))


def term_frequency(rows: DataFrame, text: str, module: str, weights: Mapping[str, float], line: str, pattern: str, least: int = 2) -> DataFrame:
    """term, n, weighted, stability (over the largest weight), modules (term's share per module), evidence (first four lines)."""
    weight = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.col(module)), F.lit(1.0)) if weights else F.lit(1.0)
    words = rows.select(line, module, weight.alias("_w"), F.explode(all_matches(F.col(text), pattern)).alias("term"))
    per = words.groupBy("term", module).agg(F.count("*").alias("n"), F.sum("_w").alias("w"), F.min(line).alias("at"))
    out = per.groupBy("term").agg(F.sum("n").alias("n"), F.sum("w").alias("weighted"), F.count("*").alias("modules"), F.min("at").alias("first_line")).filter(F.col("n") >= least)
    top = out.agg(F.max("weighted").alias("_top"))
    return out.join(F.broadcast(top)).withColumn("stability", F.col("weighted") / F.col("_top")).drop("_top")


def evidence_lines(rows: DataFrame, text: str, line: str, pattern: str, k: int = 4) -> DataFrame:
    """The first k lines of every term, kept by rank."""
    words = rows.select(line, F.explode(F.array_distinct(all_matches(F.col(text), pattern))).alias("term"))
    r = F.row_number().over(Window.partitionBy("term").orderBy(line))
    return words.withColumn("_r", r).filter(F.col("_r") <= k).groupBy("term").agg(F.array_sort(F.collect_list(line)).alias("evidence"))


def heuristic_frequency(rows: DataFrame, text: str, quoted: str = "[《「【](.+?)[》」】]", run: str = "[\\u4e00-\\u9fff]{2,}", quoted_weight: int = 2) -> DataFrame:
    """Quoted terms weigh two, plain runs one."""
    hits = F.concat(F.transform(all_matches(F.col(text), quoted, 1), lambda x: F.struct(x.alias("term"), F.lit(quoted_weight).alias("w"))), F.transform(all_matches(F.col(text), run), lambda x: F.struct(x.alias("term"), F.lit(1).alias("w"))))
    return rows.select(F.explode(hits).alias("h")).groupBy("h.term").agg(F.sum("h.w").alias("weight"))


def glossary_conflicts(entries: DataFrame, term: str, target: str) -> DataFrame:
    return entries.groupBy(term).agg(F.count_distinct(target).alias("targets")).filter("targets > 1")


def resolve_reviewed(entries: DataFrame, term: str, target: str) -> DataFrame:
    """term, resolved (the target if it is the only one), support, candidates (by support, then target)."""
    n = entries.groupBy(term, target).agg(F.count("*").alias("support"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("support")).alias("_s"), F.col(target).alias("target"))))
    out = n.groupBy(term).agg(F.count("*").alias("_k"), F.max("support").alias("support"), ranked.alias("_c"))
    return out.select(term, F.when(F.col("_k") == 1, F.col("_c")[0]["target"]).alias("resolved"), "support", F.transform("_c", lambda x: x["target"]).alias("candidates"))


def proposal_stats(rows: DataFrame, keys: Sequence[str], confidence: str, example: str, order: str, least: int = 2, k: int = 5) -> DataFrame:
    """support, avg_confidence and the first k examples per pair; k rows a pair are gathered at most."""
    stats = rows.groupBy(*keys).agg(F.count("*").alias("support"), F.round(F.avg(confidence), 6).alias("avg_confidence")).filter(F.col("support") >= least)
    r = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    some = rows.withColumn("_r", r).filter(F.col("_r") <= k).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, example))).alias("_e"))
    return stats.join(some, list(keys)).withColumn("examples", F.transform("_e", lambda x: x[example])).drop("_e")


def failure_rates(rows: DataFrame, findings: DataFrame, key: str, category: str) -> DataFrame:
    """Per category: rows, distinct failing ids and their rate."""
    total = rows.groupBy(category).agg(F.count("*").alias("total"))
    bad = findings.select(key).distinct().join(rows.select(key, category), key).groupBy(category).agg(F.count_distinct(key).alias("failing"))
    return total.join(bad, category, "left").withColumn("failing", F.coalesce("failing", F.lit(0))).withColumn("rate", F.round(F.col("failing") / F.col("total"), 6))


def multi_counts(df: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """Counts of several groupings in one pass; absent keys are null, level names the grouping."""
    keys = sorted({k for s in sets for k in s})
    out = df.groupingSets([list(s) for s in sets], *keys).agg(F.grouping_id(*keys).alias("_g"), F.count("*").alias("n"))
    bits = {sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in s): "+".join(s) or "all" for s in sets}
    return out.withColumn("level", cases([(F.col("_g") == b, name) for b, name in bits.items()])).drop("_g")


def compared(base: DataFrame, rerun: DataFrame, key: str) -> DataFrame:
    """Counts of two runs side by side with the rate of change."""
    a, b = base.groupBy(key).agg(F.count("*").alias("base_n")), rerun.groupBy(key).agg(F.count("*").alias("rerun_n"))
    out = a.join(b, key, "full_outer").fillna(0, ["base_n", "rerun_n"])
    return out.withColumn("rate", F.when(F.col("base_n") > 0, F.round(F.col("rerun_n") / F.col("base_n"), 6)))


def lane_metrics(rows: DataFrame, lanes: DataFrame, key: str, lane: str, counters: Sequence[str]) -> DataFrame:
    """lane, counter (column:value), n; rows without a lane count as outside_slice."""
    j = rows.join(lanes.select(key, F.col(lane).alias("_lane")), key, "left")
    pairs = F.explode(F.array(*[F.concat(F.lit(f"{c}:"), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in counters]))
    return j.select(F.coalesce("_lane", F.lit("outside_slice")).alias("lane"), pairs.alias("counter")).groupBy("lane", "counter").agg(F.count("*").alias("n"))


def repeated_sources(rows: DataFrame, source: str, target: str, blocker: Column, most: int = 6) -> DataFrame:
    """Sources that stand more than once: rows, blockers, distinct targets (the list cut at ``most``)."""
    n = rows.groupBy(source).agg(F.count("*").alias("rows"), F.count_if(blocker).alias("blockers"), F.count_distinct(target).alias("targets")).filter("rows > 1")
    return n.withColumn("action", F.when(F.col("blockers") > 0, "repair").when(F.col("targets") > 1, "unify").otherwise("keep"))


def review_kpi(tickets: DataFrame, *keys: str) -> DataFrame:
    return tickets.groupBy(*keys).agg(
        F.count("*").alias("tickets"), F.count_if(F.col("status") == "pending").alias("pending"), F.round(F.avg((F.col("status") == "closed").cast("int")), 6).alias("closure_rate"),
        F.round(F.avg((F.col("status") != "closed").cast("int")), 6).alias("manual_rate"),
    )


def coverage_matrix(stages: DataFrame, run: str, stage: str) -> DataFrame:
    """stage, run, touched; with the count and share of runs that touched the stage."""
    runs = stages.agg(F.count_distinct(run).alias("_runs"))
    n = stages.groupBy(stage).agg(F.count_distinct(run).alias("touch_count")).join(F.broadcast(runs))
    return n.withColumn("touch_ratio", F.round(F.col("touch_count") / F.col("_runs"), 6)).drop("_runs")


def pivot_matrix(stages: DataFrame, run: str, stage: str, runs: Sequence[str]) -> DataFrame:
    """One column per named run (a window of runs, so the columns are bounded)."""
    return stages.groupBy(stage).pivot(run, list(runs)).agg(F.count("*")).fillna(0)


def hotspots(issues: DataFrame, keys: Sequence[str], run: str, priority: str, order: str) -> DataFrame:
    out = issues.groupBy(*keys).agg(F.count("*").alias("occurrences"), F.count_distinct(run).alias("runs"), F.min(priority).alias("worst"), F.min_by(run, order).alias("first_run"))
    return out.withColumn("hint", hotspot_hint(F.col("worst")))


def cleanup_decision(touched: Column, blockers: Column, obsolete: Column) -> Column:
    return cases([(obsolete, "OBSOLETE"), (blockers > 0, "BLOCK"), (touched == 0, "REWORK")], "KEEP")


def length_statistics(df: DataFrame, bucket: Column) -> DataFrame:
    n = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("_t"))
    return n.join(F.broadcast(total)).select("bucket", "n", F.round(F.col("n") * 100 / F.col("_t"), 4).alias("pct"))


def semantic_stats(df: DataFrame, status: str, score: str) -> DataFrame:
    k = lambda s: F.count_if(F.col(status) == s)
    return df.agg(F.count("*").alias("total"), k("ok").alias("ok"), k("warning").alias("warnings"), k("error").alias("errors"), F.round(F.avg(score), 4).alias("average"))


def duplicate_summary(df: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys that repeat, and the rows they hold."""
    d = df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    return d.agg(F.count("*").alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


def worst_scope(df: DataFrame, key: str, scope: str, ranks: Mapping[str, int]) -> DataFrame:
    """The highest-ranked scope of each key."""
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv]), F.col(scope)), F.lit(0))
    return df.groupBy(key).agg(F.max_by(scope, F.struct(rank, F.col(scope))).alias("scope"))
