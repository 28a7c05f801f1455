"""Gates, contracts, tickets, cards and cases: predicates over aggregates, and the rows they make."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import cases, rank_of, review_status, task_priority
from ..functions.order import numbered
from ..functions.policy import SEVERITY_RANK
from .helpers import top_n
from .relational import churn


def severity_gate(tasks: DataFrame, kinds: Sequence[str], least: str, kind: str = "type", severity: str = "severity") -> DataFrame:
    """Violations: listed types at or above a severity."""
    return tasks.filter(F.col(kind).isin(*kinds) & (rank_of(F.col(severity), SEVERITY_RANK) >= SEVERITY_RANK[least]))


def drift_gate(base: DataFrame, now: DataFrame, key: str, stratum: str, most_churn: float = 0.05, most_delta: int = 2) -> DataFrame:
    """One row: churn, the largest change of a stratum's count, and the decision."""
    c = churn(base, now, key)
    a, b = base.groupBy(stratum).agg(F.count("*").alias("_a")), now.groupBy(stratum).agg(F.count("*").alias("_b"))
    delta = a.join(b, stratum, "full_outer").agg(F.coalesce(F.max(F.abs(F.coalesce("_a", F.lit(0)) - F.coalesce("_b", F.lit(0)))), F.lit(0)).alias("max_delta"))
    out = c.join(F.broadcast(delta))  # one row each
    return out.withColumn("passed", (F.col("churn") <= most_churn) & (F.col("max_delta") <= most_delta))


def threshold_gates(metrics: DataFrame, gates: Mapping[str, Column]) -> DataFrame:
    """One row per gate: gate, passed; ``metrics`` has one row."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("gate"), F.coalesce(v, F.lit(False)).alias("passed")) for k, v in gates.items()]))
    return metrics.select(pairs.alias("g")).select("g.*")


def all_pass(gates: DataFrame) -> DataFrame:
    return gates.agg(F.bool_and("passed").alias("passed"), F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("gate")))).alias("failed"))


def refresh_gate(rows: DataFrame, candidate: DataFrame, key: str, signature: str, errors: DataFrame) -> DataFrame:
    """blocked if rows are lost, failed if a signature changed or errors remain, else updated."""
    a, b = rows.select(key, F.col(signature).alias("_a")), candidate.select(key, F.col(signature).alias("_b"))
    j = a.join(b, key, "full_outer").agg(F.count_if(F.col("_a").isNull() | F.col("_b").isNull()).alias("lost"), F.count_if(F.col("_a") != F.col("_b")).alias("changed"))
    out = j.join(F.broadcast(errors.agg(F.count("*").alias("errors"))))
    return out.withColumn("status", cases([(F.col("lost") > 0, "blocked"), ((F.col("changed") > 0) | (F.col("errors") > 0), "failed")], "updated"))


def contract_violations(df: DataFrame, key: str, required: Sequence[str], enums: Mapping[str, Sequence[str]]) -> DataFrame:
    """key, field, problem (missing, not_allowed) of every breach."""
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    make = lambda c, p: F.struct(F.lit(c).alias("field"), F.lit(p).alias("problem"))
    checks = [F.when(blank(c), make(c, "missing")) for c in required if c in df.columns] + [make(c, "missing") for c in required if c not in df.columns]
    checks += [F.when(~blank(c) & ~F.col(c).isin(*values), make(c, "not_allowed")) for c, values in enums.items() if c in df.columns]
    return df.select(key, F.explode(F.array_compact(F.array(*checks))).alias("v")).select(key, "v.*")


def rule_breaches(df: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """key, code of every rule (its column is true when it is broken)."""
    codes = F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in rules.items()]))
    return df.select(key, F.explode(codes).alias("code"))


def missing_files(stages: DataFrame, files: DataFrame, key: str, path: str) -> DataFrame:
    """Required stage files that do not exist."""
    return stages.filter("required").join(files.select(F.col(path)).distinct(), path, "left_anti").select(key, path)


def target_coverage(rows: DataFrame, target: str) -> DataFrame:
    have = F.trim(F.coalesce(F.col(target), F.lit(""))) != ""
    return rows.agg(F.count("*").alias("rows"), F.count_if(have).alias("translated"), F.round(F.avg(have.cast("int")) * 100, 4).alias("coverage"))


def symbol_guard(rows: DataFrame, rules: DataFrame, key: str, text: str) -> DataFrame:
    """Rules (key, symbol) that their row breaks by lacking the symbol, or by not being there."""
    j = rules.join(rows.select(key, text), key, "left")
    return j.filter(~F.coalesce(F.contains(text, F.col("symbol")), F.lit(False))).select(key, "symbol")


def row_counts(**frames: DataFrame) -> DataFrame:
    """stage, n of each frame, in one action when it runs."""
    counted = [f.agg(F.count("*").alias("n")).select(F.lit(k).alias("stage"), "n") for k, f in frames.items()]
    return reduce(DataFrame.union, counted)


def review_tickets(queue: DataFrame, tasks: DataFrame, key: str) -> DataFrame:
    """Queue rows as tickets, with the priority of their task."""
    j = queue.join(tasks.select(key, "risk"), key, "left")
    return j.select(F.concat_ws(":", F.lit("ticket"), F.col(key).cast("string"), "review_source").alias("ticket_id"), key, task_priority(F.col("review_source"), F.col("risk")).alias("priority"), review_status(F.col("status")).alias("status"), F.when(F.col("review_source") == "soft_qa", "quality").otherwise("review").alias("ticket_type"))


CARD = "card_type string, run_id string, priority string, title string"


def operator_cards(tickets: DataFrame, runs: DataFrame) -> DataFrame:
    """Five kinds of cards; ``runs`` has run_id, status, verify, kpi, drift (boolean)."""
    card = lambda kind, priority: [F.lit(kind).alias("card_type"), "run_id", (priority if isinstance(priority, Column) else F.lit(priority)).alias("priority")]
    open_tickets = tickets.filter("status <> 'closed'")
    parts = [
        open_tickets.select(*card("review_ticket", F.col("priority"))), runs.filter("status IN ('fail', 'failed', 'blocked')").select(*card("runtime_alert", "P0")),
        runs.filter("drift").select(*card("governance_drift", "P1")), runs.filter("kpi NOT IN ('pass', 'ok')").select(*card("kpi_watch", "P2")),
        open_tickets.filter("priority IN ('P0', 'P1')").select("run_id").distinct().select(*card("decision_required", "P1")),
    ]
    return reduce(DataFrame.unionByName, parts)


def workspace_cases(cards: DataFrame) -> DataFrame:
    """Per run its primary card (by priority, then kind), the number of cards and the lane."""
    rank = cases([(F.col("card_type") == "runtime_alert", 0), (F.col("card_type") == "decision_required", 1), (F.col("card_type") == "review_ticket", 2), (F.col("card_type") == "governance_drift", 3)], 4)
    n = cards.groupBy("run_id").agg(F.count("*").alias("cards"))
    first = top_n(cards, ["run_id"], [F.col("priority"), rank, F.col("card_type")])
    lane = cases([(F.col("priority") == "P0", "act"), (F.col("card_type").isin("review_ticket", "decision_required"), "review")], "watch")
    return first.join(n, "run_id").select("run_id", F.col("card_type").alias("primary_card"), "priority", "cards", lane.alias("lane"))


def listing(df: DataFrame, filters: Mapping[str, object], order: Sequence[Column], n: int, allowed: Mapping[str, Sequence[object]] | None = None) -> DataFrame:
    """A filtered, ordered page; a filter outside its allowed values is an error."""
    for k, v in filters.items():
        if allowed and k in allowed and v not in allowed[k]:
            raise ValueError(f"{k}: {v!r} is not one of {', '.join(map(str, allowed[k]))}")
        df = df.filter(F.col(k) == v)
    return df.orderBy(*order).limit(n)


def justified(blockers: Column, least: int = 30) -> Column:
    return blockers >= least


def candidate_scores(docs: DataFrame, key: str, missing: Column, score: Column) -> DataFrame:
    """Style-guide candidates: those without missing sections, by score, ranked."""
    ok = docs.withColumns({"missing": missing, "score": score}).withColumn("structure_ok", F.size("missing") == 0)
    return numbered(ok, [F.desc("structure_ok"), F.desc("score"), key], "rank")


def max_passing_size(trials: DataFrame, keys: Sequence[str], size: str, passed: Column) -> DataFrame:
    """Batch-size ladder: the largest size below the first one that fails (0: none), and the latencies of passing calls."""
    per = trials.groupBy(*keys, size).agg(F.bool_and(passed).alias("ok"), F.avg("latency_ms").alias("_avg"), F.max("latency_ms").alias("_max"))
    fail = per.groupBy(*keys).agg(F.min(F.when(~F.col("ok"), F.col(size))).alias("_fail"))
    below = F.col("_fail").isNull() | (F.col(size) < F.col("_fail"))
    out = per.join(fail, list(keys)).groupBy(*keys).agg(F.coalesce(F.max(F.when(below, F.col(size))), F.lit(0)).alias("max_pass"), F.max(F.when(below, F.col("_max"))).alias("max_latency_ms"))
    return out


def pollution(rows: DataFrame, answers: DataFrame, key: str, source: str, answer: str) -> DataFrame:
    """One row: empty sources, and those that were answered all the same."""
    j = rows.select(key, source).join(answers.select(key, answer), key, "left")
    empty = F.trim(F.coalesce(F.col(source), F.lit(""))) == ""
    return j.agg(F.count_if(empty).alias("empty"), F.count_if(empty & (F.trim(F.coalesce(F.col(answer), F.lit(""))) != "")).alias("polluted"))


def positional_mismatches(expected: Column, returned: Column) -> Column:
    """Positions whose ids differ, lengths included."""
    n = F.greatest(F.size(expected), F.size(returned))
    return F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: ~F.get(expected, i).eqNullSafe(F.get(returned, i)))
