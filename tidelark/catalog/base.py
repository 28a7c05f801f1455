"""Binding of the operators to the driver's tables, and the registry of queries with their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its oracle where SQL has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_PH, _TAG = "'⟦PH_' || CAST(doc_id % 7 AS STRING) || '⟧'", "'⟦TAG_' || CAST(doc_id % 5 AS STRING) || '⟧'"
_SOURCE = f"{_PH} || ' ' || text || ' ' || {_TAG}"
#: The string table: documents with tokens laid in, and a target with known faults.
STRINGS = {
    "string_id": "'S' || CAST(doc_id AS STRING)",
    "seq": "doc_id",
    "source_text": _SOURCE,
    "target_text": f"CASE doc_id % 6 WHEN 0 THEN text WHEN 1 THEN {_PH} || ' ' || {_SOURCE} WHEN 2 THEN '' WHEN 3 THEN replace({_SOURCE}, 'the', 'ze') || ' TODO' WHEN 4 THEN {_SOURCE} || ' {{0}}' ELSE {_SOURCE} END",
    "module": "source",
    "locale": "lang",
}
#: Short strings of a UI, by id.
_UI = ["荐", "极品", "商店", "巅峰列传", "首充礼包", "元素之力", "击破气球获得幸运值，累满幸运必得大奖", "十连", "领取{0}奖励", "人间道·灵魂吞噬", "奖励预览", "", "仙之试炼", "活动开始 请确认"]
UI_STRINGS = {
    "string_id": "CASE WHEN doc_id % 3 = 0 THEN 'BTN_' WHEN doc_id % 3 = 1 THEN 'ROW_' ELSE 'SKILL_' END || CAST(doc_id AS STRING)",
    "seq": "doc_id",
    "source_zh": f"CASE doc_id % {len(_UI)} " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_UI)) + " END",
    "module_tag": "CASE doc_id % 5 WHEN 0 THEN 'main_button' WHEN 1 THEN 'shop_page' WHEN 2 THEN 'quest_log' WHEN 3 THEN 'season_pass' ELSE source END",
}
#: A trace of model calls.
TRACE = {
    "request_id": "'R' || CAST(event_id AS STRING)",
    "seq": "event_id",
    "step": "event_type",
    "model": "'m' || CAST(user_id % 5 AS STRING)",
    "ts": "CAST(ts AS TIMESTAMP)",
    "latency_ms": "CAST(event_id * 37 % 4000 AS BIGINT)",
    "prompt_tokens": "CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id * 13 % 900 AS BIGINT) END",
    "completion_tokens": "CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id * 7 % 300 AS BIGINT) END",
    "req_chars": "CAST(event_id * 11 % 2000 AS BIGINT)",
    "resp_chars": "CAST(event_id * 5 % 800 AS BIGINT)",
    "status": "CASE WHEN event_id % 17 = 0 THEN 'error' ELSE 'ok' END",
    "batch_rows": "CAST(event_id % 25 + 1 AS BIGINT)",
}
#: A glossary: product names with brand scopes; names repeat with other targets.
GLOSSARY = {
    "term": "p_name",
    "target": "p_type || ' ' || CAST(p_size % 3 AS STRING)",
    "scope": "CASE p_partkey % 4 WHEN 0 THEN 'project' WHEN 1 THEN 'ip' WHEN 2 THEN 'genre' ELSE 'base' END",
    "status": "CASE WHEN p_partkey % 5 = 0 THEN 'proposed' WHEN p_partkey % 7 = 0 THEN 'banned' ELSE 'approved' END",
    "confidence": "CAST(p_partkey % 100 AS DOUBLE) / 100",
    "seq": "p_partkey",
}
#: Review tickets.
TICKETS = {
    "ticket_id": "o_orderkey",
    "run_id": "'run_' || CAST(o_custkey % 40 AS STRING)",
    "priority": "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'P0' WHEN '2' THEN 'P1' ELSE 'P2' END",
    "status": "CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'closed' ELSE 'in_review' END",
    "review_source": "CASE o_orderkey % 3 WHEN 0 THEN 'post_gate_blocked' WHEN 1 THEN 'soft_qa' ELSE 'execution_failure' END",
    "locale": "CASE o_orderkey % 2 WHEN 0 THEN 'ru-RU' ELSE 'en-US' END",
    "opened": "CAST(o_orderdate AS TIMESTAMP)",
    "cost": "o_totalprice",
}
#: Stages of runs: the lines of an order.
STAGES = {
    "run_id": "'run_' || CAST(l_orderkey % 200 AS STRING)",
    "stage": "'stage_' || CAST(l_linenumber AS STRING)",
    "status": "CASE WHEN l_returnflag = 'R' THEN 'failed' WHEN l_linestatus = 'O' THEN 'warn' ELSE 'ok' END",
    "required": "l_linenumber < 5",
    "files": "CAST(l_quantity AS BIGINT) % 3",
    "error_code": "'E' || CAST(l_suppkey % 20 AS STRING)",
    "priority": "'P' || CAST(l_partkey % 4 AS STRING)",
    "seq": "l_orderkey * 10 + l_linenumber",
    "ts": "CAST(l_shipdate AS TIMESTAMP)",
}
BOUND = {"strings": ("documents", STRINGS), "ui": ("documents", UI_STRINGS), "trace": ("events", TRACE), "glossary": ("part", GLOSSARY), "tickets": ("orders", TICKETS), "stages": ("lineitem", STAGES)}


def bound(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns = BOUND[name]
    return read(spark, sf_dir, table).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def cte(*names: str) -> str:
    """The same tables for the oracle."""
    return "WITH " + ", ".join(f"{n} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in BOUND[n][1].items())} FROM {BOUND[n][0]})" for n in names) + " "
