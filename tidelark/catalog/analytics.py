"""Queries of the aggregations, vectors and JSON functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import jsonx as X
from ..functions import vectors as V
from ..operators import analytics as A
from .base import bound, cte, query, read

c = F.col


@query("SELECT event_type, count(*) AS n FROM events GROUP BY ALL")
def a01_count_by(spark, d):
    return A.count_by(read(spark, d, "events"), "event_type")


_M = "count(*) AS batches, sum(batch_rows) AS rows, sum(CASE WHEN status = 'ok' THEN batch_rows ELSE 0 END) AS success, sum(CASE WHEN status <> 'ok' THEN batch_rows ELSE 0 END) AS failed, sum(latency_ms) AS latency_ms, sum(p) AS prompt, sum(q) AS completion, round(sum((p * 4 + q * 16) / 1e7::DOUBLE), 6) AS cost"


@query(cte("trace") + f", t AS (SELECT *, coalesce(prompt_tokens, 0) AS p, coalesce(completion_tokens, 0) AS q FROM trace) SELECT 'all' AS level, '' AS key, {_M} FROM t UNION ALL SELECT 'step', step, {_M} FROM t GROUP BY step UNION ALL SELECT 'model', model, {_M} FROM t GROUP BY model")
def a02_call_metrics(spark, d):
    t = bound(spark, d, "trace").withColumns({"prompt": F.coalesce("prompt_tokens", F.lit(0)), "completion": F.coalesce("completion_tokens", F.lit(0))})
    return A.call_metrics(t.withColumn("cost", (c("prompt") * 4 + c("completion") * 16) / 1e7), c("status") == "ok")


@query(cte("trace") + "SELECT count(DISTINCT CASE WHEN status = 'ok' THEN step END) AS steps FROM trace")
def a03_distinct_steps(spark, d):
    return bound(spark, d, "trace").agg(F.count_distinct(F.when(c("status") == "ok", c("step"))).alias("steps"))


@query(cte("trace") + "SELECT step, model, count(*) AS calls, round(sum(latency_ms / 1000.0::DOUBLE), 4) AS cost, arg_min(request_id, (ts, seq)) AS first_id FROM trace GROUP BY ALL")
def a04_trace_cost(spark, d):
    return A.trace_cost(bound(spark, d, "trace").withColumn("cost", c("latency_ms") / 1000.0)).drop("first_ts", "last_ts")


@query(cte("trace") + "SELECT count(*) AS calls, count(*) FILTER (completion_tokens >= 290 * 0.98::DOUBLE) AS hits, round(count(*) FILTER (completion_tokens >= 290 * 0.98::DOUBLE) / count(*), 6) AS ratio FROM trace")
def a05_at_limit(spark, d):
    return A.at_limit(bound(spark, d, "trace"), "completion_tokens", F.lit(290))


@query(cte("trace") + "SELECT step, list_sort(list(latency_ms))[least(CAST(floor(count(*) * 0.95::DOUBLE) AS BIGINT), count(*) - 1) + 1] AS percentile FROM trace GROUP BY step")
def a07_indexed_percentile(spark, d):
    return A.ranked_percentile(bound(spark, d, "trace"), ["step"], "latency_ms", "seq", 0.95)


@query(cte("trace") + ", r AS (SELECT * FROM trace ORDER BY ts DESC, request_id LIMIT 2000) SELECT step, status, count(*) AS n, round(avg(latency_ms), 4) AS avg_latency_ms, count(*) FILTER (batch_rows = 1) AS singles FROM r GROUP BY ALL")
def a08_call_diagnostics(spark, d):
    return A.call_diagnostics(bound(spark, d, "trace"))


@query(cte("trace") + ", m AS (SELECT model, avg(CASE WHEN prompt_tokens IS NULL THEN 1.0 ELSE 0.0 END) AS a, avg(CASE WHEN status <> 'ok' THEN 1.0 ELSE 0.0 END) AS b, avg(CASE WHEN seq % 9 = 0 THEN 1.0 ELSE 0.0 END) AS p, least(1.0, avg(latency_ms) / 4000) AS k FROM trace GROUP BY model) SELECT model, round(greatest(0, 100 - 40 * a - 30 * b - 20 * p - 10 * k), 4) AS score FROM m")
def a09_validation_score(spark, d):
    rate = lambda x: F.avg(x.cast("int"))
    m = bound(spark, d, "trace").groupBy("model").agg(rate(c("prompt_tokens").isNull()).alias("a"), rate(c("status") != "ok").alias("b"), rate(c("seq") % 9 == 0).alias("p"), (F.avg("latency_ms") / 4000).alias("k"))
    return m.select("model", F.round(A.validation_score(c("a"), c("b"), c("p"), c("k")), 4).alias("score"))


@query(cte("trace") + "SELECT model, avg(CASE WHEN status = 'ok' THEN 1.0 ELSE 0 END) AS valid_rate, avg(CASE WHEN batch_rows = 5 THEN 1.0 ELSE 0 END) AS count_rate, sum(least(batch_rows, 5)) / sum(5) AS coverage, false AS passed FROM trace GROUP BY model")
def a10_batch_gate(spark, d):
    return A.batch_gate(bound(spark, d, "trace"), ["model"], c("status") == "ok", c("batch_rows"), F.lit(5))


@query(cte("trace") + ", p AS (SELECT model, step, bool_and(seq % 1000 <> 3) AS ok FROM trace GROUP BY ALL) SELECT model, count(*) FILTER (ok) AS passed_trials, bool_and(ok) AND count(*) >= 3 AS gate FROM p GROUP BY model")
def a11_strict_trials(spark, d):
    return A.strict_trials(bound(spark, d, "trace"), "model", "step", c("seq") % 1000 != 3)


@query("WITH w AS (SELECT doc_id, source, unnest(regexp_extract_all(text, '[A-Za-z]{4,}')) AS term FROM documents), t AS (SELECT term, count(*) AS n, count(*) * 1.0 AS weighted, count(DISTINCT source) AS modules, min(doc_id) AS first_line FROM w GROUP BY term HAVING count(*) >= 40) SELECT term, n, modules, first_line, round(weighted / max(weighted) OVER (), 6) AS stability FROM t")
def a12_term_frequency(spark, d):
    out = A.term_frequency(read(spark, d, "documents"), "text", "source", {}, "doc_id", "[A-Za-z]{4,}", 40)
    return out.select("term", "n", "modules", "first_line", F.round("stability", 6).alias("stability"))


@query(cte("ui") + ", w AS (SELECT unnest(regexp_extract_all('《' || source_zh || '》', '[《「【](.+?)[》」】]', 1)) AS term, 2 AS w FROM ui UNION ALL SELECT unnest(regexp_extract_all('《' || source_zh || '》', '[一-鿿]{2,}')), 1 FROM ui) SELECT term, sum(w) AS weight FROM w GROUP BY term")
def a13_heuristic_frequency(spark, d):
    return A.heuristic_frequency(bound(spark, d, "ui").withColumn("t", F.concat(F.lit("《"), "source_zh", F.lit("》"))), "t")


@query(cte("glossary") + "SELECT term, count(DISTINCT target) AS targets FROM glossary GROUP BY term HAVING count(DISTINCT target) > 1")
def a14_glossary_conflicts(spark, d):
    return A.glossary_conflicts(bound(spark, d, "glossary"), "term", "target")


@query(cte("glossary") + ", n AS (SELECT term, target, count(*) AS s FROM glossary GROUP BY ALL) SELECT term, CASE WHEN count(*) = 1 THEN min(target) END AS resolved, max(s) AS support, string_agg(target, ',' ORDER BY s DESC, target) AS candidates FROM n GROUP BY term")
def a15_resolve_reviewed(spark, d):
    return A.resolve_reviewed(bound(spark, d, "glossary"), "term", "target").withColumn("candidates", F.concat_ws(",", "candidates"))


@query(cte("glossary") + ", s AS (SELECT term, scope, count(*) AS support, round(avg(confidence), 6) AS avg_confidence FROM glossary GROUP BY ALL HAVING count(*) >= 2), e AS (SELECT term, scope, string_agg(target, '|' ORDER BY seq) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY term, scope ORDER BY seq) AS r FROM glossary) WHERE r <= 5 GROUP BY ALL) SELECT s.*, examples FROM s JOIN e USING (term, scope)")
def a16_proposal_stats(spark, d):
    return A.proposal_stats(bound(spark, d, "glossary"), ["term", "scope"], "confidence", "target", "seq").withColumn("examples", F.concat_ws("|", "examples"))


@query("SELECT lang, count(*) AS total, count(*) FILTER (toxic = 1) AS failing, round(count(*) FILTER (toxic = 1) / count(*), 6) AS rate FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def a17_failure_rates(spark, d):
    return A.failure_rates(read(spark, d, "documents"), read(spark, d, "labels").filter("toxic = 1"), "doc_id", "lang")


@query(cte("tickets") + "SELECT review_source, status, count(*) AS n FROM tickets GROUP BY ALL")
def a18_review_metrics(spark, d):
    return A.count_by(bound(spark, d, "tickets"), "review_source", "status")


@query(cte("tickets") + "SELECT 'status' AS level, status, NULL AS priority, NULL AS locale, count(*) AS n FROM tickets GROUP BY status UNION ALL SELECT 'priority', NULL, priority, NULL, count(*) FROM tickets GROUP BY priority UNION ALL SELECT 'priority+status', status, priority, NULL, count(*) FROM tickets GROUP BY ALL UNION ALL SELECT 'locale+status', status, NULL, locale, count(*) FROM tickets GROUP BY ALL")
def a19_multi_counts(spark, d):
    return A.multi_counts(bound(spark, d, "tickets"), [["status"], ["priority"], ["priority", "status"], ["locale", "status"]])


@query(cte("tickets") + "SELECT run_id, count(*) AS n FROM tickets WHERE priority = 'P0' GROUP BY run_id ORDER BY n DESC, min(ticket_id) LIMIT 20")
def a20_top_violations(spark, d):
    from ..operators.relational import most_common

    return most_common(bound(spark, d, "tickets").filter("priority = 'P0'"), "run_id", "ticket_id", 20)


@query("WITH a AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS base_n, coalesce(b.n, 0) AS rerun_n, CASE WHEN a.n > 0 THEN round(coalesce(b.n, 0) / a.n, 6) END AS rate FROM a FULL JOIN b ON a.k = b.k")
def a21_compared(spark, d):
    return A.compared(read(spark, d, "customer").select(c("c_nationkey").alias("k")), read(spark, d, "supplier").select(c("s_nationkey").alias("k")), "k")


@query("SELECT lane, counter, count(*) AS n FROM (SELECT coalesce(CASE toxic WHEN 1 THEN 'toxic' WHEN 0 THEN 'clean' END, 'outside_slice') AS lane, unnest(['lang:' || lang, 'source:' || source]) AS counter FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY ALL")
def a22_lane_metrics(spark, d):
    lanes = read(spark, d, "labels").select("doc_id", F.when(c("toxic") == 1, "toxic").otherwise("clean").alias("lane"))
    return A.lane_metrics(read(spark, d, "documents"), lanes, "doc_id", "lane", ["lang", "source"])


@query("SELECT text AS source_text, count(*) AS rows, count(*) FILTER (lang = 'en') AS blockers, count(DISTINCT source) AS targets, CASE WHEN count(*) FILTER (lang = 'en') > 0 THEN 'repair' WHEN count(DISTINCT source) > 1 THEN 'unify' ELSE 'keep' END AS action FROM documents GROUP BY text HAVING count(*) > 1")
def a24_repeated_sources(spark, d):
    return A.repeated_sources(read(spark, d, "documents").withColumnRenamed("text", "source_text"), "source_text", "source", c("lang") == "en")


@query(cte("tickets") + "SELECT locale, count(*) AS tickets, count(*) FILTER (status = 'pending') AS pending, round(avg(CASE WHEN status = 'closed' THEN 1.0 ELSE 0 END), 6) AS closure_rate, round(avg(CASE WHEN status <> 'closed' THEN 1.0 ELSE 0 END), 6) AS manual_rate FROM tickets GROUP BY locale")
def a25_review_kpi(spark, d):
    return A.review_kpi(bound(spark, d, "tickets"), "locale")


@query(cte("stages") + "SELECT stage, count(DISTINCT run_id) AS touch_count, round(count(DISTINCT run_id) / (SELECT count(DISTINCT run_id) FROM stages), 6) AS touch_ratio FROM stages GROUP BY stage")
def a26_coverage_matrix(spark, d):
    return A.coverage_matrix(bound(spark, d, "stages"), "run_id", "stage")


@query(cte("stages") + "SELECT stage, error_code, count(*) AS occurrences, count(DISTINCT run_id) AS runs, min(priority) AS worst, arg_min(run_id, (seq, run_id)) AS first_run, CASE min(priority) WHEN 'P0' THEN 'BLOCK' WHEN 'P1' THEN 'REWORK' WHEN 'P2' THEN 'REWORK' ELSE 'KEEP' END AS hint FROM stages GROUP BY ALL")
def a27_hotspots(spark, d):
    return A.hotspots(bound(spark, d, "stages").withColumn("at", F.struct("seq", "run_id")), ["stage", "error_code"], "run_id", "priority", "at")


@query(cte("stages") + "SELECT CASE WHEN stage = 'stage_7' THEN 'OBSOLETE' WHEN count(*) FILTER (priority = 'P0' AND status = 'failed' AND required) > 0 THEN 'BLOCK' ELSE 'KEEP' END AS decision, stage FROM stages GROUP BY stage")
def a28_cleanup_decision(spark, d):
    s = bound(spark, d, "stages").groupBy("stage").agg(F.count("*").alias("n"), F.count_if((c("priority") == "P0") & (c("status") == "failed") & c("required")).alias("b"))
    return s.select("stage", A.cleanup_decision(c("n"), c("b"), c("stage") == "stage_7").alias("decision"))


@query(cte("stages") + "SELECT 'priority' AS level, priority, NULL AS stage, count(*) AS n FROM stages GROUP BY priority UNION ALL SELECT 'stage', NULL, stage, count(*) FROM stages GROUP BY stage")
def a29_issue_summary(spark, d):
    return A.multi_counts(bound(spark, d, "stages"), [["priority"], ["stage"]])


@query(cte("tickets") + "SELECT count(DISTINCT run_id) AS runs, count(*) FILTER (status = 'pending') AS open_tickets, count(DISTINCT CASE WHEN review_source = 'post_gate_blocked' THEN run_id END) AS drifted FROM tickets")
def a30_workspace_overview(spark, d):
    return bound(spark, d, "tickets").agg(F.count_distinct("run_id").alias("runs"), F.count_if(c("status") == "pending").alias("open_tickets"), F.count_distinct(F.when(c("review_source") == "post_gate_blocked", c("run_id"))).alias("drifted"))


@query(cte("tickets") + "SELECT status, count(*) AS n FROM tickets WHERE locale <> 'ru-RU' GROUP BY status")
def a31_task_overview(spark, d):
    return A.count_by(bound(spark, d, "tickets").filter("locale <> 'ru-RU'"), "status")


@query(cte("glossary") + "SELECT term, arg_max(scope, (CASE scope WHEN 'project' THEN 4 WHEN 'ip' THEN 3 WHEN 'genre' THEN 2 ELSE 1 END, scope)) AS scope FROM glossary GROUP BY term")
def a33_worst_scope(spark, d):
    return A.worst_scope(bound(spark, d, "glossary"), "term", "scope", {"project": 4, "ip": 3, "genre": 2, "base": 1})


@query("SELECT count(*) AS keys, coalesce(sum(n), 0) AS rows FROM (SELECT text, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)")
def a35_duplicate_summary(spark, d):
    return A.duplicate_summary(read(spark, d, "documents"), "text")


@query("SELECT bucket, n, round(n * 100 / sum(n) OVER (), 4) AS pct FROM (SELECT CASE WHEN n_chars >= 1000 THEN 1000 WHEN n_chars >= 500 THEN 500 WHEN n_chars >= 200 THEN 200 WHEN n_chars >= 100 THEN 100 WHEN n_chars >= 50 THEN 50 ELSE 0 END AS bucket, count(*) AS n FROM documents GROUP BY 1)")
def a36_length_statistics(spark, d):
    return A.length_statistics(read(spark, d, "documents"), C.length_bucket(c("n_chars")))


@query(cte("tickets") + "SELECT ticket_id % 3 AS round, count(*) AS tasks, count(*) FILTER (status = 'closed') AS repaired FROM tickets GROUP BY ALL")
def a37_repair_rounds(spark, d):
    return bound(spark, d, "tickets").groupBy((c("ticket_id") % 3).alias("round")).agg(F.count("*").alias("tasks"), F.count_if(c("status") == "closed").alias("repaired"))


@query(cte("trace") + "SELECT step, round(sum(latency_ms) * 1000.0 / sum(batch_rows), 4) AS cost_per_1k FROM trace GROUP BY step")
def a38_cost_per_thousand(spark, d):
    return bound(spark, d, "trace").groupBy("step").agg(F.round(F.sum("latency_ms") * 1000.0 / F.sum("batch_rows"), 4).alias("cost_per_1k"))


@query("SELECT CASE WHEN n_chars < 60 THEN 'skipped_empty' WHEN quality IS NOT NULL THEN 'translated' ELSE 'missing_translation' END AS delivery_status, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL")
def a39_delivery_counts(spark, d):
    from ..operators.relational import restore_delivery

    out = restore_delivery(read(spark, d, "documents"), read(spark, d, "labels"), "doc_id", c("n_chars") < 60, c("quality").isNotNull())
    return A.count_by(out, "delivery_status")


# -- vectors -------------------------------------------------------------------------------------------------------


@query("SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding FROM embeddings WHERE vec_id = 0)::DOUBLE[]), 5) AS similarity FROM embeddings")
def v01_v02_cosine(spark, d):
    e = read(spark, d, "embeddings")
    one = e.filter("vec_id = 0").select(c("embedding").alias("q"))
    return e.join(F.broadcast(one)).select("vec_id", F.round(V.cosine(c("embedding"), c("q")), 5).alias("similarity"))


@query("WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id < 3), s AS (SELECT e.vec_id AS term, max(list_cosine_similarity(e.embedding::DOUBLE[], q.v::DOUBLE[])) AS s FROM embeddings e, q GROUP BY 1), t AS (SELECT * FROM s ORDER BY s DESC, term LIMIT 15) SELECT term, round(s, 5) AS similarity FROM t WHERE s > 0.3")
def v03_retrieve_terms(spark, d):
    e = read(spark, d, "embeddings").select(c("vec_id").alias("term"), "embedding")
    queries = e.filter("term < 3").select(c("embedding").alias("q"))
    return V.retrieve(e, queries, "term", "embedding", "q").withColumn("similarity", F.round("similarity", 5))


@query("WITH p AS (SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS s FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1), k AS (SELECT *, CASE WHEN s < 0.5 THEN 'error' WHEN s < 0.65 THEN 'warning' ELSE 'ok' END AS st FROM p) SELECT count(*) AS total, count(*) FILTER (st = 'ok') AS ok, count(*) FILTER (st = 'warning') AS warnings, count(*) FILTER (st = 'error') AS errors, round(avg(s), 4) AS average FROM k")
def v04_a34_semantic_scores(spark, d):
    e = read(spark, d, "embeddings")
    pairs = e.join(e.select((c("vec_id") - 1).alias("vec_id"), c("embedding").alias("other")), "vec_id")
    scored = pairs.select(F.round(V.cosine(c("embedding"), c("other")), 4).alias("s"))
    return A.semantic_stats(scored.withColumn("status", C.semantic_status(c("s"))), "status", "s")


# -- JSON ------------------------------------------------------------------------------------------------------------


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) > 50")
def x05_nested_access(spark, d):
    return read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k")).filter("k > 50")


_RAW = "CASE event_id % 6 WHEN 0 THEN '[{\"id\": \"a\", \"text\": \"' || event_type || '\"}]' WHEN 1 THEN '<thinking>x [1]</thinking>{\"items\": [{\"id\": \"a\", \"text\": \"b\"}, {\"id\": \"c\", \"text\": \"d\"}]}' WHEN 2 THEN '```json\n[{\"id\": \"a\", \"text\": \"b\",}]\n```' WHEN 3 THEN 'sure: [{\"string_id\": \"z\", \"text\": \"q\"}] done' WHEN 4 THEN 'no json' ELSE '' END"


@query("SELECT event_id, CASE event_id % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 1 ELSE 0 END AS n, CASE event_id % 6 WHEN 4 THEN 'parse_error' WHEN 5 THEN 'empty' ELSE 'ok' END AS code, CASE event_id % 6 WHEN 3 THEN 'z' WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE 'a' END AS first_id FROM events")
def x01_tolerant_json(spark, d):
    parsed = X.parse_items(F.expr(_RAW))
    out = read(spark, d, "events").select("event_id", parsed.alias("p"))
    return out.select("event_id", F.size("p.items").alias("n"), c("p.code").alias("code"), F.get(c("p.items"), 0)["id"].alias("first_id"))


@query("SELECT event_id, event_id % 6 IN (0, 1) AS valid FROM events")
def x03_batch_schema(spark, d):
    return read(spark, d, "events").select("event_id", X.valid_batch(F.expr(_RAW.replace("<thinking>x [1]</thinking>{\"items\": ", "").replace("}]}' WHEN 2", "}]' WHEN 2"))).alias("valid"))
