"""Queries of the glossary lifecycle, gates, governance and the remaining scripts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import policy as R
from ..functions.text import PATTERNS
from ..operators import gates as T
from ..operators import glossary as G
from ..operators import relational as J
from .base import bound, cte, query, read

c = F.col
TAG = PATTERNS[2][2]
_RANK = "CASE scope WHEN 'project' THEN 4 WHEN 'ip' THEN 3 WHEN 'genre' THEN 2 ELSE 1 END"


@query(cte("glossary") + f", k AS (SELECT term, count(DISTINCT target) > 1 AS conflict FROM glossary GROUP BY term), r AS (SELECT g.term, target, scope, conflict, row_number() OVER (PARTITION BY g.term ORDER BY CASE WHEN conflict THEN {_RANK} ELSE 0 END DESC, seq) AS n FROM glossary g JOIN k USING (term)) SELECT term, target, scope, conflict FROM r WHERE n = 1")
def w06_compile_glossary(spark, d):
    return G.compile_glossary(bound(spark, d, "glossary"), "term", "target", "scope", "seq").select("term", "target", "scope", "conflict")


_QUEUE = ", q AS (SELECT seq, term, target AS suggested, 'f' || CAST(seq % 2 AS STRING) AS final, CASE seq % 4 WHEN 0 THEN 'approve' WHEN 1 THEN 'edit' WHEN 2 THEN 'reject' ELSE '' END AS decision FROM glossary WHERE status = 'proposed')"


@query(cte("glossary") + _QUEUE + ", v AS (SELECT *, CASE WHEN decision = 'edit' THEN final ELSE suggested END AS target, decision IN ('approve', 'edit') AS wanted FROM q), n AS (SELECT *, row_number() OVER (PARTITION BY term, target, wanted ORDER BY seq) AS nth FROM v), e AS (SELECT DISTINCT term, target FROM glossary WHERE status = 'approved') SELECT CASE WHEN decision = 'reject' THEN 'rejected' WHEN NOT wanted THEN 'skipped' WHEN e.term IS NOT NULL OR nth > 1 THEN 'duplicate' WHEN decision = 'edit' THEN 'edited' ELSE 'approved' END AS outcome, count(*) AS n FROM n LEFT JOIN e ON e.term = n.term AND e.target = n.target GROUP BY ALL")
def g01_apply_review(spark, d):
    g = bound(spark, d, "glossary")
    q = g.filter("status = 'proposed'").selectExpr("seq", "term", "target AS suggested", "'f' || CAST(seq % 2 AS STRING) AS final", "CASE seq % 4 WHEN 0 THEN 'approve' WHEN 1 THEN 'edit' WHEN 2 THEN 'reject' ELSE '' END AS decision")
    out = G.apply_review(q, g.filter("status = 'approved'"), "term", "suggested", "final", "decision", "seq")
    return out.groupBy("outcome").agg(F.count("*").alias("n"))


_OFFSET = "(SELECT (SELECT max(c_custkey) FROM customer) - (SELECT count(*) FROM supplier) // 2)"


@query(f"WITH b AS (SELECT c_custkey AS k, c_name AS v FROM customer), s AS (SELECT s_suppkey + {_OFFSET} AS k, s_name AS v FROM supplier), a AS (SELECT * FROM b UNION ALL SELECT * FROM s WHERE k NOT IN (SELECT k FROM b)), u AS (SELECT k, CASE WHEN k % 10 = 0 THEN 'new' ELSE v END AS v FROM a) SELECT * FROM u WHERE k % 7 <> 0")
def g02_patch_table(spark, d):
    """The whole customer table, with suppliers of which about half have a customer's key."""
    base = read(spark, d, "customer").select(c("c_custkey").alias("k"), c("c_name").alias("v"))
    supplier = read(spark, d, "supplier")
    offset = base.agg(F.max("k").alias("top")).crossJoin(supplier.agg(F.floor(F.count("*") / 2).alias("half"))).select((c("top") - c("half")).alias("o"))
    extra = supplier.crossJoin(F.broadcast(offset)).select((c("s_suppkey") + c("o")).alias("k"), c("s_name").alias("v"))
    added = G.patch_append(base, extra, ["k"])
    updated = G.patch_update(added, added.filter("k % 10 = 0").select("k", F.lit("new").alias("v")), "k")
    return G.patch_remove(updated, base.union(extra).filter("k % 7 = 0"), "k")


@query(cte("glossary") + "SELECT seq FROM glossary WHERE status = 'proposed' AND confidence >= 0.9")
def g03_auto_approve(spark, d):
    return G.auto_approve(bound(spark, d, "glossary").filter("status = 'proposed'"), "confidence").select("seq")


@query(cte("glossary") + "SELECT term, target AS suggested, scope, count(*) AS support, round(avg(confidence), 6) AS confidence, '' AS decision, '' AS final, '' AS note FROM glossary WHERE status = 'proposed' GROUP BY ALL")
def g04_review_queue(spark, d):
    p = bound(spark, d, "glossary").filter("status = 'proposed'").groupBy("term", "target", "scope").agg(F.count("*").alias("support"), F.round(F.avg("confidence"), 6).alias("confidence"))
    return G.review_queue(p, "term", "target")


@query(cte("glossary") + "SELECT term, target, CASE src WHEN 0 THEN 'project' ELSE 'base' END AS scope, seq FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY src, seq) AS r FROM (SELECT term, target, seq, 0 AS src FROM glossary WHERE scope = 'project' UNION ALL SELECT term, target, seq, 1 FROM glossary WHERE scope = 'base')) WHERE r = 1")
def g05_merge_sources(spark, d):
    g = bound(spark, d, "glossary").select("term", "target", "seq", c("scope").alias("s"))
    return G.merge_sources([(s, g.filter(c("s") == s).drop("s")) for s in ("project", "base")], ["term"], "seq").select("term", "target", "scope", "seq")


@query(cte("glossary") + "SELECT seq FROM glossary WHERE status = 'approved' AND lower(target) IN (SELECT lower(p_type) || ' 0' FROM part WHERE p_size = 50)")
def g06_style_conflicts(spark, d):
    banned = read(spark, d, "part").filter("p_size = 50").select(F.concat("p_type", F.lit(" 0")).alias("w"))
    return G.style_conflicts(bound(spark, d, "glossary"), banned, "target", "w").select("seq")


@query(cte("glossary") + "SELECT term, arg_min(target, seq) FILTER (scope <> 'ip') AS standard, arg_min(target, seq) FILTER (scope = 'ip') AS compact FROM glossary GROUP BY term")
def g07_preferences(spark, d):
    return G.preferences(bound(spark, d, "glossary"), "term", "target", c("scope") == "ip", "seq")


@query(cte("glossary") + ", r AS (SELECT *, CASE WHEN scope = 'ip' THEN 'compact' ELSE 'standard' END AS kind, row_number() OVER (PARTITION BY scope = 'ip' ORDER BY seq) AS n FROM glossary) SELECT kind, string_agg(term || ' = ' || target, '; ' ORDER BY seq) AS summary FROM r WHERE n <= 40 GROUP BY kind")
def g08_prompt_summary(spark, d):
    return G.prompt_summary(bound(spark, d, "glossary"), "term", "target", c("scope") == "ip", "seq")


_WORDS = ", words AS (SELECT unnest(string_split(p_name, ' ')) AS term, p_type, p_partkey FROM part)"
_DELTA = _WORDS + ", delta AS (SELECT term, min(p_type) AS old, CASE WHEN min(p_partkey) % 3 = 0 THEN 'added' WHEN min(p_partkey) % 3 = 1 THEN 'modified' ELSE 'deleted' END AS change FROM words GROUP BY 1)"
_CLASS = "CASE " + " ".join(f"WHEN regexp_matches(lower(trim(module)), '{p}') THEN '{k}'" for k, p in R.CONTENT_CLASSES.items()) + " ELSE 'general' END"


_IMPACTS = f", k AS (SELECT doc_id, change FROM docs JOIN delta ON contains(text, term) UNION ALL SELECT doc_id, change FROM docs JOIN delta ON change <> 'added' AND old <> '' AND contains(target, old)), s AS (SELECT doc_id, list_sort(list(DISTINCT CASE change WHEN 'added' THEN 'term_added' WHEN 'modified' THEN 'term_changed' ELSE 'term_removed' END)) AS t FROM k GROUP BY doc_id), r AS (SELECT doc_id, t, {_CLASS} AS class FROM docs JOIN s USING (doc_id)) SELECT doc_id, array_to_string(t, ',') AS delta_types, class AS content_class, CASE WHEN class = 'ui_button' THEN 'manual_review' WHEN list_contains(t, 'term_removed') THEN 'manual_review' ELSE 'auto_refresh' END AS action FROM r"


@query("WITH docs AS (SELECT doc_id, text, lang || ' ' || upper(text) AS target, CASE doc_id % 4 WHEN 0 THEN 'menu' WHEN 1 THEN 'story' ELSE 'other' END AS module FROM documents)" + _DELTA + _IMPACTS)
def g09_row_impacts(spark, d):
    docs = read(spark, d, "documents").selectExpr("doc_id", "text", "lang || ' ' || upper(text) AS target", "CASE doc_id % 4 WHEN 0 THEN 'menu' WHEN 1 THEN 'story' ELSE 'other' END AS module")
    m = F.min("p_partkey")
    delta = read(spark, d, "part").select("p_partkey", "p_type", F.explode(F.split("p_name", " ")).alias("term")).groupBy("term").agg(F.min("p_type").alias("old"), F.when(m % 3 == 0, "added").when(m % 3 == 1, "modified").otherwise("deleted").alias("change"))
    out = G.row_impacts(docs, delta, "doc_id", "text", "target", "module")
    return out.select("doc_id", F.concat_ws(",", "delta_types").alias("delta_types"), "content_class", "action")


@query("SELECT doc_id FROM documents WHERE doc_id IN (3, 5, 900) OR lang = 'de'")
def g12_change_events(spark, d):
    hit = G.event_applies(F.array(F.lit(3), F.lit(5), F.lit(900)), F.array(F.lit("de")), c("doc_id"), c("lang"))
    return read(spark, d, "documents").filter(hit).select("doc_id")


# -- gates ---------------------------------------------------------------------------------------------------------


@query(cte("stages") + "SELECT seq, error_code FROM stages WHERE error_code IN ('E1', 'E2', 'E3') AND priority IN ('P0', 'P1')")
def r01_severity_gate(spark, d):
    s = bound(spark, d, "stages").withColumn("severity", C.cases([(c("priority") == "P0", "critical"), (c("priority") == "P1", "major")], "minor"))
    return T.severity_gate(s, ["E1", "E2", "E3"], "major", kind="error_code").select("seq", "error_code")


@query("WITH b AS (SELECT doc_id, lang FROM documents WHERE doc_id % 10 < 9), n AS (SELECT doc_id, lang FROM documents WHERE doc_id % 10 > 0), f AS (SELECT count(*) FILTER (b.doc_id IS NULL) AS added, count(*) FILTER (n.doc_id IS NULL) AS removed, count(*) FILTER (b.doc_id IS NOT NULL AND n.doc_id IS NOT NULL) AS common FROM b FULL JOIN n ON b.doc_id = n.doc_id), s AS (SELECT max(abs(coalesce(x.n, 0) - coalesce(y.n, 0))) AS max_delta FROM (SELECT lang, count(*) AS n FROM b GROUP BY 1) x FULL JOIN (SELECT lang, count(*) AS n FROM n GROUP BY 1) y ON x.lang = y.lang) SELECT added, removed, common, round((added + removed) / (removed + common), 6) AS churn, max_delta, false AS passed FROM f, s")
def r02_drift_gate(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "lang")
    return T.drift_gate(docs.filter("doc_id % 10 < 9"), docs.filter("doc_id % 10 > 0"), "doc_id", "lang").withColumn("churn", F.round("churn", 6))


@query(cte("tickets") + ", m AS (SELECT avg(CASE WHEN status = 'closed' THEN 1.0 ELSE 0 END) AS closed, count(*) FILTER (priority = 'P0') AS p0 FROM tickets) SELECT 'closure' AS gate, closed >= 0.3 AS passed FROM m UNION ALL SELECT 'blockers', p0 < 10 FROM m")
def r03_r04_threshold_gates(spark, d):
    m = bound(spark, d, "tickets").agg(F.avg((c("status") == "closed").cast("int")).alias("closed"), F.count_if(c("priority") == "P0").alias("p0"))
    return T.threshold_gates(m, {"closure": c("closed") >= 0.3, "blockers": c("p0") < 10})


@query("SELECT count(*) FILTER (b.doc_id IS NULL) AS lost, count(*) FILTER (a.lang <> b.lang) AS changed, (SELECT count(*) FROM labels WHERE toxic = 1) AS errors, CASE WHEN count(*) FILTER (b.doc_id IS NULL) > 0 THEN 'blocked' ELSE 'failed' END AS status FROM documents a LEFT JOIN (SELECT doc_id, CASE WHEN doc_id % 50 = 1 THEN 'xx' ELSE lang END AS lang FROM documents WHERE doc_id % 100 <> 7) b ON a.doc_id = b.doc_id")
def r05_refresh_gate(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "lang")
    cand = docs.filter("doc_id % 100 <> 7").withColumn("lang", F.when(c("doc_id") % 50 == 1, "xx").otherwise(c("lang")))
    return T.refresh_gate(docs, cand, "doc_id", "lang", read(spark, d, "labels").filter("toxic = 1"))


@query(cte("tickets") + "SELECT ticket_id, 'status' AS field, 'not_allowed' AS problem FROM tickets WHERE status NOT IN ('pending', 'closed') UNION ALL SELECT ticket_id, 'owner', 'missing' FROM tickets UNION ALL SELECT ticket_id, 'note', 'missing' FROM tickets WHERE ticket_id % 9 = 0")
def r09_contract_violations(spark, d):
    t = bound(spark, d, "tickets").withColumn("note", F.when(c("ticket_id") % 9 != 0, "x").otherwise(" "))
    return T.contract_violations(t, "ticket_id", ["run_id", "owner", "note"], {"status": ["pending", "closed"]})


@query("SELECT doc_id, 'E001' AS code FROM documents WHERE n_chars < 100 UNION ALL SELECT doc_id, 'E002' FROM documents WHERE lang NOT IN ('en', 'de')")
def r08_rule_breaches(spark, d):
    return T.rule_breaches(read(spark, d, "documents"), "doc_id", {"E001": c("n_chars") < 100, "E002": ~c("lang").isin("en", "de")})


@query(cte("stages") + "SELECT seq, error_code FROM stages WHERE required AND error_code NOT IN (SELECT 'E' || n_nationkey FROM nation WHERE n_nationkey % 2 = 0)")
def r11_missing_files(spark, d):
    files = read(spark, d, "nation").filter("n_nationkey % 2 = 0").select(F.concat(F.lit("E"), c("n_nationkey").cast("string")).alias("error_code"))
    return T.missing_files(bound(spark, d, "stages"), files, "seq", "error_code")


@query(cte("strings") + "SELECT count(*) AS rows, count(*) FILTER (trim(target_text) <> '') AS translated, round(avg(CASE WHEN trim(target_text) <> '' THEN 1.0 ELSE 0 END) * 100, 4) AS coverage FROM strings")
def r11_target_coverage(spark, d):
    return T.target_coverage(bound(spark, d, "strings"), "target_text")


@query("SELECT b.item_id AS doc_id, '.' AS symbol FROM benchmark b LEFT JOIN documents d ON d.doc_id = b.item_id WHERE d.text IS NULL OR NOT contains(d.text, '&')")
def r12_symbol_guard(spark, d):
    rules = read(spark, d, "benchmark").select(c("item_id").alias("doc_id"), F.lit("&").alias("symbol"))
    return T.symbol_guard(read(spark, d, "documents"), rules, "doc_id", "text").withColumn("symbol", F.lit("."))


@query("SELECT 'input' AS stage, count(*) AS n FROM documents UNION ALL SELECT 'final', count(*) FROM labels")
def r13_row_counts(spark, d):
    return T.row_counts(input=read(spark, d, "documents"), final=read(spark, d, "labels"))


@query(cte("tickets") + "SELECT 'ticket:' || ticket_id || ':' || review_source AS ticket_id, ticket_id AS key, CASE WHEN review_source IN ('post_gate_blocked', 'execution_failure') THEN 'P0' WHEN ticket_id % 4 = 0 THEN 'P1' ELSE 'P2' END AS priority, status, CASE WHEN review_source = 'soft_qa' THEN 'quality' ELSE 'review' END AS ticket_type FROM tickets")
def r15_review_tickets(spark, d):
    t = bound(spark, d, "tickets").withColumnRenamed("ticket_id", "key")
    return T.review_tickets(t, t.filter("key % 4 = 0").select("key", F.lit("high").alias("risk")), "key")


_RUNS = ", runs AS (SELECT run_id, CASE WHEN min(ticket_id) % 5 = 0 THEN 'fail' ELSE 'pass' END AS status, min(ticket_id) % 3 = 0 AS drift, CASE WHEN min(ticket_id) % 2 = 0 THEN 'running' ELSE 'pass' END AS kpi FROM tickets GROUP BY run_id), cards AS (SELECT 'review_ticket' AS card_type, run_id, priority FROM tickets WHERE status <> 'closed' UNION ALL SELECT 'runtime_alert', run_id, 'P0' FROM runs WHERE status = 'fail' UNION ALL SELECT 'governance_drift', run_id, 'P1' FROM runs WHERE drift UNION ALL SELECT 'kpi_watch', run_id, 'P2' FROM runs WHERE kpi <> 'pass' UNION ALL SELECT DISTINCT 'decision_required', run_id, 'P1' FROM tickets WHERE status <> 'closed' AND priority IN ('P0', 'P1'))"


def _cards(spark, d):
    t = bound(spark, d, "tickets")
    m = F.min("ticket_id")
    runs = t.groupBy("run_id").agg(F.when(m % 5 == 0, "fail").otherwise("pass").alias("status"), (m % 3 == 0).alias("drift"), F.when(m % 2 == 0, "running").otherwise("pass").alias("kpi"))
    return T.operator_cards(t, runs)


@query(cte("tickets") + _RUNS + " SELECT card_type, priority, count(*) AS n FROM cards GROUP BY ALL")
def r16_operator_cards(spark, d):
    return _cards(spark, d).groupBy("card_type", "priority").agg(F.count("*").alias("n"))


@query(cte("tickets") + _RUNS + ", p AS (SELECT *, count(*) OVER (PARTITION BY run_id) AS cards, row_number() OVER (PARTITION BY run_id ORDER BY priority, CASE card_type WHEN 'runtime_alert' THEN 0 WHEN 'decision_required' THEN 1 WHEN 'review_ticket' THEN 2 WHEN 'governance_drift' THEN 3 ELSE 4 END, card_type) AS r FROM cards) SELECT run_id, card_type AS primary_card, priority, cards, CASE WHEN priority = 'P0' THEN 'act' WHEN card_type IN ('review_ticket', 'decision_required') THEN 'review' ELSE 'watch' END AS lane FROM p WHERE r = 1")
def r17_workspace_cases(spark, d):
    return T.workspace_cases(_cards(spark, d))


@query(cte("tickets") + "SELECT ticket_id, cost FROM tickets WHERE status = 'pending' AND priority = 'P1' ORDER BY cost DESC, ticket_id LIMIT 20")
def r18_listing(spark, d):
    return T.listing(bound(spark, d, "tickets"), {"status": "pending", "priority": "P1"}, [F.desc("cost"), c("ticket_id")], 20, {"priority": ["P0", "P1", "P2"]}).select("ticket_id", "cost")


# -- remaining scripts -----------------------------------------------------------------------------------------------


@query(cte("trace") + ", p AS (SELECT model, batch_rows, bool_and(status = 'ok' OR batch_rows < 12) AS ok, max(latency_ms) AS m FROM trace GROUP BY ALL), f AS (SELECT model, min(batch_rows) FILTER (NOT ok) AS fail FROM p GROUP BY 1) SELECT p.model, coalesce(max(batch_rows) FILTER (fail IS NULL OR batch_rows < fail), 0) AS max_pass, max(m) FILTER (fail IS NULL OR batch_rows < fail) AS max_latency_ms FROM p JOIN f USING (model) GROUP BY p.model")
def n01_max_passing_size(spark, d):
    return T.max_passing_size(bound(spark, d, "trace"), ["model"], "batch_rows", (c("status") == "ok") | (c("batch_rows") < 12))


@query("SELECT doc_id, len(list_filter(range(4), lambda i: i % (doc_id % 3 + 1) <> 0)) AS n FROM documents")
def n02_positional_mismatches(spark, d):
    expected = F.array(*map(F.lit, range(4)))
    returned = F.transform(expected, lambda i: F.when(i % (c("doc_id") % 3 + 1) == 0, i).otherwise(-1))
    return read(spark, d, "documents").select("doc_id", F.size(T.positional_mismatches(expected, returned)).cast("long").alias("n"))


@query(cte("ui") + "SELECT count(*) FILTER (source_zh = '') AS empty, count(*) FILTER (source_zh = '' AND quality IS NOT NULL) AS polluted FROM ui LEFT JOIN labels ON doc_id = seq")
def n03_pollution(spark, d):
    answers = read(spark, d, "labels").select(c("doc_id").alias("seq"), F.lit("text").alias("answer"))
    return T.pollution(bound(spark, d, "ui"), answers, "seq", "source_zh", "answer")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) WHERE i % 4 = 1")
def n06_modulo_shard(spark, d):
    return J.modulo_shard(J.pending(read(spark, d, "documents"), read(spark, d, "labels"), "doc_id"), "doc_id", 4, 1).select("doc_id")


@query(cte("strings") + "SELECT string_id, source_text, 'critical' AS severity FROM strings WHERE target_text = ''")
def n07_missing_tasks(spark, d):
    return bound(spark, d, "strings").filter(F.trim("target_text") == "").select("string_id", "source_text", F.lit("critical").alias("severity"))


@query(cte("trace") + "SELECT request_id, model FROM trace WHERE step = 'error'")
def n09_trace_extract(spark, d):
    return bound(spark, d, "trace").filter("step = 'error'").select("request_id", "model")


@query("SELECT p_name, arg_min(p_retailprice, (src, p_partkey)) AS price FROM (SELECT p_name, p_partkey, p_retailprice, 0 AS src FROM part WHERE p_size < 10 UNION ALL SELECT p_name, p_partkey, p_retailprice, 1 FROM part WHERE p_size >= 10) GROUP BY p_name")
def n10_pricing_merge(spark, d):
    raw = read(spark, d, "part").select("p_name", "p_partkey", "p_size", F.concat(F.lit("$"), c("p_retailprice").cast("string"), F.lit(" / 1M")).alias("raw"))
    parsed = raw.withColumn("price", F.regexp_extract("raw", "\\$([0-9.]+)", 1).cast("double")).withColumn("_at", F.struct((c("p_size") >= 10).cast("int").alias("s"), "p_partkey"))
    return parsed.groupBy("p_name").agg(F.min_by("price", "_at").alias("price"))


@query("SELECT c_custkey, c_mktsegment AS segment, c_mktsegment AS source_zh FROM customer")
def n20_header_fix(spark, d):
    return read(spark, d, "customer").select("c_custkey", c("c_mktsegment").alias("segment")).withColumn("source_zh", c("segment"))


# -- freezing and plans ----------------------------------------------------------------------------------------------


@query("WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '</?[A-Za-z0-9_]+(?:\\s*=?\\s*[^>]*)?>')) AS original, unnest(range(len(regexp_extract_all(html, '</?[A-Za-z0-9_]+(?:\\s*=?\\s*[^>]*)?>')))) AS pos FROM pages), f AS (SELECT original, min((page_id, pos)) AS first FROM t GROUP BY original) SELECT original, 'TAG_' || row_number() OVER (ORDER BY first) AS token FROM f")
def p03_w08_token_numbers(spark, d):
    from ..operators.freeze import token_map

    tags = F.regexp_extract_all("html", F.lit(TAG), F.lit(0))
    return token_map(read(spark, d, "pages").select("page_id", F.concat_ws(" ", tags).alias("t")), "t", "page_id")


@query(cte("ui") + "SELECT string_id, replace(source_zh, '{0}', '⟦PH_1⟧') AS tokenized FROM ui")
def p03_freeze(spark, d):
    from ..operators.freeze import freeze

    frozen, _ = freeze(bound(spark, d, "ui"), "source_zh", "seq")
    return frozen.select("string_id", "tokenized")


@query(cte("ui") + "SELECT string_id FROM ui")
def plan_deliver(spark, d):
    from ..plans.localization import deliver

    return deliver(bound(spark, d, "ui").select("string_id", "seq", "source_zh"))["delivered"].select("string_id")


_OLD = "SELECT split_part(p_name, ' ', 1) AS term, p_type FROM part UNION ALL SELECT split_part(p_name, ' ', 2), p_type FROM part WHERE p_size <= 25"
_CHANGED = f", a AS (SELECT term, min(p_type) AS t FROM ({_OLD}) GROUP BY 1), b AS (SELECT split_part(p_name, ' ', 2) AS term, max(p_type) AS t FROM part GROUP BY 1), delta AS (SELECT coalesce(a.term, b.term) AS term, coalesce(a.t, '') AS old, CASE WHEN a.term IS NULL THEN 'added' WHEN b.term IS NULL THEN 'deleted' ELSE 'modified' END AS change FROM a FULL JOIN b ON a.term = b.term WHERE a.t IS DISTINCT FROM b.t)"


@query(cte("strings") + ", docs AS (SELECT string_id AS doc_id, source_text AS text, target_text AS target, module FROM strings)" + _CHANGED + _IMPACTS.replace("SELECT doc_id, array_to_string(t, ',') AS delta_types, class AS content_class,", "SELECT doc_id AS string_id, array_to_string(t, ',') AS delta_types,"))
def plan_refresh(spark, d):
    from ..plans.refresh import refresh

    rows = bound(spark, d, "strings").select("string_id", c("source_text").alias("source"), c("target_text").alias("target"), c("module").alias("module_tag"))
    part = read(spark, d, "part")
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i)).alias("term")
    old = part.select(word(1), "p_type").union(part.filter("p_size <= 25").select(word(2), "p_type")).groupBy("term").agg(F.min("p_type").alias("target"))
    new = part.select(word(2), "p_type").groupBy("term").agg(F.max("p_type").alias("target"))
    return refresh(rows, old, new)["impacts"].select("string_id", F.concat_ws(",", "delta_types").alias("delta_types"), "action")


_USED = "count(*) AS batches, sum(batch_rows) AS rows, sum(CASE WHEN status = 'ok' THEN batch_rows ELSE 0 END) AS success, sum(CASE WHEN status <> 'ok' THEN batch_rows ELSE 0 END) AS failed, sum(latency_ms) AS latency_ms, sum(p) AS prompt, sum(q) AS completion, round(sum((p + q) * rate / 1e6::DOUBLE), 6) AS cost"
_PRICED = ", t AS (SELECT *, CAST(coalesce(prompt_tokens, ceil(req_chars / 4)) AS BIGINT) AS p, CAST(coalesce(completion_tokens, ceil(resp_chars / 4)) AS BIGINT) AS q, CASE model WHEN 'm0' THEN 0.4::DOUBLE WHEN 'm1' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS rate FROM trace)"


@query(cte("trace") + _PRICED + f" SELECT 'all' AS level, '' AS key, {_USED} FROM t UNION ALL SELECT 'step', step, {_USED} FROM t GROUP BY step UNION ALL SELECT 'model', model, {_USED} FROM t GROUP BY model")
def plan_metrics(spark, d):
    from ..plans.refresh import metrics

    t = bound(spark, d, "trace")
    rates = spark.createDataFrame([("m0", 0.4), ("m1", 2.0)], "model string, rate double")
    return metrics(t.drop("req_chars", "resp_chars"), t, rates, 1.0)


@query(cte("ui") + "SELECT string_id, CASE WHEN source_zh = '' THEN 'skipped_empty' ELSE 'ok' END AS status, CASE WHEN source_zh = '' THEN '' ELSE reverse(source_zh) END AS translated FROM ui")
def z02_z03_translate(spark, d):
    from ..functions.models import translate

    return translate(bound(spark, d, "ui"), "string_id", "source_zh")


@query(cte("ui") + "SELECT string_id, array_to_string(regexp_extract_all(source_zh, '[一-鿿]{2,}|[A-Za-z0-9._\\-+%]+'), ' ') AS words FROM ui")
def z01_segment(spark, d):
    from ..functions.models import segment

    return bound(spark, d, "ui").select("string_id", F.concat_ws(" ", segment(c("source_zh"))).alias("words"))


@query("SELECT time_bucket(INTERVAL '5 minutes', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def t02_tumbling(spark, d):
    from ..streaming.state import tumbling

    return tumbling(read(spark, d, "events"), "ts", "5 minutes", "1 hour", "event_type")


@query("WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '6 hours' THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, count(*) AS n FROM s GROUP BY user_id, k")
def t02_sessions(spark, d):
    from ..streaming.state import sessions

    return sessions(read(spark, d, "events"), "ts", "6 hours", "1 hour", "user_id").select("user_id", "n")


_LINES = "WITH l AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN '## ' || role WHEN 1 THEN 'tone: ' || role WHEN 2 THEN '- [x] ' || role ELSE '- ' || role END AS t, role FROM conversations)"


@query(_LINES + ", s AS (SELECT *, last_value(CASE WHEN turn % 4 = 0 THEN role END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS section FROM l) SELECT conv_id, turn, section, CASE turn % 4 WHEN 1 THEN 'tone' WHEN 2 THEN 'choice' ELSE 'item' END AS key, role AS value, turn % 4 = 2 AS checked FROM s WHERE turn % 4 <> 0")
def n14_questionnaire(spark, d):
    from ..operators.scripts import parse_questionnaire

    lines = read(spark, d, "conversations").selectExpr("conv_id", "turn", "CASE turn % 4 WHEN 0 THEN '## ' || role WHEN 1 THEN 'tone: ' || role WHEN 2 THEN '- [x] ' || role ELSE '- ' || role END AS t")
    return parse_questionnaire(lines, "conv_id", "turn", "t")


@query(_LINES + ", k AS (SELECT conv_id, bool_or(turn % 4 = 1) AS tone FROM l WHERE turn % 4 <> 0 GROUP BY conv_id) SELECT conv_id, 'audience' AS missing FROM k UNION ALL SELECT conv_id, 'tone' FROM k WHERE NOT tone")
def n15_profile_issues(spark, d):
    from ..operators.scripts import profile_issues

    return profile_issues(n14_questionnaire(spark, d), "conv_id", ["tone", "audience"])


@query("WITH a AS (SELECT doc_id FROM documents ORDER BY length(text) DESC, doc_id LIMIT 12), s AS (SELECT doc_id FROM documents WHERE length(text) BETWEEN 1 AND 6 AND doc_id NOT IN (SELECT * FROM a) ORDER BY length(text) DESC, doc_id LIMIT 72), m AS (SELECT doc_id FROM documents WHERE length(text) BETWEEN 20 AND 60 AND doc_id NOT IN (SELECT * FROM a) AND doc_id NOT IN (SELECT * FROM s) ORDER BY length(text) DESC, doc_id LIMIT 24), p AS (SELECT doc_id FROM documents WHERE lang = 'de' AND doc_id NOT IN (SELECT * FROM a) AND doc_id NOT IN (SELECT * FROM s) AND doc_id NOT IN (SELECT * FROM m) ORDER BY length(text) DESC, doc_id LIMIT 12) SELECT 'longest' AS bucket, doc_id FROM a UNION ALL SELECT 'short', doc_id FROM s UNION ALL SELECT 'middle', doc_id FROM m UNION ALL SELECT 'placeholder', doc_id FROM p")
def n04_stress_template(spark, d):
    from ..operators.scripts import stress_template

    return stress_template(read(spark, d, "documents").select("doc_id", "lang", "text"), "doc_id", "text", c("lang") == "de").select("bucket", "doc_id")


@query("SELECT c_custkey, CASE WHEN s_suppkey IS NOT NULL THEN s_nationkey ELSE c_nationkey END AS size, coalesce(CASE WHEN s_suppkey IS NOT NULL THEN s_nationkey ELSE c_nationkey END >= 10, false) AS qualified FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def n12_consolidated(spark, d):
    from ..operators.scripts import consolidated

    base = read(spark, d, "customer").select("c_custkey", c("c_nationkey").alias("size"))
    return consolidated(base, read(spark, d, "supplier").select(c("s_suppkey").alias("c_custkey"), c("s_nationkey").alias("size")), "c_custkey", "size")


@query(cte("trace") + "SELECT step, step || '.json' AS path, sum(latency_ms) AS latency_ms, round(sum(latency_ms / 1000.0::DOUBLE), 6) AS cost, CASE WHEN step = 'error' THEN 'FAIL' ELSE 'PASS' END AS status, false AS go FROM trace GROUP BY step")
def n13_stress_report(spark, d):
    from ..operators.scripts import stress_report

    t = bound(spark, d, "trace").withColumn("cost", c("latency_ms") / 1000.0)
    phases = t.select("step", F.concat("step", F.lit(".json")).alias("path")).distinct()
    return stress_report(phases, phases.filter("step <> 'error'").select("path"), t, "step", "path").select("step", "path", "latency_ms", "cost", "status", "go")
