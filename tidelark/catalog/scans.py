"""Queries of the sources and sinks (tables written out and read back), style checks, classifiers and orderings."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import jsonx, models, vectors
from ..operators import analytics as A
from ..operators import helpers as H
from ..operators import relational as J
from ..operators import style as S
from ..sources import readers as IN
from ..sources import writers as OUT
from ..streaming.state import shared_folder
from .base import STRINGS, bound, cte, query, read

c = F.col


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share."""
    return f"{shared_folder(spark)}/tidelark-{uuid.uuid4().hex}/{name}"


# -- sources and sinks: what was written comes back -------------------------------------------------------------------


@query(cte("strings") + "SELECT string_id, CAST(seq AS VARCHAR) AS seq, coalesce(source_text, '') AS source_text, coalesce(target_text, '') AS target_text FROM strings")
def s01_k01_csv(spark, d):
    path = scratch(spark, "csv")
    OUT.write_csv(bound(spark, d, "strings").select("string_id", "seq", "source_text", "target_text"), path)
    return IN.read_csv(spark, path)


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ' 荐' AS name FROM customer")
def s02_csv_encoding(spark, d):
    path = scratch(spark, "gb")
    rows = read(spark, d, "customer").select("c_custkey", F.concat("c_name", F.lit(" 荐")).alias("name")).write
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # the writer's; the reader needs none
    try:
        rows.option("header", True).option("encoding", "GB18030").csv(path)
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")
    return IN.read_csv(spark, path, encoding="auto")


@query("SELECT CAST(doc_id AS VARCHAR) AS string_id, coalesce(text, '') AS source_zh, coalesce(lang, '') AS source_locale, '' AS context FROM documents")
def s03_ingest(spark, d):
    path = scratch(spark, "aliases")
    OUT.write_csv(read(spark, d, "documents").select(c("doc_id").alias("ID"), c("text").alias("Source"), c("lang").alias("locale")), path)
    return IN.ingest(IN.read_csv(spark, path))


@query("SELECT doc_id, text FROM documents WHERE doc_id > (SELECT min(doc_id) FROM documents) AND trim(text) <> ''")
def s05_second_header(spark, d):
    return IN.skip_second_header(read(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


_MARK = "CASE WHEN event_id % 10 = 0 THEN '{bad' WHEN event_id % 10 = 1 THEN '' ELSE '{\"id\": ' || event_id || ', \"type\": \"' || event_type || '\"}' END"


@query("SELECT event_id AS id, event_type AS type FROM events WHERE event_id % 10 > 1")
def s07_jsonl_tolerant(spark, d):
    """Lines that do not parse, and blank ones, are left out."""
    path = scratch(spark, "lines")
    read(spark, d, "events").selectExpr(f"{_MARK} AS value").write.text(path)
    return IN.read_jsonl(spark, path, "id long, type string")


@query("SELECT event_id AS id, event_type AS type FROM events")
def s08_k04_jsonl_strict(spark, d):
    """Written in two appends, read fail-fast."""
    path = scratch(spark, "log")
    events = read(spark, d, "events").select(c("event_id").alias("id"), c("event_type").alias("type"))
    odd = c("id") % 2 == 1
    OUT.write_jsonl(events.filter(~odd), path)
    OUT.write_jsonl(events.filter(odd), path, append=True)
    return IN.read_jsonl(spark, path, "id long, type string", strict=True)


@query("SELECT event_type AS part, count(*) AS n FROM events GROUP BY ALL")
def s09_jsonl_files(spark, d):
    """Many files by glob, each row with its file."""
    path = scratch(spark, "shards")
    events = read(spark, d, "events").select(c("event_id").alias("id"), c("event_type").alias("type"))
    events.withColumn("part", c("type")).write.partitionBy("part").json(path)
    rows = IN.read_jsonl(spark, f"{path}/*/*.json", "id long, type string", file_column="file")
    return rows.groupBy("file", "type").agg(F.count("*").alias("n")).groupBy(c("type").alias("part")).agg(F.sum("n").alias("n"))


@query(cte("trace") + "SELECT request_id, step FROM trace WHERE status = 'ok'")
def s10_trace_scan(spark, d):
    path = scratch(spark, "trace")
    OUT.write_jsonl(bound(spark, d, "trace").select("request_id", "step", F.when(c("status") == "ok", "llm_call").otherwise("llm_error").alias("type")), path)
    return IN.read_trace(spark, path, "request_id string, step string, type string").select("request_id", "step")


_ENTRIES = "term_zh, CASE WHEN seq % 3 = 0 THEN NULL ELSE target END AS ru, CASE WHEN seq % 4 = 0 THEN target || ' de' END AS de, status, seq"


def _entries(spark, d):
    g = bound(spark, d, "glossary")
    de = F.when(c("seq") % 4 == 0, F.concat("target", F.lit(" de")))
    return g.select(c("term").alias("term_zh"), F.when(c("seq") % 3 != 0, c("target")).alias("term_ru"), F.create_map(F.lit("de-DE"), de).alias("targets"), F.when(c("seq") % 5 == 0, "").otherwise(F.concat(F.lit(" "), F.upper("status"))).alias("status"), "seq")


@query(cte("glossary") + "SELECT term, arg_max(target || ' de', seq) AS target FROM glossary WHERE seq % 4 = 0 AND term <> '' GROUP BY term")
def s12_resolved_targets(spark, d):
    return IN.resolved_targets(_entries(spark, d), "de-DE", "seq")


@query(cte("glossary") + "SELECT seq, CASE WHEN seq % 5 = 0 THEN 'proposed' ELSE status END AS status FROM glossary")
def s13_usable_entries(spark, d):
    return IN.usable_entries(_entries(spark, d)).select("seq", "status")


@query(cte("ui") + "SELECT string_id, source_zh AS text, coalesce(nullif(module_tag, ''), 'misc') AS module_tag, seq AS source_line_no FROM ui WHERE trim(source_zh) <> ''")
def s14_source_texts(spark, d):
    return IN.source_texts(bound(spark, d, "ui"), "seq")


@query(cte("strings") + "SELECT string_id, 'token_mismatch' AS type, 'major' AS severity, source_text, target_text AS current_translation FROM strings")
def s15_repair_tasks(spark, d):
    path = scratch(spark, "tasks")
    rows = bound(spark, d, "strings").select("string_id", F.lit("token_mismatch").alias("type"), F.lit("major").alias("severity"), c("source_text").alias("source"), c("target_text").alias("target"))
    rows.groupBy(F.pmod(F.xxhash64("string_id"), F.lit(64)).alias("report")).agg(F.collect_list(F.struct("string_id", "type", "severity", "source", "target")).alias("errors")).drop("report").write.json(path)
    raw = spark.read.schema("errors array<struct<string_id:string,type:string,severity:string,detail:string,source:string,target:string>>").json(path)
    return IN.repair_tasks(raw)


@query(cte("tickets") + ", m AS (SELECT run_id, max(opened) AS started_at FROM tickets GROUP BY run_id) SELECT run_id FROM m WHERE run_id LIKE 'run_1%' ORDER BY started_at DESC, run_id LIMIT 5")
def s16_discover_runs(spark, d):
    m = bound(spark, d, "tickets").groupBy("run_id").agg(F.max("opened").alias("started_at")).withColumn("timestamp", F.lit(None).cast("timestamp"))
    return IN.discover_runs(m, "run_1", 5).select("run_id")


@query("SELECT DISTINCT 'S' || l_partkey AS string_id FROM lineitem")
def s19_u06_done_ids(spark, d):
    done = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.concat(F.lit("S"), c("l_partkey").cast("string"))).alias("done_ids"))
    return IN.done_ids(done)


@query(cte("strings") + "SELECT (SELECT count(*) FROM strings) AS total, (SELECT count(*) FROM strings) > 100 AS truncated, (SELECT string_agg(string_id, ',' ORDER BY seq) FROM (SELECT * FROM strings ORDER BY seq LIMIT 100)) AS first")
def k03_o07_report(spark, d):
    rows, total = OUT.report_frame(bound(spark, d, "strings").select("string_id", "seq"), ["seq"], 100)
    listed = rows.agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("seq", "string_id"))), lambda x: x["string_id"])).alias("first"))
    return total.crossJoin(F.broadcast(listed))  # a row each


@query("SELECT c_custkey, c_name FROM customer")
def k06_promote(spark, d):
    """A first version is promoted over another, a failing gate leaves it as it is."""
    path = scratch(spark, "current")
    rows = read(spark, d, "customer").select("c_custkey", "c_name")
    rows.filter("c_name IS NULL").write.parquet(path)
    gate = lambda ok: spark.createDataFrame([(ok,)], "passed boolean")
    OUT.promote(rows, path, gate(True))
    OUT.promote(rows.filter("c_name IS NULL"), path, gate(False))
    return spark.read.parquet(path)


@query(cte("tickets") + "SELECT CAST(ticket_id AS VARCHAR) AS ticket_id, '{\"run\":\"' || run_id || '\",\"priority\":\"' || priority || '\"}' AS context FROM tickets")
def k07_nested_csv(spark, d):
    path = scratch(spark, "tickets")
    OUT.write_csv(bound(spark, d, "tickets").select("ticket_id", F.struct(c("run_id").alias("run"), "priority").alias("context")), path)
    return IN.read_csv(spark, path)


@query("SELECT DISTINCT sha256(c_mktsegment || chr(10)) AS sha256, length(c_mktsegment) + 1 AS size_bytes, 'missing' AS state FROM customer")
def k09_u10_fingerprints(spark, d):
    """A file a segment; against an empty tree all are missing."""
    path = scratch(spark, "tree")
    segments = read(spark, d, "customer").select("c_mktsegment").distinct()
    segments.withColumn("part", c("c_mktsegment")).write.partitionBy("part").text(path)
    found = OUT.fingerprints(spark, f"{path}/*/*.txt")
    drift = OUT.tree_drift(found.select("path", "sha256"), found.select("path", "sha256").limit(0))
    return found.join(drift, "path").select("sha256", "size_bytes", "state")


# -- style, glossary and focus checks ----------------------------------------------------------------------------------

_TERMS = "t AS (SELECT term, min(seq) AS seq FROM (SELECT unnest(string_split(p_name, ' ')) AS term, p_partkey AS seq FROM part) GROUP BY 1)"


def _words(spark, d):
    return read(spark, d, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("term")).groupBy("term").agg(F.min("p_partkey").alias("seq"))


@query(cte("strings") + f", {_TERMS} SELECT string_id, arg_min(term, t.seq) AS term FROM strings JOIN t ON contains(target_text, term) GROUP BY ALL")
def j19_blocked_terms(spark, d):
    return S.first_contained(bound(spark, d, "strings"), _words(spark, d), "string_id", "target_text", "term", "seq")


@query(cte("strings") + f", {_TERMS}, e AS (SELECT term, upper(term) AS compact, [term || 's', ''] AS avoid, seq FROM t), m AS (SELECT string_id, seq, term, compact, CASE WHEN module = 'web' THEN 'badge_micro_1c' ELSE 'label' END AS cat FROM (SELECT s.string_id, s.source_text, s.target_text, s.module, e.* FROM strings s JOIN e ON contains(s.source_text, e.term)) WHERE NOT contains(target_text, compact) OR contains(target_text, avoid[1])) SELECT string_id, CASE WHEN cat = 'label' THEN 'compact_term_miss' ELSE 'compact_mapping_missing' END AS type, CASE WHEN cat = 'label' THEN 'minor' ELSE 'major' END AS severity, arg_min(term, seq) AS term, arg_min(compact, seq) AS compact FROM m GROUP BY string_id, cat")
def j20_compact_misses(spark, d):
    entries = _words(spark, d).withColumns({"compact": F.upper("term"), "avoid": F.array(F.concat("term", F.lit("s")), F.lit(""))})
    rows = bound(spark, d, "strings").withColumn("cat", F.when(c("module") == "web", "badge_micro_1c").otherwise("label"))
    return S.compact_misses(rows, entries, "string_id", "source_text", "target_text", "cat", "term", "compact", "avoid", "seq")


@query(f"WITH {_TERMS}, m AS (SELECT doc_id, term, seq, row_number() OVER (PARTITION BY doc_id ORDER BY seq, term) AS r FROM documents JOIN t ON contains(text, term)) SELECT doc_id, string_agg(term || '→' || upper(term), '; ' ORDER BY r) AS hint FROM m WHERE r <= 5 GROUP BY doc_id")
def j21_source_hints(spark, d):
    g = _words(spark, d).withColumns({"target": F.upper("term"), "status": F.lit("approved")})
    return S.source_hints(read(spark, d, "documents"), g, "doc_id", "text", "term", "target", "seq")


_AFTER = ", a AS (SELECT string_id, seq, source_zh, CASE WHEN seq % 3 = 0 THEN 'x' ELSE source_zh END AS target FROM ui)"
_FOCUS = "SELECT DISTINCT regexp_replace(source_zh, '\\s+', '', 'g') FROM ui WHERE module_tag = 'shop_page' AND source_zh <> ''"


def _after(spark, d):
    ui = bound(spark, d, "ui")
    return ui, ui.select("string_id", "seq", "source_zh", F.when(c("seq") % 3 == 0, "x").otherwise(c("source_zh")).alias("target")), ui.filter("module_tag = 'shop_page'").select(F.concat(F.lit(" "), "source_zh").alias("term"))


@query(cte("ui") + _AFTER + f" SELECT a.string_id, a.target <> ui.source_zh AS changed, regexp_replace(a.source_zh, '\\s+', '', 'g') IN ({_FOCUS}) AS focus_hit FROM a JOIN ui USING (string_id)")
def j07_focus_changes(spark, d):
    before, after, focus = _after(spark, d)
    return S.focus_changes(after, before.select("string_id", c("source_zh").alias("target")), focus, "string_id", "source_zh", "target", "term")


@query(cte("ui") + f"SELECT string_id FROM ui WHERE regexp_replace(source_zh, '\\s+', '', 'g') IN ({_FOCUS})")
def p67_focus_rows(spark, d):
    rows, _, focus = _after(spark, d)
    return S.focus_rows(rows, focus, "source_zh", "term").select("string_id")


@query(cte("stages") + "SELECT CASE WHEN error_code IN ('E1', 'E2') THEN 'deferred' ELSE 'actionable' END AS track, count(*) AS n FROM stages GROUP BY ALL")
def p66_split_findings(spark, d):
    return S.split_findings(bound(spark, d, "stages"), "error_code", ["E1", "E2"]).groupBy("track").agg(F.count("*").alias("n"))


@query(cte("glossary") + ", a AS (SELECT term, min(target) AS t FROM glossary WHERE scope = 'base' GROUP BY 1), b AS (SELECT term, min(target) AS t FROM glossary WHERE scope = 'ip' GROUP BY 1) SELECT coalesce(a.term, b.term) AS term, coalesce(a.t, '') AS old_target, coalesce(b.t, '') AS new_target FROM a FULL JOIN b ON a.term = b.term WHERE a.t IS DISTINCT FROM b.t")
def u04_preferred_changes(spark, d):
    g = bound(spark, d, "glossary")
    side = lambda s: g.filter(c("scope") == s).groupBy("term").agg(F.min("target").alias("target"))
    return S.preferred_changes(side("base"), side("ip"), "term", "target")


@query(cte("glossary") + "SELECT DISTINCT target FROM glossary WHERE status = 'banned' AND target NOT IN (SELECT target FROM glossary WHERE status = 'proposed')")
def u04_newly_banned(spark, d):
    g = bound(spark, d, "glossary")
    return S.newly_listed(g.filter("status = 'proposed'"), g.filter("status = 'banned'"), "target")


@query(cte("glossary") + ", a AS (SELECT term, min(target) AS t FROM glossary WHERE scope = 'base' GROUP BY 1), b AS (SELECT term, min(target) AS t FROM glossary WHERE scope = 'project' GROUP BY 1), j AS (SELECT a.t AS x, b.t AS y FROM a FULL JOIN b ON a.term = b.term) SELECT count(*) FILTER (x IS NULL) AS term_added, count(*) FILTER (x <> y) AS term_changed, count(*) FILTER (y IS NULL) AS term_removed FROM j")
def a40_change_counts(spark, d):
    g = bound(spark, d, "glossary")
    side = lambda s: g.filter(c("scope") == s).groupBy("term").agg(F.min("target").alias("t"))
    of = lambda k, n: F.count_if(c("change") == k).alias(n)
    return J.diff(side("base"), side("project"), "term", "t").agg(of("added", "term_added"), of("modified", "term_changed"), of("deleted", "term_removed"))


@query("SELECT l_suppkey, l_shipmode AS stage, max(l_orderkey * 10 + l_linenumber) AS at FROM (SELECT *, l_returnflag AS l_shipmode FROM lineitem) GROUP BY ALL")
def w04_distinct_issues(spark, d):
    """Contexts are maps whose keys stand in either order."""
    at = c("l_orderkey") * 10 + c("l_linenumber")
    flip = c("l_linenumber") % 2 == 0
    context = F.when(flip, F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), c("l_returnflag"))).otherwise(F.create_map(F.lit("b"), c("l_returnflag"), F.lit("a"), F.lit("1")))
    blank = F.lit("")
    issues = read(spark, d, "lineitem").select(c("l_suppkey").alias("run_id"), c("l_returnflag").alias("stage"), blank.alias("error_code"), blank.alias("row"), blank.alias("string_id"), context.alias("context"), at.alias("at"))
    return S.distinct_issues(issues, "at").select(c("run_id").alias("l_suppkey"), "stage", "at")


@query("SELECT c_custkey, 'D-TL-001' AS rule_id, 'profile' AS part, 'major' AS severity FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey, 'D-TL-002', 'project', 'major' FROM customer WHERE c_acctbal >= 0 AND c_nationkey < 5 UNION ALL SELECT c_custkey, 'D-TL-002', 'ui', 'major' FROM customer WHERE c_acctbal >= 0 AND c_mktsegment = 'MACHINERY'")
def r07_profile_rules(spark, d):
    cust = read(spark, d, "customer")
    return S.profile_issues(cust, "c_custkey", c("c_acctbal") >= 0, F.when(c("c_nationkey") >= 5, "zh"), F.lit("ru"), F.when(c("c_mktsegment") != "MACHINERY", "{}"))


@query(cte("glossary") + "SELECT DISTINCT lower(target) AS word FROM glossary WHERE status = 'banned' AND lower(target) IN (SELECT lower(target) FROM glossary WHERE status = 'approved')")
def r07_banned_in_glossary(spark, d):
    g = bound(spark, d, "glossary")
    return S.banned_in_glossary(g.filter("status = 'banned'").select(c("target").alias("word")), g.filter("status = 'approved'"), "word", "target")


# -- classifiers, orders, samples --------------------------------------------------------------------------------------


@query(cte("trace") + ", t AS (SELECT *, CASE WHEN seq % 6 = 0 THEN NULL ELSE 250 END AS lim FROM trace), h AS (SELECT * FROM t WHERE lim > 0 AND coalesce(completion_tokens, 0) >= 250 * 0.98::DOUBLE), s AS (SELECT step, count(*) AS n FROM h GROUP BY 1 ORDER BY n DESC, step LIMIT 5), m AS (SELECT model, count(*) AS n FROM h GROUP BY 1 ORDER BY n DESC, model LIMIT 5) SELECT (SELECT count(*) FROM t) AS calls, (SELECT count(*) FROM h) AS hits, round((SELECT count(*) FROM h) / (SELECT count(*) FROM t), 4) AS ratio, (SELECT string_agg(step, ',' ORDER BY n DESC, step) FROM s) AS top_steps, (SELECT string_agg(model, ',' ORDER BY n DESC, model) FROM m) AS top_models")
def a05_limit_anomalies(spark, d):
    t = bound(spark, d, "trace").withColumn("lim", F.when(c("seq") % 6 != 0, 250))
    return A.limit_anomalies(t, "completion_tokens", "lim")


@query("SELECT l_orderkey, l_linenumber, greatest(CAST(l_quantity AS BIGINT) - l_linenumber * 5, 0) AS used FROM lineitem")
def a06_reconciled(spark, d):
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", A.reconciled(c("l_linenumber") * 5, c("l_quantity").cast("long")).cast("long").alias("used"))


_ISSUE = "CASE doc_id % 5 WHEN 0 THEN 'mistranslation' WHEN 1 THEN 'length' WHEN 2 THEN 'style' WHEN 3 THEN 'terminology' ELSE 'other' END"


@query(f"SELECT doc_id, CASE WHEN {_ISSUE} IN ('mistranslation', 'terminology') THEN 'true_residual' WHEN {_ISSUE} IN ('length', 'style') AND lang = 'en' THEN 'compact_policy_noise' ELSE 'mixed_review' END AS class FROM documents")
def p51_soft_item_class(spark, d):
    docs = read(spark, d, "documents").selectExpr("doc_id", f"{_ISSUE} AS issue", "CASE WHEN lang = 'en' THEN 'prefill_exact' ELSE 'model' END AS mode")
    blank = F.lit("")
    return docs.select("doc_id", C.soft_item_class(c("issue"), c("mode"), blank, blank, blank).alias("class"))


_S = "regexp_replace(source_zh, '\\s+', '', 'g')"


@query(cte("ui") + f"SELECT string_id, CASE WHEN {_S} LIKE '%试炼' THEN 'trial_family' WHEN {_S} LIKE '%预览' THEN 'preview_family' WHEN contains({_S}, '之门') OR contains({_S}, '之力') THEN 'door_power_family' WHEN {_S} = '十连' THEN 'exact_title_family' WHEN contains({_S}, '礼包') THEN 'noun_title_family' WHEN contains({_S}, '·') OR contains({_S}, '・') THEN 'nameplate_title_family' ELSE 'singleton_family' END AS family FROM ui")
def p53_title_family(spark, d):
    return bound(spark, d, "ui").select("string_id", C.title_family(c("source_zh"), ("十连",), ("礼包",)).alias("family"))


@query(cte("ui") + f"SELECT string_id, {_S} <> '' AND length({_S}) <= 18 AND NOT regexp_matches({_S}, '[，。！？：；、…,.!?:;]') AND NOT regexp_matches({_S}, '^[0-9]+$') AND NOT regexp_matches({_S}, '^[一二三四五六七八九十百千万零]+$') AS eligible FROM ui")
def p61_focus_eligible(spark, d):
    return bound(spark, d, "ui").select("string_id", C.focus_eligible(c("source_zh")).alias("eligible"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'fix_placeholders' WHEN 1 THEN 'shorten' WHEN 2 THEN 'check_glossary' WHEN 3 THEN 'retranslate' ELSE 'manual_review' END AS action FROM documents")
def p62_suggested_action(spark, d):
    first = F.element_at(F.array(*map(F.lit, ("placeholder_mismatch", "length_overflow", "glossary_violation", "meaning_reversal", "other"))), (c("doc_id") % 5 + 1).cast("int"))
    return read(spark, d, "documents").select("doc_id", C.suggested_action(F.array(F.lit("other"), first)).alias("action"))


@query("SELECT string_id, string_agg(CAST(n AS VARCHAR), ',' ORDER BY n) AS places FROM (SELECT 'C' || c_nationkey AS string_id, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_name) AS n FROM customer) WHERE n <= 3 GROUP BY 1")
def o03_ranked_proposals(spark, d):
    ranked = H.top_n(read(spark, d, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), c("c_name")], 3)
    n = ranked.groupBy("c_nationkey").agg(F.count("*").cast("int").alias("n"))
    return n.select(F.concat(F.lit("C"), c("c_nationkey").cast("string")).alias("string_id"), F.concat_ws(",", F.sequence(F.lit(1), c("n")).cast("array<string>")).alias("places"))


@query("WITH n AS (SELECT *, length(text) > 300 AS l, md5(CAST(doc_id AS VARCHAR) || '42') AS h FROM documents), t AS (SELECT CASE WHEN (SELECT count(*) FROM n WHERE l) >= 80 THEN 300 ELSE 200 END AS least), a AS (SELECT doc_id FROM n, t WHERE length(text) > least ORDER BY h, doc_id LIMIT 80), b AS (SELECT doc_id FROM n WHERE doc_id NOT IN (SELECT doc_id FROM a) ORDER BY h, doc_id LIMIT 20) SELECT doc_id, 'long' AS bucket FROM a UNION ALL SELECT doc_id, 'other' FROM b")
def m07_long_and_short(spark, d):
    return S.long_and_short_sample(read(spark, d, "documents").select("doc_id", "text"), "doc_id", "text").select("doc_id", "bucket")


@query("SELECT c_mktsegment AS text, CAST(length(c_mktsegment) AS DOUBLE) AS v FROM customer GROUP BY ALL")
def v05_cached_embeddings(spark, d):
    texts = read(spark, d, "customer").select(c("c_mktsegment").alias("text"))
    cache = texts.filter("text = 'MACHINERY'").distinct().select(vectors.cache_key(c("text"), "m").alias("key"), F.array(F.lit(9.0)).alias("vector"))
    out = vectors.cached_embeddings(texts, cache, "text", "m", F.array(F.length("text").cast("double")), 1)
    return out.select("text", c("vector")[0].alias("v"))
