"""Queries of the quality rules, joins, set operations, windows and sampling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import policy as R
from ..functions.estimate import estimate_tokens
from ..functions.text import extract_tokens, strip_spaces
from ..operators import findings as Q
from ..operators import helpers as H
from ..operators import relational as J
from .base import bound, cte, query, read

c = F.col
_S = "regexp_extract_all(source_text, '⟦(PH_[0-9]+|TAG_[0-9]+)⟧', 1)"
_T = "regexp_extract_all(target_text, '⟦(PH_[0-9]+|TAG_[0-9]+)⟧', 1)"
_COUNTS = f", st AS (SELECT string_id, t, count(*) AS n FROM (SELECT string_id, unnest({_S}) AS t FROM strings) GROUP BY ALL), tt AS (SELECT string_id, t, count(*) AS n FROM (SELECT string_id, unnest({_T}) AS t FROM strings) GROUP BY ALL), d AS (SELECT coalesce(st.string_id, tt.string_id) AS string_id, coalesce(st.t, tt.t) AS t, coalesce(st.n, 0) AS a, coalesce(tt.n, 0) AS b FROM st FULL JOIN tt ON st.string_id = tt.string_id AND st.t = tt.t), x AS (SELECT string_id, count(*) AS extras, max(b - a) AS surplus, max(a) AS inside FROM d WHERE b > a GROUP BY string_id)"
_MISMATCH = " SELECT d.string_id, CASE WHEN a > b THEN 'token_mismatch' WHEN extras = 1 AND surplus = 1 AND inside > 0 THEN 'token_mismatch_soft' ELSE 'token_mismatch' END AS type, CASE WHEN a > b THEN 'missing ' ELSE 'extra ' END || t AS detail FROM d LEFT JOIN x USING (string_id) WHERE a <> b"


@query(cte("strings") + _COUNTS + _MISMATCH)
def q02_token_mismatch(spark, d):
    f = Q.token_mismatch(c("source_text"), c("target_text"))
    return bound(spark, d, "strings").select("string_id", F.explode(f).alias("f")).select("string_id", "f.type", "f.detail")


_TAGS = "regexp_extract_all(html, '</?[A-Za-z0-9_]+(?:\\s*=?\\s*[^>]*)?>')"


@query(f"WITH t AS (SELECT page_id, unnest({_TAGS}) AS tag FROM pages), s AS (SELECT page_id, count(*) FILTER (tag LIKE '</%') AS closes, count(*) FILTER (tag NOT LIKE '</%' AND tag NOT LIKE '%/>' AND NOT regexp_matches(tag, '^<(?:br|img|hr|meta|input|base|link)\\b')) AS opens FROM t GROUP BY page_id) SELECT page_id, opens, closes FROM s WHERE opens <> closes")
def q03_source_tags_unbalanced(spark, d):
    sides = Q.tag_sides(c("html"))
    df = read(spark, d, "pages").select("page_id", sides["opens"].cast("long").alias("opens"), sides["closes"].cast("long").alias("closes"))
    return df.filter(c("opens") != c("closes"))


@query(cte("strings") + ", t AS (SELECT string_id, CAST(substring(unnest(regexp_extract_all(target_text, 'TAG_[0-9]+')), 5) AS INT) AS n FROM strings), s AS (SELECT string_id, count(*) FILTER (n = 0) AS co, count(*) FILTER (n = 1) AS cc, count(*) FILTER (n = 2) AS bo, count(*) FILTER (n = 3) AS bc FROM t GROUP BY ALL) SELECT string_id, 'color ' || co || '/' || cc AS detail FROM s WHERE co <> cc UNION ALL SELECT string_id, 'bold ' || bo || '/' || bc FROM s WHERE bo <> bc")
def q04_paired_tags(spark, d):
    mapping = F.create_map(*[F.lit(x) for x in ("TAG_0", "<color=#FFFFFF>", "TAG_1", "</c>", "TAG_2", "<b>", "TAG_3", "</b>", "TAG_4", "text")])
    f = Q.paired_tags(c("target_text"), mapping)
    return bound(spark, d, "strings").select("string_id", F.explode(f).alias("f")).select("string_id", "f.detail")


@query(cte("strings") + ", t AS (SELECT string_id, CAST(substring(unnest(regexp_extract_all(target_text, 'TAG_[0-9]+')), 5) AS INT) AS n FROM strings), s AS (SELECT string_id, count(*) FILTER (n IN (0, 2)) AS o, count(*) FILTER (n IN (1, 3)) AS k FROM t GROUP BY ALL) SELECT string_id, o || '/' || k AS detail FROM s WHERE o <> k")
def q05_open_close(spark, d):
    mapping = F.create_map(*[F.lit(x) for x in ("TAG_0", "<color=#FFFFFF>", "TAG_1", "</c>", "TAG_2", "<b>", "TAG_3", "</b>", "TAG_4", "text")])
    return bound(spark, d, "strings").select("string_id", F.explode(Q.open_close(c("target_text"), mapping)).alias("f")).select("string_id", "f.detail")


@query(cte("strings") + "SELECT string_id, CASE WHEN regexp_matches(target_text, '[ \\t\\n\\r\\f\\v]{4,}') THEN '\\s{4,}' WHEN contains(target_text, 'TODO') THEN 'TODO' END AS detail FROM strings WHERE regexp_matches(target_text, '[ \\t\\n\\r\\f\\v]{4,}') OR contains(target_text, 'TODO')")
def q06_forbidden(spark, d):
    return bound(spark, d, "strings").select("string_id", F.explode(Q.forbidden(c("target_text"))).alias("f")).select("string_id", "f.detail")


@query(cte("strings") + f"SELECT string_id, t AS detail FROM (SELECT string_id, unnest({_T}) AS t FROM strings) WHERE t NOT IN ('PH_0','PH_1','PH_2','TAG_0','TAG_1')")
def q07_unknown_token(spark, d):
    mapping = F.create_map(*[F.lit(x) for t in ("PH_0", "PH_1", "PH_2", "TAG_0", "TAG_1") for x in (t, "o")])
    return bound(spark, d, "strings").select("string_id", F.explode(Q.unknown_token(c("target_text"), mapping)).alias("f")).select("string_id", "f.detail")


@query(cte("strings") + "SELECT string_id, 'brace {0}' AS detail FROM strings WHERE contains(target_text, '{0}') AND NOT contains(source_text, '{0}')")
def q08_unfrozen(spark, d):
    return bound(spark, d, "strings").select("string_id", F.explode(Q.unfrozen(c("source_text"), c("target_text"))).alias("f")).select("string_id", "f.detail")


_LIMITS = " ".join(f"WHEN cat = '{k}' THEN {{}}" for k in R.LENGTH_POLICY)


@query(cte("strings") + "SELECT string_id, CASE WHEN seq % 2 = 0 THEN 'headline_budget_overflow' ELSE 'length_overflow' END AS type, CASE WHEN length(target_text) > greatest(0, 12, CASE WHEN seq % 2 = 0 THEN CAST(floor(length(source_text) * 3.2::DOUBLE) AS INT) ELSE CAST(floor(length(source_text) * 2.5::DOUBLE) AS INT) END) THEN 'critical' ELSE 'major' END AS severity FROM strings WHERE length(target_text) > greatest(500, CASE WHEN seq % 2 = 0 THEN CAST(floor(length(source_text) * 2.6::DOUBLE) AS INT) ELSE 0 END, 10)")
def q09_length_policy(spark, d):
    category = F.when(c("seq") % 2 == 0, "slogan_long").otherwise("title_name_short")
    p = C.length_policy(category, F.length("source_text"), F.lit(0), F.lit(500), F.lit(0))
    hint = F.when(c("seq") % 2 == 0, "headline_nameplate").otherwise("")
    f = Q.length_finding(c("target_text"), c("source_text"), p, hint, F.lit("compact_preferred"), F.lit(""), F.lit("optional"))
    return bound(spark, d, "strings").select("string_id", F.explode(f).alias("f")).select("string_id", "f.type", "f.severity")


_ALL = (
    cte("strings")
    + _COUNTS
    + f", f AS (SELECT string_id, type, CASE WHEN type = 'token_mismatch_soft' THEN 'warning' ELSE 'critical' END AS severity FROM ({_MISMATCH}) UNION ALL SELECT string_id, 'forbidden_hit', 'critical' FROM strings WHERE regexp_matches(target_text, '[ \\t\\n\\r\\f\\v]{{4,}}') OR contains(target_text, 'TODO') UNION ALL SELECT string_id, 'unfrozen_placeholder', 'critical' FROM strings WHERE contains(target_text, '{{0}}') AND NOT contains(source_text, '{{0}}')), r AS (SELECT f.type, f.severity FROM f JOIN strings USING (string_id) WHERE target_text <> '' UNION ALL SELECT 'empty_translation', 'critical' FROM strings WHERE target_text = '') SELECT type, severity, count(*) AS n, false AS approved FROM r GROUP BY ALL"
)


@query(_ALL)
def q10_findings_report(spark, d):
    return Q.report(Q.hard_findings(bound(spark, d, "strings"), "source_text", "target_text"))


@query(cte("strings") + f"SELECT CASE WHEN list_sort({_S}) <> list_sort({_T}) THEN 'token_mismatch' WHEN trim(target_text) = '' THEN 'empty' ELSE 'ok' END AS verdict, count(*) AS n FROM strings GROUP BY ALL")
def q11_translation_verdict(spark, d):
    return bound(spark, d, "strings").groupBy(Q.translation_verdict(c("source_text"), c("target_text")).alias("verdict")).agg(F.count("*").alias("n"))


@query(cte("strings") + ", p AS (SELECT *, list_sort(list_distinct(regexp_extract_all(source_text, '⟦(?:PH|TAG)_[0-9]+⟧|\\{[^}]+\\}|%[sd]|<[^>]+>'))) AS a, list_sort(list_distinct(regexp_extract_all(target_text, '⟦(?:PH|TAG)_[0-9]+⟧|\\{[^}]+\\}|%[sd]|<[^>]+>'))) AS b FROM strings), k AS (SELECT unnest([CASE WHEN length(target_text) > 3000 THEN 'length' END, CASE WHEN a <> b THEN 'placeholder_set' END, CASE WHEN " + f"{_S} <> {_T}" + " THEN 'token_sequence' END, CASE WHEN trim(target_text) = '' THEN 'empty' END, CASE WHEN regexp_matches(lower(target_text), 'here is|translation:|as an ai|i cannot|sorry') THEN 'meta' END, CASE WHEN regexp_matches(target_text, '[一-鿿]') THEN 'cjk' END]) AS failure FROM p) SELECT failure, count(*) AS n FROM k WHERE failure IS NOT NULL GROUP BY ALL")
def q12_repair_failures(spark, d):
    return bound(spark, d, "strings").select(F.explode(Q.repair_failures(c("source_text"), c("target_text"), F.lit(3000))).alias("failure")).groupBy("failure").agg(F.count("*").alias("n"))


@query("SELECT severity, count(*) AS n FROM (SELECT CASE WHEN n_chars > 3000 THEN 'critical' WHEN n_chars > 2000 THEN 'major' WHEN n_chars >= 1900 THEN 'warning' END AS severity FROM documents) WHERE severity IS NOT NULL GROUP BY ALL")
def q13_length_review(spark, d):
    df = read(spark, d, "documents").withColumns({"hard": F.lit(2000), "review": F.lit(3000)})
    return Q.length_review(df, "text", "hard", "review").groupBy("severity").agg(F.count("*").alias("n"))


# -- joins -------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, c_mktsegment AS o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey")
def j01_override_join(spark, d):
    left = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    right = read(spark, d, "customer").select(c("c_custkey").alias("o_custkey"), c("c_mktsegment").alias("o_orderstatus"))
    return J.override_join(left, right, "o_custkey").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("SELECT doc_id, toxic, CASE WHEN n_chars < 60 THEN 'skipped_empty' WHEN quality IS NOT NULL THEN 'translated' ELSE 'missing_translation' END AS delivery_status FROM documents LEFT JOIN labels USING (doc_id)")
def j02_restore_delivery(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "n_chars")
    return J.restore_delivery(docs, read(spark, d, "labels"), "doc_id", c("n_chars") < 60, c("quality").isNotNull()).select("doc_id", "toxic", "delivery_status")


@query("SELECT c_custkey, CASE WHEN coalesce(s_name, '') <> '' THEN s_name ELSE c_name END AS name, CASE WHEN s_suppkey IS NOT NULL THEN s_acctbal ELSE c_acctbal END AS balance FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey")
def j03_overlay(spark, d):
    base = read(spark, d, "customer").select("c_custkey", c("c_name").alias("name"), c("c_acctbal").alias("balance"))
    patch = read(spark, d, "supplier").select(c("s_suppkey").alias("c_custkey"), c("s_name").alias("name"), c("s_acctbal").alias("balance"))
    return J.overlay(base, patch, "c_custkey", forced=("balance",))


@query("SELECT doc_id, CASE WHEN b.text IS NOT NULL THEN 'r2' WHEN l.toxic = 1 THEN 'r1' ELSE 'base' END AS origin FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN benchmark b ON b.item_id = d.doc_id")
def j04_chained_repairs(spark, d):
    base = read(spark, d, "documents").select("doc_id", F.lit("base").alias("origin"))
    r1 = read(spark, d, "labels").filter("toxic = 1").select("doc_id", F.lit("r1").alias("origin"))
    r2 = read(spark, d, "benchmark").select(c("item_id").alias("doc_id"), F.lit("r2").alias("origin"))
    return J.overlay(J.overlay(base, r1, "doc_id"), r2, "doc_id")


@query("WITH a AS (SELECT doc_id AS id, lang AS v FROM documents WHERE doc_id % 3 <> 0), b AS (SELECT doc_id AS id, source AS v FROM documents WHERE doc_id % 3 <> 1 AND doc_id % 2 = 0 UNION ALL SELECT doc_id, lang FROM documents WHERE doc_id % 6 = 5) SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'added' WHEN b.id IS NULL THEN 'deleted' ELSE 'modified' END AS change FROM a FULL JOIN b ON a.id = b.id WHERE a.v IS DISTINCT FROM b.v")
def j06_diff(spark, d):
    docs = read(spark, d, "documents")
    a = docs.filter("doc_id % 3 <> 0").select(c("doc_id").alias("id"), c("lang").alias("v"))
    b = docs.filter("doc_id % 3 <> 1 AND doc_id % 2 = 0").select(c("doc_id").alias("id"), c("source").alias("v")).union(docs.filter("doc_id % 6 = 5").select("doc_id", "lang"))
    return J.diff(a, b, "id", "v").select("id", "change")


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0")
def j08_inner_with_check(spark, d):
    return J.inner_checked(read(spark, d, "orders"), read(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey").filter("c_acctbal > 0").select("o_orderkey", "c_name")


@query("SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END, ''), t.role) AS v FROM documents LEFT JOIN (SELECT conv_id, arg_min(role, turn) AS role FROM conversations GROUP BY conv_id) t ON t.conv_id = doc_id")
def j09_hydrate(spark, d):
    docs = read(spark, d, "documents").select("doc_id", F.when(c("doc_id") % 2 == 0, c("lang")).otherwise("").alias("v"))
    frame = read(spark, d, "conversations").select(c("conv_id").alias("doc_id"), "turn", c("role").alias("v"))
    return J.hydrate(docs, H.keep_first(frame, ["doc_id"], "turn").drop("turn"), "doc_id", "v")


@query("SELECT doc_id, toxic FROM labels UNION ALL SELECT doc_id, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j10_fill_missing(spark, d):
    return J.fill_missing(read(spark, d, "labels").select("doc_id", "toxic"), read(spark, d, "documents").select("doc_id"), "doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j11_pending(spark, d):
    return J.pending(read(spark, d, "documents"), read(spark, d, "labels"), "doc_id").select("doc_id")


@query("SELECT DISTINCT p_name, p_brand FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_brand = 'Brand#1')")
def j12_compat_terms(spark, d):
    part = read(spark, d, "part").select("p_name", "p_brand")
    return J.pending(part, part.filter("p_brand = 'Brand#1'"), "p_name").distinct()


@query("SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_linenumber > 3 EXCEPT SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_linenumber <= 3")
def j13_no_regression(spark, d):
    li = read(spark, d, "lineitem")
    return J.new_findings(li.filter("l_linenumber > 3"), li.filter("l_linenumber <= 3"), ["l_orderkey", "l_returnflag"])


@query("WITH n AS (SELECT count(*) AS n FROM supplier) SELECT s_suppkey, s_nationkey FROM supplier, n WHERE (s_nationkey, s_suppkey % n) NOT IN (SELECT c_nationkey, c_custkey % n FROM customer, n WHERE c_mktsegment = 'MACHINERY')")
def j14_rejected_pairs_table(spark, d):
    """Every MACHINERY customer can reject; keys modulo the number of suppliers leave both outcomes at every size."""
    supplier = read(spark, d, "supplier")
    n = F.broadcast(supplier.agg(F.count("*").alias("of")))
    left = supplier.crossJoin(n).withColumn("m", c("s_suppkey") % c("of")).withColumnRenamed("s_nationkey", "n")
    right = read(spark, d, "customer").filter("c_mktsegment = 'MACHINERY'").crossJoin(n).select(c("c_nationkey").alias("n"), (c("c_custkey") % c("of")).alias("m"))
    return left.join(right, ["n", "m"], "left_anti").select("s_suppkey", c("n").alias("s_nationkey"))


@query(cte("glossary") + "SELECT seq FROM glossary p WHERE status = 'proposed' AND NOT EXISTS (SELECT 1 FROM glossary a WHERE a.status = 'approved' AND a.scope = 'project' AND a.term = p.term AND a.target <> p.target)")
def j15_approved_conflict(spark, d):
    g = bound(spark, d, "glossary")
    return J.without_conflict(g.filter("status = 'proposed'"), g.filter("status = 'approved' AND scope = 'project'"), "term", "target").select("seq")


@query("WITH terms AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS term FROM part), m AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY term) AS rank FROM documents JOIN terms ON contains(text, term)) SELECT doc_id, term, rank FROM m WHERE rank <= 20")
def j16_contained_terms(spark, d):
    terms = read(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("term")).distinct()
    m = H.contains_join(read(spark, d, "documents").select("doc_id", "text"), terms, "text", "term").select("doc_id", "term")
    return m.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy("term"))).filter("rank <= 20")


@query("WITH terms AS (SELECT term, min(seq) AS seq FROM (SELECT unnest(string_split(p_name, ' ')) AS term, p_partkey AS seq FROM part) GROUP BY 1), m AS (SELECT doc_id, arg_min(term, seq) AS term FROM documents JOIN terms ON contains(text, term) AND NOT contains(lower(lang), term) GROUP BY doc_id) SELECT * FROM m")
def j18_first_violation(spark, d):
    terms = read(spark, d, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("term")).groupBy("term").agg(F.min("p_partkey").alias("seq"))
    return J.first_violation(read(spark, d, "documents"), terms, "doc_id", "text", "lang", "term", "term", "seq").select("doc_id", "term")


@query("SELECT doc_id, text LIKE '%the%' AS exact, CASE WHEN lang = 'en' THEN 'english' ELSE '' END AS prefill FROM documents")
def j22_exact_prefill(spark, d):
    names = spark.createDataFrame([("en", "english")], "lang string, prefill string")
    docs = read(spark, d, "documents").select("doc_id", "lang", F.contains("text", F.lit("the")).alias("exact"))
    return docs.join(F.broadcast(names), "lang", "left").select("doc_id", "exact", F.coalesce("prefill", F.lit("")).alias("prefill"))


@query(cte("trace") + "SELECT a.request_id, coalesce(a.prompt_tokens, b.p) AS prompt FROM trace a LEFT JOIN (SELECT step, model, arg_max(prompt_tokens, seq) AS p FROM trace WHERE prompt_tokens IS NOT NULL GROUP BY ALL) b ON a.step = b.step AND a.model = b.model")
def j23_last_trace(spark, d):
    t = bound(spark, d, "trace")
    last = H.keep_last(t.filter(c("prompt_tokens").isNotNull()).select("step", "model", "seq", c("prompt_tokens").alias("p")), ["step", "model"], "seq").drop("seq")
    return t.join(last, ["step", "model"], "left").select("request_id", F.coalesce("prompt_tokens", "p").alias("prompt"))


@query(cte("trace") + ", l AS (SELECT * FROM trace WHERE seq % 2 = 0), r AS (SELECT * FROM trace WHERE seq % 2 = 1) SELECT l.request_id, CASE WHEN r.ts IS NOT NULL AND epoch_us(l.ts) - epoch_us(r.ts) <= (l.latency_ms + 600000) * 1000 THEN r.request_id END AS matched FROM l ASOF LEFT JOIN r ON l.step = r.step AND l.ts >= r.ts")
def j24_asof_backward(spark, d):
    t = bound(spark, d, "trace")
    left = t.filter("seq % 2 = 0").select("request_id", "step", "ts", "latency_ms")
    right = t.filter("seq % 2 = 1").select("step", c("ts").alias("rts"), c("request_id").alias("rid"))
    return H.asof_backward(left, right, ["step"], "ts", "rts", c("rid"), c("latency_ms") / 1000 + 600).select("request_id", "matched")


@query("SELECT n_name, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal < 0 UNION SELECT r_regionkey FROM region) GROUP BY ALL")
def j26_candidate_ids(spark, d):
    ids = J.id_union(read(spark, d, "customer").filter("c_acctbal < 0").select(c("c_nationkey").alias("k")), read(spark, d, "region").select(c("r_regionkey").alias("k")))
    return read(spark, d, "supplier").withColumnRenamed("s_nationkey", "k").join(ids, "k", "left_semi").join(read(spark, d, "nation"), c("k") == c("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"))


@query("WITH s AS (SELECT doc_id AS id, text FROM documents UNION ALL SELECT -1 - item_id, replace(text, ' ', '  ') FROM benchmark) SELECT id, item_id FROM s JOIN benchmark ON regexp_replace(coalesce(s.text, ''), '\\s+', '', 'g') = regexp_replace(coalesce(benchmark.text, ''), '\\s+', '', 'g')")
def j28_normalised_join_whole(spark, d):
    """Whole texts: documents, and items spaced otherwise (with negative ids), against the items."""
    items = read(spark, d, "benchmark").select("item_id", "text")
    texts = read(spark, d, "documents").select(c("doc_id").alias("id"), "text").union(items.select(-1 - c("item_id"), F.replace("text", F.lit(" "), F.lit("  "))))
    return texts.select("id", strip_spaces(c("text")).alias("k")).join(items.select("item_id", strip_spaces(c("text")).alias("k")), "k").select("id", "item_id")


@query(cte("tickets", "stages") + ", s AS (SELECT run_id, count(*) AS stages FROM stages GROUP BY 1), t AS (SELECT run_id, count(*) AS tickets FROM tickets GROUP BY 1) SELECT s.run_id, stages, coalesce(tickets, 0) AS tickets FROM s LEFT JOIN t USING (run_id)")
def j29_run_join(spark, d):
    s = bound(spark, d, "stages").groupBy("run_id").agg(F.count("*").alias("stages"))
    t = bound(spark, d, "tickets").groupBy("run_id").agg(F.count("*").alias("tickets"))
    return s.join(t, "run_id", "left").select("run_id", "stages", F.coalesce("tickets", F.lit(0)).alias("tickets"))


@query(cte("trace") + "SELECT model, sum(round(coalesce(prompt_tokens, 0) * CASE model WHEN 'm0' THEN 0.4::DOUBLE WHEN 'm1' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END, 3)) AS cost FROM trace GROUP BY ALL")
def j30_pricing_lookup(spark, d):
    rates = spark.createDataFrame([("m0", 0.4), ("m1", 2.0)], "model string, rate double")
    priced = J.priced(bound(spark, d, "trace"), rates, "model", 1.0)
    return priced.groupBy("model").agg(F.sum(F.round(F.coalesce("prompt_tokens", F.lit(0)) * c("rate"), 3)).alias("cost"))


# -- windows, order, sets ----------------------------------------------------------------------------------------


@query(cte("tickets") + "SELECT run_id, ticket_id, priority FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY priority, cost DESC, ticket_id) AS r FROM tickets) WHERE r = 1")
def w01_top_per_group(spark, d):
    return H.top_n(bound(spark, d, "tickets"), ["run_id"], [c("priority"), F.desc("cost"), c("ticket_id")]).select("run_id", "ticket_id", "priority")


@query("SELECT p_name, arg_min(p_partkey, p_partkey) AS first_key, arg_max(p_brand, p_partkey) AS last_brand FROM part GROUP BY p_name")
def w02_w03_keep_first_last(spark, d):
    p = read(spark, d, "part").select("p_name", "p_partkey", "p_brand")
    first = H.keep_first(p, ["p_name"], "p_partkey").select("p_name", c("p_partkey").alias("first_key"))
    return first.join(H.keep_last(p, ["p_name"], "p_partkey").select("p_name", c("p_brand").alias("last_brand")), "p_name")


@query(cte("glossary") + "SELECT term, target, scope FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY CASE scope WHEN 'project' THEN 4 WHEN 'ip' THEN 3 WHEN 'genre' THEN 2 ELSE 1 END DESC, seq) AS r FROM glossary) WHERE r = 1")
def w05_scope_winner(spark, d):
    return H.top_n(bound(spark, d, "glossary"), ["term"], [F.desc(C.rank_of(c("scope"), R.SCOPE_RANK)), c("seq")]).select("term", "target", "scope")


@query("SELECT CASE WHEN n > 0 THEN CAST(conv_id AS VARCHAR) || '_dup' || n ELSE CAST(conv_id AS VARCHAR) END AS conv_id, turn FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS n FROM conversations)")
def s06_w07_number_repeats(spark, d):
    return H.number_repeats(read(spark, d, "conversations").select("conv_id", "turn"), "conv_id", "turn")


@query("SELECT source, round(count(*) / max(count(*)) OVER (), 6) AS share FROM documents GROUP BY source")
def w09_share_of_max(spark, d):
    n = read(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return J.share_of_max(n, "n").select("source", F.round("share", 6).alias("share"))


@query("SELECT doc_id, count(*) OVER (PARTITION BY text) AS n FROM documents")
def w10_repeat_count(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text")
    return docs.join(docs.groupBy("text").agg(F.count("*").alias("n")), "text").select("doc_id", "n")


@query(cte("trace") + "SELECT request_id FROM trace ORDER BY ts DESC, request_id LIMIT 2000")
def w11_last_n(spark, d):
    return bound(spark, d, "trace").orderBy(F.desc("ts"), "request_id").limit(2000).select("request_id")


@query(cte("trace") + "SELECT request_id, sum(batch_rows) OVER (PARTITION BY step ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS done, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY step ORDER BY ts, seq)) AS gap_us FROM trace")
def w12_running_totals(spark, d):
    return J.running(bound(spark, d, "trace"), ["step"], ["ts", "seq"], "batch_rows", "ts").select("request_id", "done", "gap_us")


@query(cte("stages") + "SELECT error_code, arg_min(run_id, seq) AS first_run, min(seq) AS at FROM stages GROUP BY error_code")
def w13_first_seen(spark, d):
    return bound(spark, d, "stages").groupBy("error_code").agg(F.min_by("run_id", "seq").alias("first_run"), F.min("seq").alias("at"))


@query(cte("tickets") + "SELECT ticket_id, row_number() OVER (ORDER BY CASE status WHEN 'pending' THEN 0 WHEN 'in_review' THEN 1 ELSE 2 END, priority, opened, ticket_id) AS pos FROM tickets ORDER BY pos LIMIT 50")
def o01_ranked_listing(spark, d):
    rank = C.cases([(c("status") == "pending", 0), (c("status") == "in_review", 1)], 2)
    top = bound(spark, d, "tickets").orderBy(rank, "priority", "opened", "ticket_id").limit(50)
    return top.select("ticket_id", F.row_number().over(Window.orderBy(rank, "priority", "opened", "ticket_id")).cast("long").alias("pos"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, min(doc_id) LIMIT 15")
def o02_most_common(spark, d):
    return J.most_common(read(spark, d, "documents"), "source", "doc_id", 15)


@query("WITH a AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal > 5000), b AS (SELECT DISTINCT s_nationkey AS k FROM supplier) SELECT count(*) FILTER (b.k IS NULL) AS removed, count(*) FILTER (a.k IS NULL) AS added, count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS common, round(count(*) FILTER (a.k IS NULL OR b.k IS NULL) / count(a.k), 6) AS churn FROM a FULL JOIN b ON a.k = b.k")
def u01_churn(spark, d):
    base = read(spark, d, "customer").filter("c_acctbal > 5000").select(c("c_nationkey").alias("k"))
    now = read(spark, d, "supplier").select(c("s_nationkey").alias("k"))
    return J.churn(base, now, "k").withColumn("churn", F.round("churn", 6))


@query("SELECT lang, len(list_filter(e, lambda x: NOT list_contains(g, x))) AS missing, len(list_filter(g, lambda x: NOT list_contains(e, x))) AS extra FROM (SELECT lang, list(DISTINCT doc_id % 50) AS e, list(DISTINCT n_chars % 50) AS g FROM documents GROUP BY lang)")
def u02_coverage(spark, d):
    df = read(spark, d, "documents").groupBy("lang").agg(F.collect_set(c("doc_id") % 50).alias("e"), F.collect_set(c("n_chars") % 50).alias("g"))
    cov = J.coverage(c("e"), c("g"))
    return df.select("lang", F.size(cov["missing"]).cast("long").alias("missing"), F.size(cov["extra"]).cast("long").alias("extra"))


@query(cte("glossary") + ", a AS (SELECT term, min(target) AS t FROM glossary WHERE scope = 'base' GROUP BY 1), b AS (SELECT term, min(target) AS t FROM glossary WHERE scope = 'project' GROUP BY 1) SELECT CASE WHEN a.term IS NULL THEN 'added' WHEN b.term IS NULL THEN 'deleted' ELSE 'modified' END AS change, count(*) AS n FROM a FULL JOIN b ON a.term = b.term WHERE a.t IS DISTINCT FROM b.t GROUP BY ALL")
def u03_glossary_delta(spark, d):
    g = bound(spark, d, "glossary")
    side = lambda s: g.filter(c("scope") == s).groupBy("term").agg(F.min("target").alias("t"))
    return J.diff(side("base"), side("project"), "term", "t").groupBy("change").agg(F.count("*").alias("n"))


@query("SELECT doc_id, role FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY shard) AS r FROM (SELECT conv_id AS doc_id, role, 0 AS shard FROM conversations WHERE turn = 0 UNION ALL SELECT conv_id, role, 1 FROM conversations WHERE turn = 1)) WHERE r = 1")
def u05_shard_merge(spark, d):
    conv = read(spark, d, "conversations").select(c("conv_id").alias("doc_id"), "role", "turn")
    return J.merge_shards([conv.filter("turn = 0").drop("turn"), conv.filter("turn = 1").drop("turn")], "doc_id")


@query(cte("strings") + f", st AS (SELECT string_id, unnest({_S}) AS t FROM strings), tt AS (SELECT string_id, unnest({_T}) AS t FROM strings) SELECT * FROM st EXCEPT ALL SELECT * FROM tt")
def u08_multiset_difference(spark, d):
    s = bound(spark, d, "strings")
    side = lambda x: s.select("string_id", F.explode(extract_tokens(c(x))).alias("t"))
    return side("source_text").exceptAll(side("target_text"))


# -- sampling and packing ------------------------------------------------------------------------------------------


@query("WITH s AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id) AS r FROM documents), n AS (SELECT lang, count(*) AS n, sum(count(*)) OVER () AS total FROM documents GROUP BY lang), q AS (SELECT lang, n, CAST(floor(100.0::DOUBLE * n / total) AS BIGINT) AS base, 100.0::DOUBLE * n / total - floor(100.0::DOUBLE * n / total) AS rest FROM n), o AS (SELECT *, row_number() OVER (ORDER BY rest DESC, n DESC, lang) AS k, sum(base) OVER () AS assigned FROM q) SELECT doc_id, s.lang FROM s JOIN o ON s.lang = o.lang WHERE r <= base + CASE WHEN k <= 100 - assigned THEN 1 ELSE 0 END")
def m01_stratified_sample(spark, d):
    return J.stratified_sample(read(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", 100, 42)


@query("WITH a AS (SELECT doc_id FROM documents ORDER BY n_chars DESC, md5(CAST(doc_id AS VARCHAR)) LIMIT 12), b AS (SELECT doc_id FROM documents WHERE n_chars <= 400 AND doc_id NOT IN (SELECT doc_id FROM a) ORDER BY n_chars DESC, md5(CAST(doc_id AS VARCHAR)) LIMIT 30), e AS (SELECT doc_id FROM documents WHERE lang = 'fr' AND doc_id NOT IN (SELECT doc_id FROM a) AND doc_id NOT IN (SELECT doc_id FROM b) ORDER BY n_chars DESC, md5(CAST(doc_id AS VARCHAR)) LIMIT 20) SELECT 'long' AS bucket, * FROM a UNION ALL SELECT 'short', * FROM b UNION ALL SELECT 'french', * FROM e")
def m02_bucketed_sample(spark, d):
    buckets = [("long", F.lit(True), 12), ("short", c("n_chars") <= 400, 30), ("french", c("lang") == "fr", 20)]
    order = [F.desc("n_chars"), F.md5(c("doc_id").cast("string").cast("binary"))]
    return J.bucketed_sample(read(spark, d, "documents").select("doc_id", "lang", "n_chars"), "doc_id", buckets, order).select("bucket", "doc_id")


@query("WITH s AS (SELECT doc_id FROM documents WHERE n_chars < 120 ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 100), n AS (SELECT count(*) AS n FROM s) SELECT CAST(doc_id AS VARCHAR) AS id FROM s UNION ALL SELECT 'EMPTY_' || i FROM range(100) t(i), n WHERE i >= n.n")
def m03_padded_sample(spark, d):
    return J.padded_sample(read(spark, d, "documents").filter("n_chars < 120"), "doc_id", 100, "EMPTY_")


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || '7'), doc_id) AS r FROM documents) WHERE r <= CASE lang WHEN 'en' THEN 40 WHEN 'de' THEN 20 ELSE 10 END")
def m04_quota_sample(spark, d):
    return J.quota_sample(read(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", {"en": 40, "de": 20, "fr": 10, "es": 10}, 80, 7).select("doc_id", "lang")


@query("SELECT doc_id FROM documents WHERE lang = 'fr' UNION ALL SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents WHERE lang <> 'fr') WHERE r <= 5")
def m05_focused_slice(spark, d):
    docs = read(spark, d, "documents")
    return docs.filter("lang = 'fr'").select("doc_id").union(H.top_n(docs.filter("lang <> 'fr'"), ["lang"], [c("doc_id")], 5).select("doc_id"))


@query("SELECT doc_id, (row_number() OVER (PARTITION BY e ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) - 1) // CASE WHEN e THEN 4 ELSE 6 END AS batch FROM (SELECT doc_id, n_chars < 300 AS e FROM documents)")
def m06_mixed_batches(spark, d):
    return J.mixed_batches(read(spark, d, "documents"), "doc_id", c("n_chars") < 300, 6, 4).select("doc_id", c("batch").cast("long").alias("batch"))


_PACKED = "WITH RECURSIVE d AS (SELECT doc_id, source, CAST(greatest(1, length(coalesce(text, '')) // 4) AS BIGINT) AS tokens, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents), f AS (SELECT doc_id, source, tokens, rn, 0 AS batch, 1 AS items, tokens AS used FROM d WHERE rn = 1 UNION ALL SELECT d.doc_id, d.source, d.tokens, d.rn, f.batch + CASE WHEN f.items >= 20 OR f.used + d.tokens > 6000 THEN 1 ELSE 0 END, CASE WHEN f.items >= 20 OR f.used + d.tokens > 6000 THEN 1 ELSE f.items + 1 END, CASE WHEN f.items >= 20 OR f.used + d.tokens > 6000 THEN d.tokens ELSE f.used + d.tokens END FROM f JOIN d ON d.source IS NOT DISTINCT FROM f.source AND d.rn = f.rn + 1) SELECT doc_id, source, tokens, batch FROM f"


@query(_PACKED)
def m08_ordered_packing(spark, d):
    rows = read(spark, d, "documents").select("doc_id", "source", estimate_tokens(c("text")).alias("tokens"))
    return H.ordered_pack(rows, "source", "doc_id", "tokens", 20, 6000)


@query("SELECT doc_id, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 7 AS INT) AS batch FROM documents")
def m09_fixed_batches(spark, d):
    return H.fixed_batches(read(spark, d, "documents"), ["source"], "doc_id", 7).select("doc_id", "batch")
