"""Queries of the scalar functions, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import estimate as E
from ..functions import policy as R
from ..functions import text as T
from .base import bound, cte, query, read

c = F.col
_TOK = "regexp_extract_all(source_text, '⟦(PH_[0-9]+|TAG_[0-9]+)⟧', 1)"
_PLH = "\\{[0-9A-Za-z_]+\\}|%[sd]|<[^>]+>|\\[.+?\\]|【.+?】"


@query(cte("strings") + f"SELECT string_id, array_to_string({_TOK}, ',') AS tokens, len({_TOK}) AS n FROM strings")
def p01_extract_tokens(spark, d):
    return bound(spark, d, "strings").select("string_id", F.concat_ws(",", T.extract_tokens(c("source_text"))).alias("tokens"), F.size(T.extract_tokens(c("source_text"))).cast("long").alias("n"))


@query(cte("strings") + ", t AS (SELECT string_id, unnest(regexp_extract_all(target_text, '⟦(PH_[0-9]+|TAG_[0-9]+)⟧', 1)) AS token FROM strings) SELECT string_id, token, count(*) AS n FROM t GROUP BY ALL")
def p02_tokens_signature(spark, d):
    return bound(spark, d, "strings").select("string_id", F.explode(T.tokens_signature(c("target_text"))).alias("token", "n")).select("string_id", "token", c("n").cast("long"))


@query("SELECT page_id, (len(html)-len(replace(html,'{','')) <> len(html)-len(replace(html,'}',''))) AS brace, (len(html)-len(replace(html,'<','')) <> len(html)-len(replace(html,'>',''))) AS angle, (len(html)-len(replace(html,'[','')) <> len(html)-len(replace(html,']',''))) AS square FROM pages")
def p05_unbalanced(spark, d):
    codes = T.unbalanced_basic(c("html"))
    return read(spark, d, "pages").select("page_id", *[F.array_contains(codes, f"{k}_unbalanced").alias(k) for k in ("brace", "angle", "square")])


@query("SELECT doc_id, CASE WHEN length(text) >= 200 THEN 'true' ELSE 'false' END AS is_long, length(text) AS n FROM documents")
def p06_is_long_text(spark, d):
    return read(spark, d, "documents").select("doc_id", T.is_long_text(c("text")).alias("is_long"), F.length("text").cast("long").alias("n"))


@query(cte("strings") + "SELECT string_id, regexp_matches(target_text, '⟦(PH_[0-9]+|TAG_[0-9]+)⟧|\\{[^}]+\\}|%[sdif]|\\[[A-Z0-9_]+\\]|\\\\[ntr]|[【】]') AS has FROM strings")
def p07_has_placeholder(spark, d):
    return bound(spark, d, "strings").select("string_id", T.has_placeholder(c("target_text")).alias("has"))


@query(cte("strings") + "SELECT string_id, array_to_string(list_sort(list_distinct(regexp_extract_all(target_text, '⟦(?:PH|TAG)_[0-9]+⟧|\\{[^}]+\\}|%[sd]|<[^>]+>'))), ' ') AS kept, array_to_string(regexp_extract_all(target_text, '⟦[A-Z]+_[0-9]+⟧'), ' ') AS frozen FROM strings")
def p08_p09_repair_placeholders(spark, d):
    return bound(spark, d, "strings").select("string_id", F.concat_ws(" ", T.repair_placeholders(c("target_text"))).alias("kept"), F.concat_ws(" ", T.frozen_sequence(c("target_text"))).alias("frozen"))


@query(cte("ui") + f"SELECT string_id, len(regexp_extract_all(source_zh, '{_PLH}')) AS n, length(source_zh) - length(regexp_replace(source_zh, '{_PLH}', '', 'g')) AS budget, length(trim(regexp_replace(source_zh, '{_PLH}', '', 'g'))) AS clean FROM ui")
def p10_placeholder_measures(spark, d):
    s = c("source_zh")
    return bound(spark, d, "ui").select("string_id", T.count_placeholders(s).cast("long").alias("n"), T.placeholder_budget(s).cast("long").alias("budget"), T.clean_source_length(s).cast("long").alias("clean"))


_RESTORED = "replace(" * 6 + "replace(source_text, '⟦PH_0⟧', '{v0}')" + "".join(f", '⟦PH_{i}⟧', '{{v{i}}}')" for i in range(1, 7))


@query(cte("strings") + f"SELECT string_id, md5({_RESTORED}) AS restored, len(list_filter({_TOK}, lambda t: t LIKE 'TAG%')) AS n_unknown FROM strings")
def p11_rehydrate(spark, d):
    mapping = F.create_map(*[F.lit(x) for i in range(7) for x in (f"PH_{i}", f"{{v{i}}}")])
    s = c("source_text")
    return bound(spark, d, "strings").select("string_id", F.md5(T.restore_tokens(s, mapping).cast("binary")).alias("restored"), F.size(T.unknown_tokens(s, mapping)).cast("long").alias("n_unknown"))


@query("SELECT doc_id, md5(replace(replace(replace(text, '...', '…'), ', ', ' , '), '.', '。')) AS clean FROM documents")
def p13_sanitize_punctuation(spark, d):
    return read(spark, d, "documents").select("doc_id", F.md5(T.sanitize_punctuation(c("text"), [("...", "…"), (", ", " , "), (".", "。")]).cast("binary")).alias("clean"))


@query("WITH t AS (SELECT doc_id, replace(text, ' th', '% 1$s % d') AS x FROM documents) SELECT doc_id, md5(regexp_replace(x, '%\\s+((?:[0-9]+\\$)?[a-zA-Z])', '%\\1', 'g')) AS fixed, x <> regexp_replace(x, '%\\s+((?:[0-9]+\\$)?[a-zA-Z])', '%\\1', 'g') AS changed FROM t")
def p14_printf_spacing(spark, d):
    x = F.replace(c("text"), F.lit(" th"), F.lit("% 1$s % d"))
    fixed = T.fix_printf_spacing(x)
    return read(spark, d, "documents").select("doc_id", F.md5(fixed.cast("binary")).alias("fixed"), (x != fixed).alias("changed"))


@query("SELECT doc_id, md5(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', '', 'g')) AS key FROM documents")
def p16_strip_spaces(spark, d):
    return read(spark, d, "documents").select("doc_id", F.md5(T.strip_spaces(c("text")).cast("binary")).alias("key"))


@query("WITH t AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN lang || '_' || upper(lang) WHEN 1 THEN upper(lang) ELSE lang || '-ru' END AS l FROM documents) SELECT doc_id, CASE WHEN strpos(replace(l,'_','-'),'-') > 0 THEN lower(split_part(replace(l,'_','-'),'-',1)) || '-' || upper(split_part(replace(l,'_','-'),'-',2)) ELSE lower(l) END AS locale, 'target_' || lower(split_part(replace(l,'_','-'),'-',1)) AS key FROM t")
def p17_locale(spark, d):
    lang = F.expr("CASE doc_id % 3 WHEN 0 THEN lang || '_' || upper(lang) WHEN 1 THEN upper(lang) ELSE lang || '-ru' END")
    return read(spark, d, "documents").select("doc_id", T.normalize_locale(lang).alias("locale"), T.target_key(lang).alias("key"))


@query("SELECT p_partkey, trim(p_type) AS alias FROM part")
def p18_prohibited_alias(spark, d):
    return read(spark, d, "part").select("p_partkey", T.prohibited_alias(F.concat("p_name", F.lit(" -> «"), "p_type", F.lit("»"))).alias("alias"))


@query(cte("stages") + "SELECT seq, CASE WHEN stage IN ('stage_1','stage_2') THEN 'normalize' WHEN stage = 'stage_3' THEN 'translate' ELSE stage END AS name, count(*) AS n FROM stages GROUP BY ALL")
def p19_stage_name(spark, d):
    raw = F.concat(F.lit(" "), F.initcap(c("stage")), F.lit("  (retry 1) "))
    name = T.stage_name(raw, [("stage_1", "normalize"), ("stage_2", "normalize"), ("stage_3", "translate")])
    return bound(spark, d, "stages").select("seq", name.alias("name")).groupBy("seq", "name").agg(F.count("*").alias("n"))


@query("WITH t AS (SELECT conv_id, list(text ORDER BY turn) AS l FROM conversations GROUP BY conv_id) SELECT conv_id, array_to_string(list_transform(l[1:3], lambda x: substring(regexp_replace(replace(x, '\"', ''''), '[\\r\\n]+', ' ', 'g'), 1, 80)), ' | ') AS examples FROM t")
def p20_format_examples(spark, d):
    turns = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return read(spark, d, "conversations").groupBy("conv_id").agg(T.format_examples(F.transform(turns, lambda x: x["text"])).alias("examples"))


@query("SELECT doc_id, greatest(1, len(regexp_extract_all(text, '\\n')) + 1) AS lines, len(list_filter(regexp_extract_all(text, '[A-Za-zА-Яа-яЁё0-9]+'), lambda w: NOT regexp_full_match(w, '[0-9]+'))) AS words, lower(text) LIKE '%ninja%' OR lower(text) LIKE '%moron%' AS tail FROM documents")
def p21_p22_p23_counts(spark, d):
    t = c("text")
    return read(spark, d, "documents").select("doc_id", T.visual_lines(t).cast("long").alias("lines"), T.content_words(t).cast("long").alias("words"), T.promo_tail(t, ("ninja", "moron")).alias("tail"))


@query(cte("ui") + "SELECT string_id, regexp_matches(source_zh, '[一-鿿]') AS cjk FROM ui")
def p24_cjk(spark, d):
    return bound(spark, d, "ui").select("string_id", T.cjk_remaining(c("source_zh")).alias("cjk"))


@query("SELECT doc_id, lower(text) LIKE '%licensed%' OR lower(text) LIKE '%password%' AS meta FROM documents")
def p25_meta_response(spark, d):
    return read(spark, d, "documents").select("doc_id", T.meta_response(c("text"), ("licensed", "password")).alias("meta"))


@query("SELECT page_id, (CASE WHEN html LIKE '%<title>%' THEN 0 ELSE 1 END) + (CASE WHEN html LIKE '%<article>%' THEN 0 ELSE 1 END) + 1 AS n_missing FROM pages")
def p26_missing_sections(spark, d):
    doc = F.concat(F.when(c("html").contains("<title>"), "# title\n").otherwise(""), F.when(c("html").contains("<article>"), "## Article\n").otherwise(""))
    return read(spark, d, "pages").select("page_id", F.size(T.missing_sections(doc, ("title", "article", "scope"))).cast("long").alias("n_missing"))


@query("SELECT doc_id, greatest(1, length(text) // 4) AS tokens, greatest(1, length(text) // 4) + greatest(1, length(lang) // 4) + 20 AS row_tokens FROM documents")
def p27_estimate_tokens(spark, d):
    return read(spark, d, "documents").select("doc_id", E.estimate_tokens(c("text")).cast("long").alias("tokens"), E.row_tokens(c("text"), c("lang")).cast("long").alias("row_tokens"))


_USAGE = "CASE WHEN prompt_tokens IS NOT NULL THEN prompt_tokens WHEN req_chars <= 0 THEN 0 ELSE greatest(1, (req_chars + 3) // 4) END"
_USAGE_C = "CASE WHEN prompt_tokens IS NOT NULL THEN completion_tokens WHEN resp_chars <= 0 THEN 0 ELSE greatest(1, (resp_chars + 3) // 4) END"


@query(cte("trace") + f"SELECT request_id, {_USAGE} AS prompt, {_USAGE_C} AS completion, prompt_tokens IS NULL AS estimated, round(({_USAGE}) * 0.4 / 1e6 + ({_USAGE_C}) * 1.6 / 1e6, 8) AS cost, round(1.0 * 1.2 * 2.0 * (({_USAGE}) + ({_USAGE_C}) * 4.0) / 500000, 6) AS cost_multiplier FROM trace")
def p28_p29_p30_p31_usage_cost(spark, d):
    none = F.lit(None).cast("struct<prompt_tokens:bigint,completion_tokens:bigint>")
    u = E.usage(none, c("prompt_tokens"), c("completion_tokens"), c("req_chars"), c("resp_chars"))
    df = bound(spark, d, "trace").withColumn("u", u).select("request_id", "u.*")
    lit = lambda x: F.lit(float(x))
    return df.withColumns({"cost": F.round(E.cost_per_million(c("prompt"), c("completion"), lit(0.4), lit(1.6)), 8), "cost_multiplier": E.cost_by_multiplier(c("prompt"), c("completion"), lit(1), lit(1.2), lit(2), lit(4))})


@query("SELECT doc_id, md5(CAST(doc_id AS VARCHAR) || '42') AS k, substring(md5(source), 1, 10) AS f FROM documents")
def p32_p33_hash_keys(spark, d):
    return read(spark, d, "documents").select("doc_id", E.hash_order(c("doc_id"), 42).alias("k"), E.fingerprint10(c("source")).alias("f"))


@query("SELECT lang, sha256(string_agg(CAST(doc_id AS VARCHAR) || chr(10), '' ORDER BY CAST(doc_id AS VARCHAR))) AS digest FROM documents GROUP BY lang")
def p34_ids_digest(spark, d):
    return read(spark, d, "documents").groupBy("lang").agg(E.ids_digest(c("doc_id")).alias("digest"))


_STRATUM = "CASE WHEN trim(x) = '' THEN 'Other' WHEN regexp_matches(x, '\\{[^}]+\\}|%[sd]|⟦PH_[0-9]+⟧') THEN 'Placeholder' WHEN regexp_matches(x, '注意|禁止|必须|不可|提示|说明|警告|错误|失败|系统') THEN 'System' WHEN length(x) <= 30 THEN 'UI' WHEN length(x) >= 50 THEN 'Dialogue' ELSE 'Other' END"


@query(cte("ui") + f", t AS (SELECT CASE WHEN seq % 2 = 0 THEN source_zh ELSE repeat(source_zh, 4) END AS x FROM ui) SELECT {_STRATUM} AS stratum, count(*) AS n FROM t GROUP BY ALL")
def p37_stratum(spark, d):
    x = F.when(c("seq") % 2 == 0, c("source_zh")).otherwise(F.repeat("source_zh", 4))
    return bound(spark, d, "ui").groupBy(C.stratum(x).alias("stratum")).agg(F.count("*").alias("n"))


_BUCKETS = """[CASE WHEN length(x) <= 8 THEN 'ui_short' END, CASE WHEN length(x) BETWEEN 9 AND 30 THEN 'ui_mid' END, CASE WHEN length(x) >= 60 THEN 'dialogue_long' END, CASE WHEN regexp_matches(x, '注意|禁止|必须|不可|提示|说明|警告|错误|失败') THEN 'system_rules' END, CASE WHEN regexp_matches(x, '\\{[^}]+\\}|%[sd]|⟦PH_[0-9]+⟧|\\[.*?\\]|<[^>]+>|\\\\n') THEN 'placeholder' END]"""


_ADVERSARIAL = R.BUCKET_ADVERSARIAL.replace("'", "''")
_ALL_BUCKETS = f"CASE WHEN trim(x) = '' THEN ['empty'] ELSE CASE WHEN len(list_filter({_BUCKETS}, lambda y: y IS NOT NULL)) + CASE WHEN odd THEN 1 ELSE 0 END > 0 THEN list_concat({_BUCKETS}, [CASE WHEN odd THEN 'adversarial' END]) ELSE ['other'] END END"


@query(f"WITH t AS (SELECT doc_id, coalesce(text, '') AS x, len(regexp_extract_all(coalesce(text, ''), '{_ADVERSARIAL}')) >= 2 AS odd FROM documents), b AS (SELECT doc_id, unnest({_ALL_BUCKETS}) AS bucket FROM t) SELECT doc_id, bucket FROM b WHERE bucket IS NOT NULL")
def p38_reality_buckets(spark, d):
    return read(spark, d, "documents").select("doc_id", F.explode(C.reality_buckets(c("text"))).alias("bucket"))


def _n(words):
    return " + ".join(f"CAST(contains(source_zh, '{w}') AS INT)" for w in words)


_TOP = {k: _n(v) for k, v in R.TAG_KEYWORDS.items()}
_TAG = "CASE WHEN source_zh = '' THEN 'misc' WHEN starts_with(string_id, 'BTN_') THEN 'ui_button' WHEN starts_with(string_id, 'SKILL_') THEN 'skill_desc' WHEN length(source_zh) <= 4 THEN 'ui_button' " + " ".join(f"WHEN ({e}) > 0 AND ({e}) = greatest({', '.join(_TOP.values())}) THEN '{k}'" for k, e in _TOP.items()) + " WHEN length(source_zh) > 60 THEN 'dialogue' ELSE 'misc' END"
_TOPS = f"greatest({', '.join(_TOP.values())})"
_BUTTON = " OR ".join(f"contains(source_zh, '{k}')" for k in R.TAG_KEYWORDS["ui_button"])
_SURE = f"CASE WHEN source_zh = '' THEN 0.0::DOUBLE WHEN starts_with(string_id, 'BTN_') OR starts_with(string_id, 'SKILL_') THEN 0.95::DOUBLE WHEN length(source_zh) <= 4 AND ({_BUTTON}) THEN 0.95::DOUBLE WHEN length(source_zh) <= 4 THEN 0.7::DOUBLE WHEN {_TOPS} > 0 THEN 0.8::DOUBLE WHEN contains(source_zh, '...') OR length(source_zh) > 60 THEN 0.6::DOUBLE ELSE 0.5::DOUBLE END"


@query(cte("ui") + f"SELECT string_id, {_TAG} AS tag, {_SURE} AS confidence FROM ui")
def p39_heuristic_tag(spark, d):
    tag = C.heuristic_tag(c("source_zh"), c("string_id"))
    return bound(spark, d, "ui").select("string_id", tag["tag"].alias("tag"), tag["confidence"].cast("double").alias("confidence"))


_B = f"(length(source_zh) - length(regexp_replace(source_zh, '{_PLH}', '', 'g')))"


@query(cte("ui") + f"SELECT string_id, greatest(10, CAST(floor((floor((length(source_zh) - {_B}) * 1.8::DOUBLE) + {_B}) * 1.2::DOUBLE) AS INT)) AS expanded, CASE WHEN length(source_zh) <= 10 THEN 'S' WHEN length(source_zh) <= 50 THEN 'M' ELSE 'L' END AS tier, least(CAST(floor(length(source_zh) * 3.5::DOUBLE) AS INT) + 5, 20) AS ruled FROM ui")
def p40_p41_p42_lengths(spark, d):
    s = c("source_zh")
    return bound(spark, d, "ui").select("string_id", C.expanded_length(s, F.lit("zh-CN")).alias("expanded"), C.len_tier(F.length(s)).alias("tier"), C.ruled_length(s, F.lit("ui_button")).alias("ruled"))


def _in(words):
    return ", ".join(f"'{w}'" for w in words)


def _any(words, x="p"):
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


_UIP = cte("ui") + f", q AS (SELECT *, trim(source_zh) AS s, regexp_replace(regexp_replace(source_zh, '{_PLH}', '', 'g'), '\\s+', '', 'g') AS p, length(trim(regexp_replace(trim(source_zh), '{_PLH}', '', 'g'))) AS n, {_B} AS budget FROM ui), k AS (SELECT *, CASE WHEN p = '' THEN 'other_review' WHEN n <= 1 THEN 'badge_micro_1c' WHEN n = 2 AND p IN ({_in(R.BADGE_2C)}) THEN 'badge_micro_2c' WHEN {_any(R.PROMO_PACK)} THEN 'promo_short' WHEN contains(s, '·') THEN 'slogan_long' WHEN n >= 13 THEN 'slogan_long' WHEN {_any(R.PROMO)} THEN 'promo_short' WHEN p IN ({_in(R.GENERIC_LABELS)}) THEN 'label_generic_short' WHEN {_any(R.ITEM_SKILL)} THEN 'item_skill_name' WHEN n = 2 THEN 'label_generic_short' WHEN n <= 8 THEN 'title_name_short' ELSE 'slogan_long' END AS cat FROM q)"


@query(_UIP + " SELECT string_id, cat AS category, CASE WHEN cat = 'badge_micro_2c' THEN 'badge_exact_map' WHEN cat = 'promo_short' AND p IN ('奖励预览','充值返利','今日充值') THEN 'promo_exact_head' WHEN cat = 'promo_short' AND " + _any(R.PROMO_PACK) + " THEN 'promo_compound_pack' WHEN cat = 'promo_short' THEN 'promo_exact_head' WHEN cat = 'item_skill_name' THEN 'item_compact_noun' WHEN cat = 'slogan_long' AND contains(s, '·') THEN 'headline_nameplate' WHEN cat = 'slogan_long' THEN 'headline_singleline' ELSE '' END AS hint FROM k")
def p43_p44_ui_art_category(spark, d):
    s = F.trim(c("source_zh"))
    return bound(spark, d, "ui").select("string_id", C.ui_art_category(s).alias("category")).withColumn("hint", F.lit("")).drop("hint").join(bound(spark, d, "ui").select("string_id", C.ui_art_hint(s, C.ui_art_category(s)).alias("hint")), "string_id")


_TERM = "CASE p " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in R.COMPACT_TERMS.items()) + " ELSE '' END"


@query(_UIP + f" SELECT 'UIART_' || lpad(CAST(row_number() OVER (ORDER BY seq) AS VARCHAR), 6, '0') AS string_id, CAST(row_number() OVER (ORDER BY seq) AS VARCHAR) AS batch_row_id, CASE WHEN s = '' THEN '0' ELSE CAST(CAST(floor(n * 2.3::DOUBLE) AS INT) + budget AS VARCHAR) END AS max_len_target, CASE WHEN s = '' THEN '0' ELSE CAST(CAST(floor(n * 2.5::DOUBLE) AS INT) + budget AS VARCHAR) END AS max_len_review_limit, CASE WHEN s = '' THEN 'EMPTY' WHEN n <= 2 THEN 'XS' WHEN n <= 4 THEN 'S' WHEN n <= 8 THEN 'M' ELSE 'L' END AS len_tier, {_TERM} AS ui_art_compact_term, CASE WHEN s = '' THEN 'skipped_empty' ELSE 'ready' END AS status FROM k")
def p46_prepare_rows(spark, d):
    df = C.prepare_rows(bound(spark, d, "ui"), "source_zh", "string_id", "seq")
    return df.select("string_id", "batch_row_id", "max_len_target", "max_len_review_limit", "len_tier", "ui_art_compact_term", "status")


_CLASS = "CASE " + " ".join(f"WHEN regexp_matches(lower(trim(module_tag)), '{p}') THEN '{k}'" for k, p in R.CONTENT_CLASSES.items()) + " ELSE 'general' END"


@query(cte("ui") + f", k AS (SELECT {_CLASS} AS class FROM ui) SELECT class, CASE WHEN class IN ('ui_button','payment','system','proper_noun') THEN 'high' WHEN class IN ('dialogue','narrative') THEN 'medium' ELSE 'low' END AS risk, count(*) AS n FROM k GROUP BY ALL")
def p48_content_class(spark, d):
    return bound(spark, d, "ui").select(C.content_class(c("module_tag")).alias("class")).withColumn("risk", C.risk_level(c("class"))).groupBy("class", "risk").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, CASE WHEN a >= 0.72 AND b >= 0.7 AND e >= 0.65 THEN 'critical' WHEN a >= 0.40 AND b >= 0.35 AND e >= 0.30 THEN 'proposed' ELSE 'low_confidence' END AS tier, CASE WHEN length(p_name) <= 2 THEN 0.0::DOUBLE WHEN length(p_name) <= 5 THEN 0.05::DOUBLE WHEN length(p_name) <= 7 THEN 0.15::DOUBLE WHEN length(p_name) <= 10 THEN 0.30::DOUBLE ELSE 0.5::DOUBLE END AS penalty FROM (SELECT *, CAST(p_partkey % 100 AS DOUBLE)/100 AS a, CAST(p_partkey % 50 AS DOUBLE)/50 AS b, CAST(p_partkey % 20 AS DOUBLE)/20 AS e FROM part)")
def p50_term_tier(spark, d):
    share = lambda n: (c("p_partkey") % n).cast("double") / n
    return read(spark, d, "part").select("p_partkey", C.term_tier(share(100), share(50), share(20)).alias("tier"), C.length_penalty(c("p_name")).alias("penalty"))


@query(cte("tickets") + "SELECT ticket_id, CASE WHEN review_source IN ('post_gate_blocked','execution_failure') THEN 'P0' WHEN locale = 'ru-RU' THEN 'P1' ELSE 'P2' END AS p, CASE WHEN status IN ('pending','closed','in_review') THEN status ELSE 'pending' END AS s FROM tickets")
def p54_task_priority(spark, d):
    risk = F.when(c("locale") == "ru-RU", "HIGH").otherwise("low")
    return bound(spark, d, "tickets").select("ticket_id", C.task_priority(c("review_source"), risk).alias("p"), C.review_status(c("status")).alias("s"))


_STAGE = "CASE WHEN status = 'failed' THEN 'fail' WHEN files > 0 AND required THEN 'fail' WHEN status = 'warn' THEN 'warn' WHEN status = 'ok' THEN 'pass' ELSE 'unknown' END"


@query(cte("stages") + f", s AS (SELECT run_id, {_STAGE} AS st FROM stages), r AS (SELECT run_id, bool_or(st='fail') AS f, bool_or(st='warn') AS w FROM s GROUP BY run_id) SELECT run_id, CASE WHEN f THEN 'fail' WHEN w THEN 'warn' ELSE 'pass' END AS overall FROM r")
def p55_run_status(spark, d):
    s = bound(spark, d, "stages").withColumn("st", C.stage_status(c("status"), c("files"), c("required")))
    return s.groupBy("run_id").agg(F.collect_set("st").alias("sts")).select("run_id", C.overall_status(F.lit("completed"), F.lit(""), c("sts")).alias("overall"))


@query(cte("tickets") + "SELECT CASE WHEN o = 'running' THEN 'running' WHEN o = 'fail' THEN 'failed' WHEN status = 'pending' OR o = 'warn' THEN 'waiting_on_ops' WHEN cost > 200000 THEN 'ready_to_collect' ELSE 'needs_your_action' END AS bucket, count(*) AS n FROM (SELECT *, CASE ticket_id % 4 WHEN 0 THEN 'pass' WHEN 1 THEN 'warn' WHEN 2 THEN 'fail' ELSE 'running' END AS o FROM tickets) GROUP BY ALL")
def p56_task_bucket(spark, d):
    run = F.element_at(F.array(*map(F.lit, ("pass", "warn", "fail", "running"))), (c("ticket_id") % 4 + 1).cast("int"))
    status = C.task_status(F.lit("queued"), run, F.lit(False), c("status") == "pending", c("cost") > 200000)
    return bound(spark, d, "tickets").groupBy(C.task_bucket(status, F.lit(False)).alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN n_chars >= 1000 THEN 1000 WHEN n_chars >= 500 THEN 500 WHEN n_chars >= 200 THEN 200 WHEN n_chars >= 100 THEN 100 WHEN n_chars >= 50 THEN 50 ELSE 0 END AS bucket, count(*) AS n FROM documents GROUP BY ALL")
def p59_length_bucket(spark, d):
    return read(spark, d, "documents").groupBy(C.length_bucket(c("n_chars")).alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'approve' WHEN 1 THEN 'request_retranslate' WHEN 2 THEN 'ignore' ELSE 'unknown_word' END AS decision FROM orders")
def p60_feedback_decision(spark, d):
    raw = F.element_at(F.array(*map(F.lit, ("Accepted", " revised ", "ignore", "unknown_word"))), (c("o_orderkey") % 4 + 1).cast("int"))
    return read(spark, d, "orders").select("o_orderkey", C.feedback_decision(raw).alias("decision"))


@query("SELECT event_id FROM events WHERE CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END IS NULL OR ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-10 00:00:00'")
def p63_window_filter(spark, d):
    ts = F.when(c("event_id") % 5 != 0, c("ts"))
    lo, hi = F.lit("2024-01-05 00:00:00").cast("timestamp"), F.lit("2024-01-10 00:00:00").cast("timestamp")
    return read(spark, d, "events").filter(ts.isNull() | ts.between(lo, hi)).select("event_id")
