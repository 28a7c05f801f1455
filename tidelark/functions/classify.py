"""Ordered rule classifiers as CASE expressions (first match wins unless said otherwise)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import policy as R
from .order import numbered
from .text import all_matches, clean_source_length, contains_any, placeholder_budget, strip_source, text_or_empty


def cases(branches: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    first, *rest = branches
    out = F.when(first[0], first[1])
    for condition, value in rest:
        out = out.when(condition, value)
    return out.otherwise(otherwise)


def lookup(c: Column, table: Mapping[str, object], default: object = None) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, c), default if isinstance(default, Column) else F.lit(default))


def rank_of(c: Column, table: Mapping[str, int], default: int = 0) -> Column:
    return lookup(c, table, default)


def stratum(c: Column) -> Column:
    c = text_or_empty(c)
    n = F.length(c)
    return cases([(F.trim(c) == "", "Other"), (c.rlike(R.STRATUM_PLACEHOLDER), "Placeholder"), (c.rlike(R.STRATUM_SYSTEM), "System"), (n <= 30, "UI"), (n >= 50, "Dialogue")], "Other")


def reality_buckets(c: Column) -> Column:
    """All buckets a row falls in."""
    c = text_or_empty(c)
    n = F.length(c)
    hits = F.array_compact(F.array(
        F.when(n <= 8, "ui_short"), F.when((n >= 9) & (n <= 30), "ui_mid"), F.when(n >= 60, "dialogue_long"), F.when(c.rlike(R.BUCKET_SYSTEM), "system_rules"),
        F.when(c.rlike(R.BUCKET_PLACEHOLDER), "placeholder"), F.when(F.size(all_matches(c, R.BUCKET_ADVERSARIAL)) >= 2, "adversarial"),
    ))
    return cases([(F.trim(c) == "", F.array(F.lit("empty"))), (F.size(hits) > 0, hits)], F.array(F.lit("other")))


def heuristic_tag(text: Column, string_id: Column, keywords: Mapping[str, Sequence[str]] = R.TAG_KEYWORDS, prefixes: Mapping[str, Sequence[str]] = R.TAG_PREFIXES) -> Column:
    """struct(tag, confidence); of equal keyword counts the first-declared tag wins."""
    text, upper = text_or_empty(text), F.upper(text_or_empty(string_id))
    make = lambda tag, conf: F.struct((tag if isinstance(tag, Column) else F.lit(tag)).alias("tag"), F.lit(conf).alias("confidence"))
    counts = {tag: sum((F.contains(text, F.lit(k)).cast("int") for k in ks), F.lit(0)) for tag, ks in keywords.items()}
    top = F.greatest(*counts.values()) if len(counts) > 1 else next(iter(counts.values()))
    best = cases([(n == top, tag) for tag, n in counts.items()], "misc")
    by_id = [(reduce(lambda a, b: a | b, [upper.startswith(p) for p in ps]), make(tag, 0.95)) for tag, ps in prefixes.items()]
    button = contains_any(text, keywords.get("ui_button", ()))
    rest = [((F.length(text) <= 4) & button, make("ui_button", 0.95)), (F.length(text) <= 4, make("ui_button", 0.7)), (top > 0, make(best, 0.8)), (F.contains(text, F.lit("...")) | (F.length(text) > 60), make("dialogue", 0.6))]
    return cases([(text == "", make("misc", 0.0)), *by_id, *rest], make("misc", 0.5))


def expanded_length(text: Column, locale: Column) -> Column:
    text = text_or_empty(text)
    budget = placeholder_budget(text)
    factor = F.when(F.coalesce(locale, F.lit("")).startswith("zh"), 1.8).otherwise(1.2)
    return F.greatest(F.lit(10), F.floor((F.floor((F.length(text) - budget) * factor) + budget) * 1.2)).cast("int")


def ruled_length(text: Column, content_type: Column, rules: Mapping[str, tuple[float, int]] = R.LENGTH_RULES, default: tuple[float, int, int] = R.LENGTH_DEFAULT) -> Column:
    multiplier = lookup(content_type, {k: v[0] for k, v in rules.items()}, default[0])
    most = lookup(content_type, {k: v[1] for k, v in rules.items()}, default[2])
    return F.least(F.floor(F.length(text_or_empty(text)) * multiplier).cast("int") + default[1], most)


def len_tier(n: Column) -> Column:
    return cases([(n <= 10, "S"), (n <= 50, "M")], "L")


def fine_len_tier(n: Column) -> Column:
    return cases([(n <= 2, "XS"), (n <= 4, "S"), (n <= 8, "M")], "L")


def ui_art_category(source: Column) -> Column:
    source = text_or_empty(source)
    plain, n = strip_source(source), clean_source_length(source)
    newline = F.contains(source, F.lit("\n"))
    return cases([
        (plain == "", "other_review"), (n <= 1, "badge_micro_1c"), ((n == 2) & plain.isin(*R.BADGE_2C), "badge_micro_2c"), (contains_any(plain, R.PROMO_PACK), "promo_short"),
        (F.contains(source, F.lit("·")) & ~newline, "slogan_long"), (newline | (n >= 13), "slogan_long"), (contains_any(plain, R.PROMO), "promo_short"),
        (plain.isin(*R.GENERIC_LABELS), "label_generic_short"), (contains_any(plain, R.ITEM_SKILL), "item_skill_name"), (n == 2, "label_generic_short"),
        (n <= 8, "title_name_short"), (contains_any(plain, R.SLOGAN_MARKS) | (n >= 9), "slogan_long"),
    ], "other_review")


def ui_art_hint(source: Column, category: Column) -> Column:
    source = text_or_empty(source)
    plain, newline = strip_source(source), F.contains(source, F.lit("\n"))
    promo, slogan = category == "promo_short", category == "slogan_long"
    return cases([
        (category == "badge_micro_2c", "badge_exact_map"), (promo & plain.isin(*R.PROMO_HEADS), "promo_exact_head"), (promo & contains_any(plain, R.PROMO_PACK), "promo_compound_pack"),
        (promo, "promo_exact_head"), (category == "item_skill_name", "item_compact_noun"), (slogan & F.contains(source, F.lit("·")) & ~newline, "headline_nameplate"),
        (slogan & newline, "headline_multiline"), (slogan, "headline_singleline"),
    ], "")


def translation_mode(source: Column, category: Column, hint: Column, rule: Column, term: Column) -> Column:
    """struct(mode, prefill)."""
    exact = lambda v: F.struct(F.lit("prefill_exact").alias("mode"), v.alias("prefill"))
    llm = F.struct(F.lit("llm").alias("mode"), F.lit("").alias("prefill"))
    head = lookup(strip_source(source), R.PROMO_EXACT, "")
    promo = (category == "promo_short") & (hint == "promo_exact_head")
    known = term != ""
    return cases([((rule == "dictionary_only") & known, exact(term)), (promo & (head != ""), exact(head)), (promo, llm), (((category == "item_skill_name") | (hint == "headline_nameplate")) & known, exact(term))], llm)


def prepare_rows(df: DataFrame, source: str, source_id: str, order: str, ratio: float = 2.3, review_ratio: float = 2.5, source_locale: str = "zh-CN", target_locale: str = "ru-RU", module_tag: str = "ui_art") -> DataFrame:
    """The UI-art enrichment: 21 derived columns; numbers count the rows in ``order``.

    The running number follows ranges of the order, so no task sorts the whole table.
    """
    text = F.trim(text_or_empty(F.col(source)))
    n, budget, empty = clean_source_length(text), placeholder_budget(text), text == ""
    df = numbered(df, [order], "_n").withColumns({"_text": text, "ui_art_category": ui_art_category(text)})
    text, category = F.col("_text"), F.col("ui_art_category")
    df = df.withColumns({"ui_art_strategy_hint": ui_art_hint(text, category), "ui_art_compact_term": lookup(strip_source(text), R.COMPACT_TERMS, "")})
    term = F.col("ui_art_compact_term")
    only = category.isin(*R.DICT_ONLY)
    df = df.withColumn("compact_rule", F.when(only, "dictionary_only").otherwise("compact_preferred"))
    mode = translation_mode(text, category, F.col("ui_art_strategy_hint"), F.col("compact_rule"), term)
    working = F.format_string("UIART_%06d", F.col("_n"))
    bound = lambda r: F.when(empty, 0).otherwise(F.floor(n * r) + budget).cast("string")
    return df.withColumns({
        "batch_row_id": F.col("_n").cast("string"), "source_string_id": F.trim(text_or_empty(F.col(source_id).cast("string"))), "working_string_id": working, "string_id": working,
        "source_locale": F.lit(source_locale), "target_locale": F.lit(target_locale), "module_tag": F.lit(module_tag), "module_confidence": F.lit("1.0"),
        "source_len_clean": n.cast("string"), "placeholder_budget": budget.cast("string"), "max_len_target": bound(ratio), "max_len_review_limit": bound(review_ratio),
        "len_tier": F.when(text == "", "EMPTY").otherwise(fine_len_tier(n)),
        "compact_mapping_status": cases([(term != "", "approved_available"), (only, "manual_review_required")], "optional"),
        "translation_mode": mode["mode"], "prefill_target_ru": mode["prefill"], "length_policy": F.lit(f"ui_art_ratio_{ratio:.1f}_review_{review_ratio:.1f}"),
        "status": F.when(text == "", "skipped_empty").otherwise("ready"),
    }).drop("_n", "_text")


def length_policy(category: Column, source_len: Column, budget: Column, base_target: Column, base_review: Column) -> Column:
    """struct(category, hard_limit, review_limit, issue_type)."""
    known = F.when(category.isin(*R.LENGTH_POLICY), category).otherwise("other_review")
    at = lambda i: lookup(known, {k: v[i] for k, v in R.LENGTH_POLICY.items()})
    scaled = lambda r: F.when(r > 0, F.floor(source_len * r).cast("int") + budget).otherwise(0)
    return F.struct(known.alias("category"), F.greatest(base_target, at(0) + budget, scaled(at(1))).alias("hard_limit"), F.greatest(base_review, at(2) + budget, scaled(at(3))).alias("review_limit"), at(4).alias("issue_type"))


def content_class(module: Column) -> Column:
    low = F.lower(F.trim(text_or_empty(module)))
    return cases([(low.rlike(p), name) for name, p in R.CONTENT_CLASSES.items()], "general")


def risk_level(content: Column) -> Column:
    return cases([(content.isin(*R.HIGH_RISK), "high"), (content.isin("dialogue", "narrative"), "medium")], "low")


def recommended_action(deltas: Column, risk: Column) -> Column:
    overlap = lambda names: F.arrays_overlap(deltas, F.array(*map(F.lit, names)))
    return cases([((risk == "high") & (F.size(deltas) > 0), "manual_review"), (overlap(R.HARD_DELTAS), "manual_review"), (overlap(R.RETRANSLATE_DELTAS), "retranslate"), (overlap(R.REFRESH_DELTAS), "auto_refresh")], "skip")


def term_tier(stability: Column, boundary: Column, context: Column) -> Column:
    return cases([((stability >= 0.72) & (boundary >= 0.7) & (context >= 0.65), "critical"), ((stability >= 0.40) & (boundary >= 0.35) & (context >= 0.30), "proposed")], "low_confidence")


def length_penalty(term: Column) -> Column:
    n = F.length(term)
    return cases([(n <= 2, 0.0), (n <= 5, 0.05), (n <= 7, 0.15), (n <= 10, 0.30)], 0.5)


def termness(term: Column, skill: Column, item: Column, dialogue: Column, hints: Sequence[str] = ()) -> Column:
    n = F.length(term)
    plus = lambda condition, v: F.when(condition, v).otherwise(0.0)
    score = F.lit(0.5) + plus(n >= 3, 0.1) + plus(n >= 4, 0.1) + plus(contains_any(term, hints), 0.15) + plus(skill > 0.3, 0.1) + plus(item > 0.3, 0.05) + plus(dialogue > 0.5, -0.2)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def soft_item_class(issue: Column, mode: Column, prefill: Column, term: Column, mapping: Column, residual: Sequence[str] = ("mistranslation", "terminology", "placeholder", "ambiguity_high_risk"), noise: Sequence[str] = ("length", "style", "brevity")) -> Column:
    compact = (mode == "prefill_exact") | (prefill != "") | (term != "") | (mapping == "approved_available")
    return cases([(issue.isin(*residual), "true_residual"), (issue.isin(*noise) & compact, "compact_policy_noise")], "mixed_review")


def has_issue(issues: Column, *names: str) -> Column:
    return F.arrays_overlap(issues, F.array(*map(F.lit, names)))


def residual_lane(source: Column, category: Column, mapping: Column, issues: Column, manual: Sequence[str] = ("",), headline: Sequence[str] = ("",), promo: Sequence[str] = ("",), items: Sequence[str] = ("",), item_hints: Sequence[str] = R.ITEM_SKILL[-8:]) -> Column:
    s = strip_source(source)
    return cases([
        (((s != "") & s.isin(*manual)) | has_issue(issues, "ambiguity_high_risk"), "creative_title_manual"),
        ((category == "badge_micro_1c") & (has_issue(issues, "compact_mapping_missing") | (mapping == "manual_review_required")), "badge_micro_gap_cleanup"),
        ((category == "slogan_long") | ((s != "") & s.isin(*headline)) | has_issue(issues, "headline_budget_overflow", "line_budget_overflow"), "headline_slogan_repair"),
        (((s != "") & s.isin(*promo)) | F.contains(s, F.lit("预览")) | (category == "promo_short") | has_issue(issues, "promo_expansion_forbidden"), "promo_exact_or_compound"),
        (((s != "") & s.isin(*items)) | contains_any(s, item_hints), "item_skill_family_compact"),
        (category.isin("title_name_short", "label_generic_short"), "headline_slogan_repair"),
    ], "creative_title_manual")


def repair_hint(source: Column, category: Column, lane: Column) -> Column:
    """A short code per lane and family; texts of hints belong to the caller."""
    s = strip_source(source)
    return cases([
        ((lane == "promo_exact_or_compound") & s.endswith("预览"), "promo_preview"), (lane == "promo_exact_or_compound", "promo_compact"), ((lane == "item_skill_family_compact") & s.endswith("试炼"), "item_trial"),
        ((lane == "item_skill_family_compact") & F.contains(s, F.lit("之力")), "item_power"), ((lane == "item_skill_family_compact") & F.contains(s, F.lit("之门")), "item_gate"), (lane == "item_skill_family_compact", "item_compact"),
        ((lane == "headline_slogan_repair") & (category == "slogan_long"), "headline_lines"), (lane == "headline_slogan_repair", "headline_short"), (lane == "badge_micro_gap_cleanup", "badge_exact"),
    ], "manual_only")


def title_family(source: Column, exact: Sequence[str] = ("",), nouns: Sequence[str] = ()) -> Column:
    s = strip_source(source)
    return cases([(s.endswith("试炼"), "trial_family"), (s.endswith("预览"), "preview_family"), (contains_any(s, ("之门", "之力")), "door_power_family"), ((s != "") & s.isin(*exact), "exact_title_family"), (contains_any(s, nouns), "noun_title_family"), (contains_any(s, ("·", "・")), "nameplate_title_family")], "singleton_family")


def manual_bucket(source: Column, category: Column, issues: Column, creative: Sequence[str] = ("",), ambiguous: Sequence[str] = ("",), lore: Sequence[str] = ("",), exact: Sequence[str] = ("",)) -> Column:
    s = strip_source(source)
    within = lambda names: (s != "") & s.isin(*names)
    return cases([(within(creative), "manual_creative_titles"), (within(ambiguous) | has_issue(issues, "ambiguity_high_risk"), "manual_ambiguity_terms"), ((category == "label_generic_short") & has_issue(issues, "terminology"), "manual_ambiguity_terms"), (within(lore) & ~within(exact), "manual_ambiguity_terms")], "")


def auto_fix(source: Column, category: Column, severity: Column, family: Column, issues: Column, repeated: Column, bucket: Column, known: Sequence[str] = ("",), safe: Sequence[str] = ("trial_family", "preview_family", "door_power_family", "noun_title_family", "nameplate_title_family", "exact_title_family")) -> Column:
    s = strip_source(source)
    fit = (repeated >= 2) & family.isin(*safe) & category.isin("title_name_short", "item_skill_name", "promo_short", "label_generic_short") & severity.isin("warning", "major", "critical")
    return cases([((bucket != "") | has_issue(issues, "ambiguity_high_risk", "placeholder"), False), ((s != "") & s.isin(*known), True)], fit)


def narrow_lane(category: Column, severity: Column, family: Column) -> Column:
    return cases([(severity == "warning", "warning_family_compact"), ((family == "door_power_family") | (category == "item_skill_name"), "lore_skill_compact")], "canonical_title_compact")


def leakage_origin(category: Column, lane: Column, family: Column) -> Column:
    return cases([
        (category != "title_name_short", ""), (lane.isin("item_skill_family_compact", "promo_exact_or_compound", "headline_slogan_repair"), lane),
        (family.isin("trial_family", "preview_family", "door_power_family"), F.concat(family, F.lit("_into_title_name_short"))), (family.isin("noun_title_family", "nameplate_title_family"), "headline_title_leakage"),
    ], "")


def task_priority(review_source: Column, risk: Column) -> Column:
    return cases([(review_source.isin("post_gate_blocked", "execution_failure"), "P0"), (F.lower(text_or_empty(risk)) == "high", "P1")], "P2")


def review_status(c: Column) -> Column:
    c = F.trim(text_or_empty(c))
    return F.when(c.isin(*R.REVIEW_STATES), c).otherwise("pending")


def stage_status(raw: Column, missing: Column, required: Column) -> Column:
    s = F.lower(F.trim(text_or_empty(raw)))
    return cases([(s.isin("fail", "failed", "error", "blocked"), "fail"), ((missing > 0) & required, "fail"), (s.isin("warn", "warning"), "warn"), (s.isin("pass", "passed", "success", "ok"), "pass"), (s.isin("running", "in_progress", "pending"), "running"), (missing > 0, "warn")], "unknown")


def overall_status(manifest: Column, verify: Column, stages: Column) -> Column:
    """Of a run: ``stages`` is the array of its stages' statuses."""
    m, v = F.lower(F.trim(text_or_empty(manifest))), F.upper(text_or_empty(verify))
    has = lambda s: F.array_contains(stages, s)
    good = m.isin("success", "pass", "completed") & (F.size(stages) > 0) & F.forall(stages, lambda s: s == "pass")
    return cases([(m.isin("running", "pending"), "running"), ((v == "FAIL") | m.isin("fail", "failed") | has("fail"), "fail"), ((v == "WARN") | has("warn"), "warn"), ((v == "PASS") | good, "pass")], "unknown")


def task_status(stored: Column, run_status: Column, pending: Column, case_open: Column, approved: Column) -> Column:
    run = F.lower(F.trim(text_or_empty(run_status)))
    kept = lambda fallback: F.when(stored.isin(*R.TASK_BUCKETS), stored).otherwise(fallback)
    bad = run.isin("fail", "failed", "blocked")
    return cases([
        (run_status.isNull(), kept("draft")), (run.isin("running", "pending"), "running"), (bad, "failed"), (pending, kept("queued")), (case_open | (run == "warn"), "needs_operator_review"),
        ((run == "pass") & ((stored == "ready_for_download") | approved), "ready_for_download"), (run == "pass", "needs_user_action"),
    ], kept("running"))


def task_bucket(status: Column, archived: Column) -> Column:
    return F.when(archived, "archived").otherwise(lookup(status, R.TASK_BUCKETS, "running"))


def hotspot_hint(priority: Column) -> Column:
    return cases([(priority == "P0", "BLOCK"), (priority.isin("P1", "P2"), "REWORK")], "KEEP")


def semantic_status(score: Column, error: float = 0.50, warn: float = 0.65) -> Column:
    return cases([(score < error, "error"), (score < warn, "warning")], "ok")


def length_bucket(n: Column, edges: Sequence[int] = (0, 50, 100, 200, 500, 1000)) -> Column:
    return cases([(n >= e, e) for e in sorted(edges, reverse=True)], edges[0])


def feedback_decision(c: Column) -> Column:
    c = F.lower(F.trim(text_or_empty(c)))
    return lookup(c, R.DECISIONS, c)


def focus_eligible(source: Column, most: int = 18) -> Column:
    s = strip_spaces_only(source)
    return (s != "") & (F.length(s) <= most) & ~s.rlike("[，。！？：；、…,.!?:;]") & ~s.rlike("^[0-9]+$") & ~s.rlike("^[一二三四五六七八九十百千万零]+$")


def strip_spaces_only(c: Column) -> Column:
    return F.regexp_replace(text_or_empty(c), "\\s+", "")


def suggested_action(issues: Column) -> Column:
    return cases([(has_issue(issues, "placeholder_mismatch"), "fix_placeholders"), (has_issue(issues, "length_overflow"), "shorten"), (has_issue(issues, "glossary_violation"), "check_glossary"), (has_issue(issues, "meaning_reversal"), "retranslate")], "manual_review")
