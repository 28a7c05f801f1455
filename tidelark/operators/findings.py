"""Quality rules: a row gives an array of findings, explode gives one row each, reports are aggregates over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import policy as R
from ..functions.classify import cases, length_policy
from ..functions.text import PATTERNS, all_matches, cjk_remaining, content_words, extract_tokens, frozen_sequence, meta_response, promo_tail, repair_placeholders, same_tokens, text_or_empty, visual_lines
from .helpers import multiset_diff

FINDING = "array<struct<type:string,severity:string,detail:string>>"
APPROVED = ("empty_source_translation_soft", "source_tag_unbalanced")


def finding(kind: Column | str, severity: Column | str, detail: Column) -> Column:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(as_col(kind).alias("type"), as_col(severity).alias("severity"), detail.cast("string").alias("detail"))


def when_found(condition: Column, kind: Column | str, severity: Column | str, detail: Column) -> Column:
    return F.when(condition, F.array(finding(kind, severity, detail))).otherwise(F.array().cast(FINDING))


def token_mismatch(source: Column, target: Column) -> Column:
    """One error per distinct missing token; one extra token that the source has, one time too many, is a soft warning;
    otherwise one error per distinct extra token."""
    a, b = extract_tokens(source), extract_tokens(target)
    missing, extra = multiset_diff(a, b), multiset_diff(b, a)
    soft = (F.size(extra) == 1) & F.array_contains(a, F.element_at(F.map_keys(extra), 1)) & (F.element_at(F.map_values(extra), 1) == 1)
    lost = F.transform(F.array_sort(F.map_keys(missing)), lambda t: finding("token_mismatch", "critical", F.concat(F.lit("missing "), t)))
    more = F.transform(F.array_sort(F.map_keys(extra)), lambda t: finding(F.when(soft, "token_mismatch_soft").otherwise("token_mismatch"), F.when(soft, "warning").otherwise("critical"), F.concat(F.lit("extra "), t)))
    return F.concat(lost, more)


def tag_sides(text: Column) -> Column:
    """struct(opens, closes) of a text's tags; self-closing ones are neither."""
    tags = all_matches(text, PATTERNS[2][2])
    closes = F.size(F.filter(tags, lambda t: t.startswith("</") & ~t.endswith("/>")))
    opens = F.size(F.filter(tags, lambda t: ~t.startswith("</") & ~t.endswith("/>") & ~t.rlike(f"(?i)^<\\s*(?:{R.SELF_CLOSING})\\b")))
    return F.struct(opens.alias("opens"), closes.alias("closes"))


def source_tags_unbalanced(source: Column) -> Column:
    sides = tag_sides(source)
    return when_found(sides["opens"] != sides["closes"], "source_tag_unbalanced", "warning", F.concat_ws("/", sides["opens"].cast("string"), sides["closes"].cast("string")))


def _of_family(tag: Column, patterns: Sequence[str]) -> Column:
    low = F.lower(tag)
    out = F.lit(False)
    for p in patterns:
        if p in ("<c", "</c"):  # the short colour tag must not take longer names
            out = out | low.rlike(f"^{p[:-1]}\\s*c[\\s>]")
        else:
            out = out | low.startswith(p)
    return out


def paired_tags(target: Column, mapping: Column) -> Column:
    """Per tag family, opening and closing tags of the target (through the placeholder map) must be as many."""
    tags = F.transform(F.filter(extract_tokens(target), lambda t: t.startswith("TAG_")), lambda t: F.coalesce(F.try_element_at(mapping, t), F.lit("")))
    checks = []
    for family, (opens, closes) in R.TAG_FAMILIES.items():
        a, b = F.size(F.filter(tags, _member(opens))), F.size(F.filter(tags, _member(closes)))
        checks.append(when_found(a != b, "tag_unbalanced", "critical", F.concat(F.lit(f"{family} "), a.cast("string"), F.lit("/"), b.cast("string"))))
    return F.concat(*checks)


def _member(patterns: Sequence[str]):
    return lambda tag: _of_family(tag, patterns)


def open_close(target: Column, mapping: Column) -> Column:
    """The fallback without families: all opening against all closing tags."""
    tags = F.transform(F.filter(extract_tokens(target), lambda t: t.startswith("TAG_")), lambda t: F.coalesce(F.try_element_at(mapping, t), F.lit("")))
    closes = F.size(F.filter(tags, lambda t: t.startswith("</")))
    opens = F.size(F.filter(tags, lambda t: t.startswith("<") & ~t.startswith("</") & ~t.endswith("/>")))
    return when_found(opens != closes, "tag_unbalanced", "critical", F.concat_ws("/", opens.cast("string"), closes.cast("string")))


def forbidden(target: Column, patterns: Sequence[str] = R.FORBIDDEN) -> Column:
    """The first matching pattern only."""
    hit = F.coalesce(*[F.when(text_or_empty(target).rlike(p), F.lit(p)) for p in patterns])
    return when_found(hit.isNotNull(), "forbidden_hit", "critical", hit)


def unknown_token(target: Column, mapping: Column) -> Column:
    """One error per occurrence of a token that the map lacks."""
    return F.transform(F.filter(extract_tokens(target), lambda t: ~F.array_contains(F.map_keys(mapping), t)), lambda t: finding("new_placeholder_found", "critical", t))


def unfrozen(source: Column, target: Column) -> Column:
    """Per pattern, the first match that is no token and not verbatim in the source."""
    out = []
    for name, _, pattern in PATTERNS:
        first = F.get(F.filter(all_matches(target, pattern), lambda m: ~F.contains(text_or_empty(source), m) & ~m.startswith("⟦")), 0)
        out.append(when_found(first.isNotNull(), "unfrozen_placeholder", "critical", F.concat(F.lit(f"{name} "), first)))
    return F.concat(*out)


def length_finding(target: Column, source: Column, policy: Column, hint: Column, rule: Column, term: Column, mapping: Column) -> Column:
    """Length, line, compact-term, promo and word-count policy: at most one finding."""
    target, source = text_or_empty(target), text_or_empty(source)
    plain, n, lines = F.trim(target), F.length(target), visual_lines(target)
    category, limit, review = policy["category"], policy["hard_limit"], policy["review_limit"]
    over_lines = (category == "slogan_long") & hint.isin("", "headline_multiline") & (lines > visual_lines(source))
    only = rule == "dictionary_only"
    miss = (term != "") & (plain != term)
    compact = cases([(only & (mapping == "manual_review_required") & (n > 0), "compact_mapping_missing"), ((only | (hint == "promo_exact_head")) & miss, "compact_term_miss")], "")
    exact = (term != "") & (plain == term) & (only | hint.isin("promo_exact_head", "headline_nameplate"))
    wordy = (category == "item_skill_name") & miss & (content_words(plain) > 2)
    content = cases([(compact != "", ""), ((hint == "promo_compound_pack") & promo_tail(plain), "promo_expansion_forbidden"), (wordy, "length_overflow")], "")
    kind = F.coalesce(F.nullif(compact, F.lit("")), F.nullif(content, F.lit("")), policy["issue_type"])
    severity = F.when((review > 0) & (n > review), "critical").otherwise("major")
    detail = cases([
        (kind == "compact_mapping_missing", "no approved compact mapping"), (kind == "compact_term_miss", F.concat(F.lit("expected "), term)), (kind == "promo_expansion_forbidden", "banned expansion tail"),
        ((kind == "length_overflow") & wordy, F.concat(content_words(plain).cast("string"), F.lit(" content words; at most 2"))), (severity == "major", F.concat(F.lit("length "), n.cast("string"), F.lit(" > target "), limit.cast("string"))),
    ], F.concat(F.lit("length "), n.cast("string"), F.lit(" > review limit "), review.cast("string")))
    fine = (limit <= 0) | exact | ((n <= limit) & (compact == "") & (content == ""))
    lines_found = when_found(over_lines & (limit > 0), "line_budget_overflow", "critical", F.concat(F.lit("lines "), lines.cast("string")))
    return F.when(over_lines & (limit > 0), lines_found).otherwise(when_found(~fine, kind, severity, detail))


def routed(source: Column, target: Column, rules: Column) -> Column:
    """Blank on both sides warns, a blank target is an error, all else goes through ``rules``."""
    blank = lambda c: F.trim(text_or_empty(c)) == ""
    none = F.lit(None).cast("string")
    both = blank(source) & blank(target)
    return F.when(both, F.array(finding("empty_source_translation_soft", "warning", none))).when(blank(target), F.array(finding("empty_translation", "critical", none))).otherwise(rules)


def hard_findings(df: DataFrame, source: str, target: str, mapping: Column | None = None) -> DataFrame:
    """All row rules but length: the columns of ``df`` and one row per finding (type, severity, detail)."""
    s, t = F.col(source), F.col(target)
    tag_target = F.exists(extract_tokens(t), lambda x: x.startswith("TAG_"))
    rules = [token_mismatch(s, t), forbidden(t), unfrozen(s, t)]
    if mapping is not None:
        unbalanced = source_tags_unbalanced(s)
        rules += [F.when(~tag_target, F.array().cast(FINDING)).when(F.size(unbalanced) > 0, unbalanced).otherwise(paired_tags(t, mapping)), unknown_token(t, mapping)]
    return df.withColumn("_f", F.explode(routed(s, t, F.concat(*rules)))).select(*df.columns, "_f.type", "_f.severity", "_f.detail")


def report(findings: DataFrame) -> DataFrame:
    """Counts by type and severity, warnings split into approved and actionable ones."""
    return findings.groupBy("type", "severity").agg(F.count("*").alias("n")).withColumn("approved", (F.col("severity") == "warning") & F.col("type").isin(*APPROVED))


def translation_verdict(source: Column, target: Column) -> Column:
    return cases([(~same_tokens(source, target), "token_mismatch"), (cjk_remaining(target), "cjk_remaining"), (F.trim(text_or_empty(target)) == "", "empty")], "ok")


def repair_failures(source: Column, target: Column, most: Column) -> Column:
    """All failed checks of a repair (none: it passes)."""
    t = text_or_empty(target)
    return F.array_compact(F.array(
        F.when((most > 0) & (F.length(t) > most), "length"), F.when(repair_placeholders(source) != repair_placeholders(t), "placeholder_set"), F.when(frozen_sequence(source) != frozen_sequence(t), "token_sequence"),
        F.when(F.trim(t) == "", "empty"), F.when(meta_response(t), "meta"), F.when(cjk_remaining(t), "cjk"),
    ))


def length_review(df: DataFrame, target: str, limit: str, review: str, share: float = 0.95) -> DataFrame:
    """Rows at or above ``share`` of their limit, with a severity."""
    n = F.length(text_or_empty(F.col(target)))
    severity = cases([(n > F.col(review), "critical"), (n > F.col(limit), "major"), (n >= F.col(limit) * share, "warning")])
    return df.withColumns({"target_len": n, "severity": severity}).filter(F.col("severity").isNotNull())

