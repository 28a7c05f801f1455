"""Placeholder, token and text-normalisation functions, Column -> Column, all of them built-ins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token format and the placeholder grammar.
TOKEN = "⟦(PH_\\d+|TAG_\\d+)⟧"
FROZEN = "⟦[A-Z]+_\\d+⟧"
PLACEHOLDER = "\\{[0-9A-Za-z_]+\\}|%[sd]|<[^>]+>|\\[.+?\\]|【.+?】"
PATTERNS: tuple[tuple[str, str, str], ...] = (
    ("brace", "PH", "\\{(?:[0-9]+|[A-Za-z_][A-Za-z0-9_]*)(?::[0-9A-Za-z_.\\-]+)?\\}"),
    ("printf", "PH", "%(?:[0-9]+\\$)?[-+ 0#]*[0-9]*(?:\\.[0-9]+)?[sSdiuxXfFeEgG]"),
    ("angle", "TAG", "</?[A-Za-z0-9_]+(?:\\s*=?\\s*[^>]*)?>"),
    ("square", "PH", "\\[(?:[A-Z][A-Z0-9_]*|[0-9]+)\\]"),
    ("escape", "PH", "\\\\[ntr]"),
    ("open_bracket", "PH", "【"),
    ("close_bracket", "PH", "】"),
)
CJK = "[\\u4e00-\\u9fff]"
WORD = "[A-Za-zА-Яа-яЁё0-9]+"


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def all_matches(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text_or_empty(c), F.lit(pattern), F.lit(group))


def extract_tokens(c: Column) -> Column:
    """Tokens without their brackets, duplicates kept, in order."""
    return all_matches(c, TOKEN, 1)


def multiset(tokens: Column) -> Column:
    """Token -> count."""
    return F.map_from_entries(F.transform(F.array_distinct(tokens), lambda x: F.struct(x.alias("key"), F.size(F.filter(tokens, lambda y: y == x)).alias("value"))))


def tokens_signature(c: Column) -> Column:
    return multiset(extract_tokens(c))


def same_tokens(a: Column, b: Column) -> Column:
    """Equality of token multisets."""
    return F.array_sort(extract_tokens(a)) == F.array_sort(extract_tokens(b))


def occurrences(c: Column, literal: str) -> Column:
    c = text_or_empty(c)
    return ((F.length(c) - F.length(F.replace(c, F.lit(literal), F.lit("")))) / len(literal)).cast("int")


def unbalanced_basic(c: Column) -> Column:
    """Codes of the bracket kinds whose opening and closing counts differ."""
    pairs = (("{", "}", "brace_unbalanced"), ("<", ">", "angle_unbalanced"), ("[", "]", "square_unbalanced"))
    return F.array_compact(F.array(*[F.when(occurrences(c, a) != occurrences(c, b), F.lit(code)) for a, b, code in pairs]))


def is_long_text(c: Column, threshold: int = 200) -> Column:
    return F.when(F.length(text_or_empty(c)) >= threshold, "true").otherwise("false")


def has_placeholder(c: Column) -> Column:
    return text_or_empty(c).rlike(TOKEN + "|\\{[^}]+\\}|%[sdif]|\\[[A-Z0-9_]+\\]|\\\\[ntr]|[【】]")


def repair_placeholders(c: Column) -> Column:
    """The set of placeholders a repair must keep, sorted."""
    return F.array_sort(F.array_distinct(all_matches(c, "⟦(?:PH|TAG)_\\d+⟧|\\{[^}]+\\}|%[sd]|<[^>]+>")))


def frozen_sequence(c: Column) -> Column:
    return all_matches(c, FROZEN)


def count_placeholders(c: Column, pattern: str = PLACEHOLDER) -> Column:
    return F.size(all_matches(c, pattern))


def placeholder_budget(c: Column, pattern: str = PLACEHOLDER) -> Column:
    """Letters taken up by placeholders."""
    c = text_or_empty(c)
    return F.length(c) - F.length(F.regexp_replace(c, pattern, ""))


def clean_source_length(c: Column, pattern: str = PLACEHOLDER) -> Column:
    return F.length(F.regexp_replace(F.regexp_replace(text_or_empty(c), pattern, ""), "^\\s+|\\s+$", ""))


def restore_tokens(c: Column, mapping: Column) -> Column:
    """Tokens replaced by their originals; each token of the mapping once, longer names first."""
    entries = F.array_sort(F.map_entries(mapping), lambda a, b: F.length(b["key"]) - F.length(a["key"]))
    return F.aggregate(entries, text_or_empty(c), lambda text, e: F.replace(text, F.concat(F.lit("⟦"), e["key"], F.lit("⟧")), e["value"]))


def unknown_tokens(c: Column, mapping: Column) -> Column:
    return F.filter(extract_tokens(c), lambda t: ~F.array_contains(F.map_keys(mapping), t))


def sanitize_punctuation(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Ordered literal replacements."""
    out = text_or_empty(c)
    for source, target in rules:
        out = F.replace(out, F.lit(source), F.lit(target))
    return out


def fix_printf_spacing(c: Column) -> Column:
    return F.regexp_replace(text_or_empty(c), "%\\s+((?:[0-9]+\\$)?[a-zA-Z])", "%$1")


def squeeze(c: Column) -> Column:
    """Non-breaking and zero-width spaces gone, white space collapsed, wrapping quotes made plain."""
    c = F.regexp_replace(text_or_empty(c), "\\x{a0}", " ")
    c = F.regexp_replace(c, "[\\x{200b}\\x{feff}]", "")
    c = F.trim(F.regexp_replace(c, "\\s+", " "))
    return F.regexp_replace(c, "^[«“\"](.*)[»”\"]$", "\"$1\"")


def strip_spaces(c: Column) -> Column:
    return F.regexp_replace(text_or_empty(c), "\\s+", "")


def strip_source(c: Column, pattern: str = PLACEHOLDER) -> Column:
    return strip_spaces(F.regexp_replace(text_or_empty(c), pattern, ""))


def normalize_locale(c: Column) -> Column:
    parts = F.split(F.replace(F.trim(text_or_empty(c)), F.lit("_"), F.lit("-")), "-")
    return F.when(F.size(parts) > 1, F.concat(F.lower(parts[0]), F.lit("-"), F.upper(F.element_at(parts, 2)))).otherwise(F.lower(parts[0]))


def target_key(c: Column) -> Column:
    return F.concat(F.lit("target_"), F.lower(F.element_at(F.split(normalize_locale(c), "-"), 1)))


def prohibited_alias(c: Column) -> Column:
    """``a -> b`` gives b; quotes and brackets around it go."""
    return F.regexp_replace(F.trim(F.element_at(F.split(text_or_empty(c), "->", 2), -1)), "^[\"'«»“”\\[\\]()\\s]+|[\"'«»“”\\[\\]()\\s]+$", "")


def stage_name(c: Column, prefixes: Sequence[tuple[str, str]]) -> Column:
    """Parentheses dropped, spaces collapsed, the first matching prefix's canonical name."""
    plain = F.lower(F.trim(F.regexp_replace(F.regexp_replace(text_or_empty(c), "\\([^)]*\\)", ""), "\\s+", " ")))
    out = F.when(F.lit(False), "")
    for prefix, name in prefixes:
        out = out.when(plain.startswith(prefix), name)
    return out.otherwise(plain)


def format_examples(examples: Column, n: int = 3, width: int = 80) -> Column:
    clean = F.transform(F.slice(examples, 1, n), lambda x: F.substring(F.regexp_replace(F.replace(x, F.lit('"'), F.lit("'")), "[\\r\\n]+", " "), 1, width))
    return F.concat_ws(" | ", clean)


def visual_lines(c: Column) -> Column:
    return F.greatest(F.lit(1), F.size(F.split(text_or_empty(c), "\\\\n|\\n")))


def content_words(c: Column) -> Column:
    return F.size(F.filter(all_matches(c, WORD), lambda w: ~w.rlike("^[0-9]+$")))


def contains_any(c: Column, terms: Sequence[str]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(text_or_empty(c), F.lit(t))
    return out


def promo_tail(c: Column, terms: Sequence[str] = ("превью", "выбор", "ниндзя")) -> Column:
    return contains_any(F.lower(c), terms)


def cjk_remaining(c: Column) -> Column:
    return text_or_empty(c).rlike(CJK)


def meta_response(c: Column, phrases: Sequence[str] = ("here is", "translation:", "as an ai", "i cannot", "sorry")) -> Column:
    return contains_any(F.lower(c), phrases)


def missing_sections(c: Column, headers: Sequence[str]) -> Column:
    return F.filter(F.array(*map(F.lit, headers)), lambda h: ~F.regexp_like(text_or_empty(c), F.concat(F.lit("(?im)^#+\\s*"), h)))
