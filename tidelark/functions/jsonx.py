"""Tolerant parsing of model output: a ladder of SQL expressions, null where a rung fails."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ITEM = "struct<id:string,string_id:string,text:string,target:string,confidence:double>"
LIST = f"array<{ITEM}>"
WRAPPED = f"struct<items:{LIST},results:{LIST},data:{LIST},translations:{LIST},candidates:{LIST}>"


def _as_list(c: Column) -> Column:
    """The array itself, or what a known wrapper holds; null if it parses as neither."""
    whole = F.when(c.rlike("^\\s*\\["), F.from_json(c, LIST))
    box = F.transform(F.array(F.when(c.rlike("^\\s*\\{"), F.from_json(c, WRAPPED))), lambda b: F.coalesce(b["items"], b["results"], b["data"], b["translations"], b["candidates"]))
    return F.coalesce(whole, box[0])


def _clean(items: Column) -> Column:
    """Id aliases unified; null where the parse left holes."""
    made = lambda xs: F.transform(xs, lambda x: F.struct(F.coalesce(x["id"], x["string_id"]).alias("id"), F.coalesce(x["text"], x["target"]).alias("text"), x["confidence"].alias("confidence")))
    whole = lambda xs: F.when(xs.isNotNull() & F.forall(xs, lambda x: x["id"].isNotNull() | x["text"].isNotNull()), xs)
    return F.transform(F.transform(F.array(items), made), whole)[0]


def strip_thinking(c: Column) -> Column:
    return F.regexp_replace(c, "(?s)<thinking>.*?</thinking>", "")


def strip_fence(c: Column) -> Column:
    body = F.regexp_extract(c, "(?s)```(?:json)?\\s*(.*?)```", 1)
    return F.when(body != "", body).otherwise(c)


def mend_commas(c: Column) -> Column:
    """Commas before closing brackets go; missing ones between objects come."""
    return F.regexp_replace(F.regexp_replace(c, ",\\s*([\\]}])", "$1"), "\\}\\s*\\{", "},{")


def parse_items(c: Column) -> Column:
    """struct(items, code): raw, without thinking, out of its fence, commas mended, then the outermost brackets."""
    raw = F.trim(F.coalesce(c, F.lit("")))
    plain = strip_thinking(raw)
    fenced = F.trim(strip_fence(plain))
    mended = mend_commas(fenced)
    array = mend_commas(F.regexp_extract(fenced, "(?s)\\[.*\\]", 0))
    box = mend_commas(F.regexp_extract(fenced, "(?s)\\{.*\\}", 0))
    rungs = F.transform(F.array(raw, plain, fenced, mended, array, box), lambda x: _clean(_as_list(x)))
    items = F.get(F.filter(rungs, lambda x: x.isNotNull()), 0)
    none = F.array().cast("array<struct<id:string,text:string,confidence:double>>")
    code = F.when(raw == "", "empty").when(items.isNull(), "parse_error").otherwise("ok")
    return F.struct(F.coalesce(items, none).alias("items"), code.alias("code"))


def valid_batch(c: Column) -> Column:
    """Whether the text is a JSON array of objects that all have an id and a text."""
    items = F.when(F.coalesce(c, F.lit("")).rlike("^\\s*\\[.*\\]\\s*$"), F.from_json(c, LIST))
    return F.coalesce((F.size(items) > 0) & F.forall(items, lambda x: x["id"].isNotNull() & x["text"].isNotNull()), F.lit(False))


def check_coverage(items: Column, expected: Column) -> Column:
    got = F.transform(items, lambda x: x["id"])
    return F.struct(F.array_except(expected, got).alias("missing"), F.array_except(got, expected).alias("extra"))
