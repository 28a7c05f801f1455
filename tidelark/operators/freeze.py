"""Placeholder freezing with numbers that run over the whole table.

Tags are taken first, then the other patterns on what is left, so a tag that holds a placeholder is one original and
restoring needs one pass.  Numbers follow row order, then pattern, then place; equal originals share a token.  The
plan: marks per row (JVM functions), first occurrence per distinct original (an aggregate), numbers over the distinct
originals (the only global order), and a join of each row's pieces with the map, which is never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import PATTERNS, text_or_empty

_OPEN, _CLOSE = "\ue000", "\ue001"  # private-use marks around an original
_ORDER = sorted(range(len(PATTERNS)), key=lambda i: PATTERNS[i][1] != "TAG")


def marked(c: Column) -> Column:
    """The text with every original between marks."""
    text = F.translate(text_or_empty(c), _OPEN + _CLOSE, "")
    for i in _ORDER:
        # a marked stretch is matched first and put back; the empty mark that leaves behind goes
        text = F.regexp_replace(text, f"({_OPEN}[^{_CLOSE}]*{_CLOSE})|({PATTERNS[i][2]})", f"$1{_OPEN}$2{_CLOSE}")
        text = F.replace(text, F.lit(_OPEN + _CLOSE), F.lit(""))
    return text


def token_map(df: DataFrame, text: str, order: str) -> DataFrame:
    """original, token: the mapping of all originals of the table."""
    found = F.regexp_extract_all(marked(F.col(text)), F.lit(f"{_OPEN}([^{_CLOSE}]*){_CLOSE}"), F.lit(1))
    each = df.select(F.col(order).alias("_row"), F.posexplode(found).alias("_pos", "original"))
    kind, rank = F.lit("PH"), F.lit(len(PATTERNS))
    for n, i in reversed(list(enumerate(_ORDER))):
        hit = F.col("original").rlike(f"^(?:{PATTERNS[i][2]})$")
        kind, rank = F.when(hit, PATTERNS[i][1]).otherwise(kind), F.when(hit, n).otherwise(rank)
    first = each.withColumns({"_kind": kind, "_rank": rank}).groupBy("original", "_kind").agg(F.min(F.struct("_row", "_rank", "_pos")).alias("_first"))
    n = F.row_number().over(Window.partitionBy("_kind").orderBy("_first"))
    return first.select("original", F.concat_ws("_", "_kind", n.cast("string")).alias("token"))


def freeze(df: DataFrame, text: str, order: str, out: str = "tokenized") -> tuple[DataFrame, DataFrame]:
    """(df with the tokenised text, the token map); ``order`` must be unique."""
    mapping = token_map(df, text, order)
    pieces = F.split(marked(F.col(text)), f"[{_OPEN}{_CLOSE}]")  # odd places are originals
    each = df.select(order, F.posexplode(pieces).alias("_pos", "_piece"))
    named = each.join(mapping, (each["_pos"] % 2 == 1) & (each["_piece"] == mapping["original"]), "left")
    piece = F.when(F.col("token").isNotNull(), F.concat(F.lit("⟦"), F.col("token"), F.lit("⟧"))).otherwise(F.col("_piece"))
    joined = named.groupBy(order).agg(F.array_sort(F.collect_list(F.struct("_pos", piece.alias("p")))).alias("_ps"))
    return df.join(joined.select(order, F.concat_ws("", F.transform("_ps", lambda x: x["p"])).alias(out)), order), mapping
