"""Token, cost and hash functions."""

from __future__ import annotations

import hashlib
import json
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def tolerant_int(c: Column, default: int = 0) -> Column:
    return F.coalesce(F.floor(c.try_cast("double")).try_cast("int"), F.lit(default))


def truthy(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c.cast("string"), F.lit("")))).isin("1", "true", "yes", "y")


def estimate_tokens(c: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(F.coalesce(c, F.lit(""))) / 4)).cast("int")


def row_tokens(*columns: Column, overhead: int = 20) -> Column:
    return sum((estimate_tokens(c) for c in columns), F.lit(overhead))


def tokens_from_chars(chars: Column) -> Column:
    return F.when(F.coalesce(chars, F.lit(0)) <= 0, 0).otherwise(F.greatest(F.lit(1), F.ceil(chars / 4))).cast("long")


def usage(nested: Column, flat_prompt: Column, flat_completion: Column, req_chars: Column, resp_chars: Column) -> Column:
    """Token usage by precedence: nested counts, flat counts, estimates from characters, zero."""
    make = lambda p, c, e: F.struct(p.cast("long").alias("prompt"), c.cast("long").alias("completion"), F.lit(e).alias("estimated"))
    zero = F.lit(0)
    return (
        F.when(nested.isNotNull(), make(F.coalesce(nested["prompt_tokens"], zero), F.coalesce(nested["completion_tokens"], zero), False))
        .when(flat_prompt.isNotNull() | flat_completion.isNotNull(), make(F.coalesce(flat_prompt, zero), F.coalesce(flat_completion, zero), False))
        .when(req_chars.isNotNull() | resp_chars.isNotNull(), make(tokens_from_chars(req_chars), tokens_from_chars(resp_chars), True))
        .otherwise(make(zero, zero, False))
    )


def cost_per_million(prompt: Column, completion: Column, rate_in: Column, rate_out: Column) -> Column:
    return prompt * rate_in / 1e6 + completion * rate_out / 1e6


def cost_by_multiplier(prompt: Column, completion: Column, conversion: Column, group: Column, prompt_mult: Column, completion_mult: Column) -> Column:
    return F.round(conversion * group * prompt_mult * (prompt + completion * completion_mult) / 500000, 6)


def hash_order(c: Column, seed: int | str = "") -> Column:
    """A stable order key: fixed-width hex sorts like the number."""
    return F.md5(F.concat(F.coalesce(c.cast("string"), F.lit("")), F.lit(str(seed))).cast("binary"))


def fingerprint10(c: Column) -> Column:
    return F.substring(F.md5(c.cast("binary")), 1, 10)


def ids_digest(ids: Column) -> Column:
    """sha256 over the sorted ids, each followed by a newline (an aggregate)."""
    return F.sha2(F.concat_ws("", F.transform(F.array_sort(F.collect_list(ids.cast("string"))), lambda x: F.concat(x, F.lit("\n")))).cast("binary"), 256)


def canonical_digest(payload: object, size: int = 64) -> str:
    return hashlib.sha256(json.dumps(payload, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()[:size]


def next_version(previous: str | None, today: date) -> str:
    """YYYY.MM.DD.N, N counting within a day."""
    day = f"{today:%Y.%m.%d}"
    if previous and previous.startswith(day + "."):
        tail = previous.rsplit(".", 1)[1]
        return f"{day}.{int(tail) + 1 if tail.isdigit() else 1}"
    return f"{day}.1"
