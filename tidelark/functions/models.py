"""The boundary to external models: segmenters, translators and embedders as Arrow functions with deterministic stubs."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import all_matches, text_or_empty

HEURISTIC = "[\\u4e00-\\u9fff]{2,}|[A-Za-z0-9._\\-+%]+"


class Translator(Protocol):
    """A batch of (id, text) to (id, text); may leave ids out, may raise."""

    def __call__(self, batch: Sequence[tuple[str, str]]) -> Sequence[tuple[str, str]]: ...


def stub_translator(batch: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    return [(i, t[::-1]) for i, t in batch]


def stub_embedder(texts: Sequence[str], width: int = 16) -> list[list[float]]:
    """Deterministic unit-range vectors from a digest; blanks are zeros."""
    return [[b / 255 for b in hashlib.sha256(t.encode()).digest()[:width]] if t.strip() else [0.0] * width for t in texts]


def segment(c: Column) -> Column:
    """The heuristic segmenter: runs of ideographs, and of letters, digits and signs."""
    return all_matches(c, HEURISTIC)


def segmenter(chain: Sequence[Callable[[str], list[str]]]):
    """A segmenter that tries implementations in order and takes the first that works."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        def one(t: str) -> list[str]:
            for f in chain:
                try:
                    return list(f(t))
                except Exception:  # noqa: BLE001 - an implementation may fail in its own way; the next one takes over
                    continue
            return []

        return texts.fillna("").map(one)

    return run


def nfkc(c: Column) -> Column:
    """Compatibility normalisation (there is no built-in)."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    return run(c)


def embed(c: Column, model: Callable[[Sequence[str]], list[list[float]]] = stub_embedder) -> Column:
    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model(texts.fillna("").tolist()))

    return run(c)


def translate(df: DataFrame, key: str, text: str, model: Translator = stub_translator, batch: int = 25, attempts: int = 3) -> DataFrame:
    """key, translated, status for every row: empties are answered at once; a failing batch is split in two, down to
    single rows, and each half is tried again; rows left out are ``missing``, rows that fail alone ``failed``.

    Calls may be repeated when a task is: the model must be safe to call twice.
    """

    def call(rows: list[tuple[str, str]], left: int) -> Iterator[tuple[str, str | None, str]]:
        try:
            got = dict(model(rows))
        except Exception:  # noqa: BLE001 - any failure of the model is answered by splitting
            if len(rows) == 1:
                if left > 1:
                    yield from call(rows, left - 1)
                else:
                    yield rows[0][0], None, "failed"
                return
            half = len(rows) // 2
            yield from call(rows[:half], left)
            yield from call(rows[half:], left)
            return
        for i, _ in rows:
            yield i, got.get(i), "ok" if i in got else "missing"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = list(zip(pdf[key].astype(str), pdf[text].fillna("")))
            out = [(i, "", "skipped_empty") for i, t in rows if not t.strip()]
            full = [r for r in rows if r[1].strip()]
            for at in range(0, len(full), batch):
                out += call(full[at : at + batch], attempts)
            yield pd.DataFrame(out, columns=[key, "translated", "status"])

    return df.select(F.col(key).cast("string").alias(key), text_or_empty(F.col(text)).alias(text)).mapInPandas(run, f"{key} string, translated string, status string")


def tag_uncertain(df: DataFrame, key: str, text: str, confidence: str, tag: str, model: Translator, least: float = 0.7) -> DataFrame:
    """Rows below a confidence get their tag from the model; all others keep theirs."""
    low = df.filter(F.col(confidence) < least)
    asked = translate(low, key, text, model).filter("status = 'ok'").select(F.col(key).alias("_k"), F.col("translated").alias("_t"))
    return df.join(asked, df[key].cast("string") == F.col("_k"), "left").withColumn(tag, F.coalesce("_t", tag)).drop("_k", "_t")


def segment_before_freeze(c: Column, placeholder: str) -> Column:
    """Words spaced apart, placeholders kept whole (each once)."""
    return F.concat_ws(" ", all_matches(c, f"{placeholder}|{HEURISTIC}|[^\\s]"))


def normalized_text(c: Column) -> Column:
    """NFKC, then spaces squeezed."""
    from .text import squeeze

    return squeeze(nfkc(c))
