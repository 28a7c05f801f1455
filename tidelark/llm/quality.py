"""Quality by hierarchical empirical Bayes.

A logistic classifier on form features (shares of upper case, digits, marks, repeated lines, word length and so on)
gives every document its evidence.  Sites are hosts and, below them, paths; each level's rate of good documents is a
posterior mean of the level above: a path shrinks toward its host, a host toward the global rate, by a concentration
that grouped aggregation fits by moments, so sparse sites lean on their priors.  A document's log odds are its own
evidence plus the log odds of its path's other documents relative to the global ones.

The classifier is fitted on a bounded sample of labelled rows (``SAMPLE``, smallest id hashes); site statistics cover
all documents.  A source that parses as a URL gives host and first path part; any other source is a host whose paths
are its languages.

Defined results: null text counts as empty, null source and lang as empty site names; without labels of both kinds
the evidence is neutral (0.5) and every document is kept; repeated rows count as often as they stand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, crc_mod, map_text
from .langid import _bytes

SAMPLE = 8000
#: Limits of a fitted concentration (pseudo-documents).
LEAST, MOST = 2.0, 1000.0
THRESHOLD = 0.5
_UPPER, _LOWER, _DIGIT, _SPACE, _LINE, _HIGH, _MARK = range(7)


def _classes() -> np.ndarray:
    kind = np.full(256, _MARK, dtype=np.uint8)
    for b in range(256):
        c = chr(b)
        if b >= 128:
            kind[b] = _HIGH
        elif c.isupper():
            kind[b] = _UPPER
        elif c.islower():
            kind[b] = _LOWER
        elif c.isdigit():
            kind[b] = _DIGIT
        elif c == "\n":
            kind[b] = _LINE
        elif c.isspace():
            kind[b] = _SPACE
    return kind


_CLASS = _classes()
_VALUE = np.random.default_rng(7).integers(1, 1 << 50, 256)
FEATURES = ("upper", "digit", "space", "line", "high", "mark", "mark_pairs", "word_len", "log_len", "same_pairs", "echo_words", "mark_words")


def features(column: pa.Array) -> np.ndarray:
    """One row of form features per text (an empty text: zeros)."""
    out = np.zeros((len(column), len(FEATURES)), dtype=np.float64)
    data, offsets, rows = _bytes(column)
    if not len(rows):
        return out
    kind, at, size = _CLASS[data], offsets[:-1], np.diff(offsets).astype(np.float64)
    share = lambda flags: np.add.reduceat(flags.astype(np.int32), at) / size
    nxt = np.append(data[1:], np.uint8(0))
    nxt_kind = np.append(kind[1:], np.uint8(_LOWER))
    gap = np.add.reduceat(((kind == _SPACE) | (kind == _LINE)).astype(np.int32), at)
    blank = (kind == _SPACE) | (kind == _LINE)
    first = ~blank & np.append(True, blank[:-1])
    first[at] = ~blank[at]
    starts = np.nonzero(first)[0]
    owner = np.searchsorted(at, starts, side="right") - 1
    words = np.maximum(np.bincount(owner, minlength=len(at)), 1)
    # a word's sum of random byte values: equal for equal words, hardly ever for others
    sums = np.add.reduceat(np.where(blank, 0, _VALUE[data]), starts) if len(starts) else np.zeros(0)
    solid = np.add.reduceat((kind <= _DIGIT).astype(np.int32) + (kind == _HIGH), starts) if len(starts) else np.zeros(0)
    echo = np.append(False, (sums[1:] == sums[:-1]) & (owner[1:] == owner[:-1])) if len(starts) else np.zeros(0, bool)
    out[rows] = np.column_stack([
        *(share(kind == k) for k in (_UPPER, _DIGIT, _SPACE, _LINE, _HIGH, _MARK)),
        share((kind == _MARK) & (nxt_kind == _MARK)),
        np.log1p(size / (gap + 1)),
        np.log1p(size),
        share((data == nxt) & (kind != _SPACE)),
        np.bincount(owner, weights=echo, minlength=len(at)) / words,
        np.bincount(owner, weights=solid == 0, minlength=len(at)) / words,
    ])
    return out


class Logistic:
    """Ridge-penalised logistic regression on standardised features, by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> None:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        w = np.zeros(z.shape[1])
        penalty = np.append(np.full(x.shape[1], ridge * len(x)), 1e-6)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            slope = z.T @ (p - y) + penalty * w
            curve = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(curve, slope)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        self.w = w

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale @ self.w[:-1] + self.w[-1], -12, 12)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Logistic | None:
    """The classifier, from at most about ``sample`` labelled rows (an id with several labels takes the least)."""
    chosen = labels.filter(labels[label].isNotNull() & labels["doc_id"].isNotNull()).groupBy("doc_id").agg(F.min(label).alias("y"))
    n = chosen.count()
    if n > sample:
        chosen = chosen.filter(F.xxhash64("doc_id").cast("double") <= sample / n * 2.0**64 - 2.0**63)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by ``sample``

    def kernel(part: pa.RecordBatch) -> dict:
        x = features(part.column(0))
        return {"y": part.column(1), **{f: pa.array(x[:, i]) for i, f in enumerate(FEATURES)}}

    got = map_text(rows.select("text", F.col("y").cast("int")), kernel, "y int, " + ", ".join(f"{f} double" for f in FEATURES)).toPandas()
    y = (got["y"].to_numpy() > 0).astype(float) if len(got) else np.zeros(0)
    if not len(y) or y.min() == y.max():
        return None
    return Logistic(got[list(FEATURES)].to_numpy(), y)


def site(source: F.Column, lang: F.Column) -> tuple[F.Column, F.Column]:
    """(host, path) of a source."""
    source = F.coalesce(source, F.lit(""))
    host = F.regexp_extract(source, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    first = F.regexp_extract(source, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)", 1)
    return F.when(host != "", F.lower(host)).otherwise(source), F.when(host != "", first).otherwise(F.coalesce(lang, F.lit("")))


def _concentration(rate: F.Column, n: F.Column, parent: F.Column) -> F.Column:
    """Moments: the sites' spread beyond what counting alone gives, as pseudo-documents."""
    counting = F.sum(parent * (1 - parent))
    spread = F.greatest(F.sum(n * (rate - parent) * (rate - parent)) - counting, F.lit(1e-9))
    weight = F.greatest(F.sum(n) - F.sum(n * n) / F.sum(n), F.lit(1e-9))
    between = spread / weight
    return F.least(F.lit(MOST), F.greatest(F.lit(LEAST), F.coalesce(F.avg(parent * (1 - parent)) / between - 1, F.lit(MOST))))


def quality(docs: DataFrame, model: Logistic | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, host, path, evidence, host_rate, path_rate, score, keep for every document."""

    def kernel(part: pa.RecordBatch) -> dict:
        odds = model.log_odds(features(part.column(0))) if model else np.zeros(part.num_rows)
        return {"doc_id": part.column(1), "host": part.column(2), "path": part.column(3), "odds": pa.array(odds)}

    host, path = site(docs["source"].cast("string"), docs["lang"].cast("string"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_text(docs.select(docs["text"], docs["doc_id"], host.alias("host"), path.alias("path")), kernel, f"doc_id {kind}, host string, path string, odds double")
    scored = checkpointed(scored)  # read twice: by the site sums and by the join with them
    p = 1 / (1 + F.exp(-F.col("odds")))
    paths = scored.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), F.sum(p).alias("s"))
    paths = checkpointed(paths)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    whole = hosts.agg((F.sum("hs") / F.sum("hn")).alias("mu"), F.sum("hn").alias("all_n"))
    mu = (whole.first() or [None])[0]
    mu = min(max(mu if mu is not None else 0.5, 1e-4), 1 - 1e-4)
    k_host = hosts.agg(_concentration(F.col("hs") / F.col("hn"), F.col("hn"), F.lit(mu))).first()[0] or MOST
    hosts = hosts.withColumn("host_rate", (F.col("hs") + k_host * mu) / (F.col("hn") + k_host))
    below = paths.join(hosts.select("host", "host_rate"), "host")
    k_path = below.agg(_concentration(F.col("s") / F.col("n"), F.col("n"), F.col("host_rate"))).first()[0] or MOST
    logit = lambda x: F.log(x / (1 - x))
    out = scored.join(paths.join(hosts.select("host", "hn", "hs"), "host"), ["host", "path"]).withColumn("evidence", p)
    # the rates are those of a document's neighbours: its own evidence counts once, on its own
    out = out.withColumn("host_rate", (F.col("hs") - F.col("evidence") + k_host * mu) / (F.col("hn") - 1 + k_host))
    out = out.withColumn("path_rate", (F.col("s") - F.col("evidence") + k_path * F.col("host_rate")) / (F.col("n") - 1 + k_path))
    odds = F.col("odds") + logit(F.least(F.greatest("path_rate", F.lit(1e-6)), F.lit(1 - 1e-6))) - float(np.log(mu / (1 - mu)))
    score = 1 / (1 + F.exp(-odds))
    return out.select("doc_id", "host", "path", "evidence", "host_rate", "path_rate", score.alias("score"), (score >= threshold).alias("keep"))


def document_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The production form: fitted on the labelled rows whose id checksum modulo 5 isn't 0."""
    return quality(docs, fit(docs, labels.filter(crc_mod("doc_id", 5) != 0)))
