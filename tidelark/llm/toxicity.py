"""Toxicity by a gap-weighted subsequence kernel, Nystroem landmarks and a support vector machine.

The kernel of two words is the inner product of their subsequences of ``P`` letters, each occurrence weighted by
``LAMBDA`` to the power of the stretch it spans (at most ``SPAN`` letters), normalised to 1 for equal words; so gapped
words and words with inserted letters stay near the plain one.  A word's start counts as a letter.  Landmarks are stems
(runs of 4 to 7 letters) that mark toxic sentences by their counts in the labelled ones, in any language; words are mapped to the landmarks' whitened kernel space (Nystroem), where a linear machine with
squared hinge loss parts the toxic words from the words of clean sentences.  Its decision is a combination of
landmark kernels, hence one weight per subsequence: a word's value is a sum of table entries over its norm.  A
document is judged by the largest decisions on its words and by how many of them are how large, in a logistic decision
fitted on the labels of the sampled documents; letters set apart one by one are read as a word as well, and digits and signs
that stand for letters are read as those.

Fitting reads a bounded sample of labelled rows (``SAMPLE`` per label, smallest id hashes).  Of what occurs in it, a stem
needs 3 toxic sentences and log odds of 3; LANDMARKS stems, POSITIVES words that hold one and, of NEGATIVES other words,
the 8,000 nearest to a landmark make the machine.  All documents are scored over their whole texts.  Defined results: null or wordless text gets the score of a text without evidence; without
labels of both kinds, or without a landmark, every score is that; repeated rows get equal scores; an id with several
labels counts as toxic if one of them is; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, map_text
from .quality import Logistic

P, SPAN, LAMBDA = 3, 5, 0.6
SAMPLE, LANDMARKS, POSITIVES, NEGATIVES = 4000, 192, 3000, 80_000
#: Letters of a piece: longer words are read in overlapping pieces, so that an ending doesn't drown a stem.
LONGEST, STRIDE = 10, 3
#: Leads every word, as a letter of its own: a stem at a word's start is another than the same letters inside.
START = "^"
STEM_SIZES = (4, 5, 6, 7)
MEMO = 400_000
#: What a sentence's decision is made of: the largest decisions on its words, and the words beyond each level.
TOP, LEVELS = 12, (-0.75, -0.5, -0.25, 0.0, 0.25, 0.5)
PROFILE = tuple(range(TOP + len(LEVELS)))
#: Sharpness of the score about the machine's border.
STEEP = 4.0
A = 64
#: Sentences of each label from which on the sentences' own decision is fitted (else a text is as toxic as its worst word).
LEAST_SENTENCES = 30
_EDGE = ".,;:!?\"'()[]{}«»„“”…"
_SINGLE = re.compile(r"(?<!\w)\w(?:[\W_]{1,3}\w(?!\w)){2,}")
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i"})


def words_of(text: str) -> set[str]:
    """The distinct words of a text in lower case, letters only, spaced-out words joined, each led by START."""
    low = text.lower()
    found = set(low.split())
    out = set()
    for w in found:
        if w.isalpha():
            out.add(w)
            continue
        whole = w.strip(_EDGE)
        if whole.isalpha():
            out.add(whole)
        elif whole:
            out.update(x for x in re.split(r"[^\W\d_]*[\d_][\w]*|[^\w]+", whole) if len(x) > 2)
            joined = "".join(c for c in whole.translate(_LEET) if c.isalpha())
            if len(joined) > 2:
                out.add(joined)
    for m in _SINGLE.finditer(low):
        out.add("".join(c for c in m[0].translate(_LEET) if c.isalpha()))
    return {START + w for w in out if len(w) >= P}


def _pieces(word: str) -> list[str]:
    if len(word) <= LONGEST:
        return [word]
    return [word[i : i + LONGEST] for i in [*range(0, len(word) - LONGEST, STRIDE), len(word) - LONGEST]]


_OFFSETS = [(j, k) for j in range(1, SPAN) for k in range(j + 1, SPAN)]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, subsequence code, weight), summed per word and code, of words of at most ``LONGEST`` letters."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    letters = np.where((points >= 97) & (points <= 122), points - 96, 27 + points % (A - 27))
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(points))  # letters from here to the word's end
    keys, weights = [], []
    for j, k in _OFFSETS:
        at = np.nonzero(left > k)[0]
        keys.append(owner[at] * A**P + (letters[at] * A + letters[at + j]) * A + letters[at + k])
        weights.append(np.full(len(at), LAMBDA ** (k + 1)))
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.nonzero(np.append(True, key[1:] != key[:-1]))[0] if len(key) else np.zeros(0, np.int64)
    return key[first] // A**P, key[first] % A**P, np.add.reduceat(weight, first) if len(key) else weight


def _unit(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``subsequences``, each word's weights of norm 1."""
    owner, code, weight = subsequences(words)
    norm = np.sqrt(np.bincount(owner, weights=weight**2, minlength=len(words)))
    return owner, code, weight / norm[owner]


def kernel(a: list[str], b: list[str]) -> np.ndarray:
    """Normalised kernel matrix of two word lists."""
    oa, ca, wa = _unit(a)
    ob, cb, wb = _unit(b)
    out = np.zeros((len(a), len(b)))
    order = np.argsort(ca, kind="stable")
    oa, ca, wa = oa[order], ca[order], wa[order]
    lo, hi = np.searchsorted(ca, cb, "left"), np.searchsorted(ca, cb, "right")
    for j, w, x, y in zip(ob, wb, lo, hi):  # a landmark's subsequences; the words of ``a`` are distinct per code
        out[oa[x:y], j] += w * wa[x:y]
    return out


def _machine(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    x = np.column_stack([z, np.ones(len(z))])
    w = np.zeros(x.shape[1])
    keep = np.append(np.full(z.shape[1], ridge), 1e-4)
    loss = lambda v: 0.5 * (keep * v * v).sum() + 0.5 * (weight * np.maximum(0, 1 - y * (x @ v)) ** 2).sum()
    for _ in range(40):
        live = y * (x @ w) < 1
        xl, wl = x[live], weight[live]
        slope = keep * w - xl.T @ (wl * (y[live] - xl @ w))
        step = np.linalg.solve((xl * wl[:, None]).T @ xl + np.diag(keep), slope)
        t, now = 1.0, loss(w)
        while t > 1e-4 and loss(w - t * step) > now:
            t /= 2
        w = w - t * step
        if np.abs(t * step).max() < 1e-6:
            break
    return w


class SubsequenceSvm:
    """The collapsed decision on words, a weight per subsequence code and a bias; and the one on sentences, of its words'."""

    def __init__(self, codes: np.ndarray, values: np.ndarray, bias: float, sentence: Logistic | None = None) -> None:
        self.codes, self.values, self.bias, self.sentence = codes, values, bias, sentence
        self._table: np.ndarray | None = None
        self._memo: dict[str, float] = {}

    def __reduce__(self):
        return SubsequenceSvm, (self.codes, self.values, self.bias, self.sentence)

    def decide(self, words: list[str]) -> np.ndarray:
        if self._table is None:
            self._table = np.zeros(A**P)
            self._table[self.codes] = self.values
        owner, code, weight = subsequences(words)
        norm = np.sqrt(np.bincount(owner, weights=weight**2, minlength=len(words)))
        return np.bincount(owner, weights=weight * self._table[code], minlength=len(words)) / np.maximum(norm, 1e-12) + self.bias

    def profiles(self, texts: list[str | None]) -> np.ndarray:
        """Of each text's distinct words, the largest decisions and how many are how large (without words: the least)."""
        memo = self._memo
        if len(memo) > MEMO:
            memo.clear()
        sets = [words_of(t) if t else set() for t in texts]
        new = [w for w in set().union(*sets) if w not in memo]
        pieces = [(w, p) for w in new for p in _pieces(w) if len(p) >= P]
        for at in range(0, len(pieces), 20_000):
            part = pieces[at : at + 20_000]
            for (w, _), v in zip(part, self.decide([p for _, p in part]).tolist()):
                memo[w] = max(v, memo.get(w, -9.0))
        floor = min(self.bias, -1.0)
        out = np.full((len(texts), len(PROFILE)), floor)
        out[:, TOP:] = 0
        for i, s in enumerate(sets):
            d = np.sort(np.fromiter(map(memo.__getitem__, s), float, len(s)))[::-1]
            top = d[:TOP]
            out[i, : len(top)] = np.maximum(top, floor)
            out[i, TOP:] = [np.log1p((d > x).sum()) for x in LEVELS]
        return out

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """The largest decision over each text's words (without words: the bias alone, at most the border less one)."""
        return self.profiles(texts)[:, 0]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        found = self.profiles(texts)
        odds = STEEP * found[:, 0] if self.sentence is None else self.sentence.log_odds(found)
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def sampled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, int, int]:
    """(text, y of the sampled labelled rows), and about how many of each label those are."""
    marked = labels.filter(labels["toxic"].isNotNull() & labels["doc_id"].isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    n = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    limit = F.when(F.col("y") > 0, F.lit(min(1.0, sample / max(1, n.get(1, 0))))).otherwise(F.lit(min(1.0, sample / max(1, n.get(0, 0)))))
    chosen = marked.filter(F.xxhash64("doc_id").cast("double") <= limit * 2.0**64 - 2.0**63)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "y")  # bounded by ``sample``
    return rows, min(sample, n.get(1, 0)), min(sample, n.get(0, 0))


def word_counts(rows: DataFrame) -> DataFrame:
    """word, toxic, clean: in how many sampled documents of each label a word occurs."""

    def counted(batches):
        toxic: Counter[str] = Counter()
        clean: Counter[str] = Counter()
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                (toxic if y > 0 else clean).update(words_of(text or ""))
        words = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "toxic": pa.array([toxic[w] for w in words], pa.int64()), "clean": pa.array([clean[w] for w in words], pa.int64())})

    return rows.mapInArrow(counted, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def stems_of(counts: DataFrame, n_toxic: int, n_clean: int) -> list[tuple[str, float]]:
    """(stem, support): runs of letters that mark toxic sentences, best first, none within another of like support."""

    def cut(batches):
        for b in batches:
            toxic: Counter[str] = Counter()
            clean: Counter[str] = Counter()
            for word, t, n in zip(*(b.column(i).to_pylist() for i in range(3))):
                runs = {word[i : i + k] for k in STEM_SIZES for i in range(len(word) - k + 1)}
                for r in runs if t else ():
                    toxic[r] += t
                for r in runs if n else ():
                    clean[r] += n
            found = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_pydict({"stem": pa.array(found, pa.string()), "toxic": pa.array([toxic[r] for r in found], pa.int64()), "clean": pa.array([clean[r] for r in found], pa.int64())})

    by_run = counts.mapInArrow(cut, "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    odds = F.log(((F.col("t") + 0.5) / (n_toxic + 1)) / ((F.col("c") + 0.5) / (n_clean + 1)))
    best = by_run.filter((F.col("t") >= 3) & (odds >= 3)).orderBy(F.desc(F.col("t") * odds), F.desc(F.length("stem")), "stem").limit(4000).collect()
    kept: list[tuple[str, float]] = []
    for r in best:
        if not any((r["stem"] in k or k in r["stem"]) and r["t"] < 1.5 * t for k, t in kept):
            kept.append((r["stem"], float(r["t"])))
        if len(kept) == LANDMARKS:
            break
    return kept


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> SubsequenceSvm | None:
    """The machine, or None where the sample shows no stem that marks toxic sentences."""
    rows, n_toxic, n_clean = sampled(docs, labels, sample)
    counts = word_counts(rows).persist()
    try:
        stems = stems_of(counts, n_toxic, n_clean)
        if not stems:
            return None
        marks = "|".join(re.escape(s) for s, _ in stems)
        marked = counts.filter((F.col("toxic") > 2 * F.col("clean")) & F.col("word").rlike(marks)).orderBy(F.desc("toxic"), "word").limit(POSITIVES).toPandas()
        plain = counts.filter((F.col("clean") > 0) & ~((F.col("toxic") > 2 * F.col("clean")) & F.col("word").rlike(marks))).orderBy(F.xxhash64("word"), "word").limit(NEGATIVES).toPandas()
    finally:
        counts.unpersist()
    landmarks = [s for s, _ in stems]
    found = re.compile(marks)
    weights: dict[str, float] = {}
    for stem, t in stems:
        weights[stem] = max(weights.get(stem, 0), t**0.5)
        for i in range(2, len(stem) - 1) if len(stem) > 4 else ():  # one inserted letter
            weights.setdefault(stem[:i] + "x" + stem[i:], 0.5)
    for word, t in zip(marked["word"], marked["toxic"]):
        for p in _pieces(word):
            if found.search(p):
                weights[p] = max(weights.get(p, 0), float(t) ** 0.5)
    positive = list(weights)
    negative = list({p for w in plain["word"] for p in _pieces(w)} - weights.keys())
    negative.sort()
    gram = kernel(landmarks, landmarks)
    values, vectors = np.linalg.eigh(gram)
    live = values > 1e-6
    whiten = vectors[:, live] / np.sqrt(values[live])
    zp = kernel(positive, landmarks) @ whiten
    near = np.concatenate([kernel(negative[i : i + 5000], landmarks) for i in range(0, len(negative), 5000)]) if negative else np.zeros((0, len(landmarks)))
    hard = np.argsort(-near.max(axis=1, initial=0), kind="stable")[:8000]  # the plain words nearest to a landmark bind the border
    zn = near[hard] @ whiten
    z = np.concatenate([zp, zn])
    y = np.concatenate([np.ones(len(zp)), -np.ones(len(zn))])
    use = np.concatenate([np.array([weights[p] for p in positive]), np.full(len(zn), 4.0)])
    w = _machine(z, y, use, ridge=0.3)
    beta = whiten @ w[:-1]
    owner, code, weight = _unit(landmarks)
    codes, inverse = np.unique(code, return_inverse=True)
    machine = SubsequenceSvm(codes, np.bincount(inverse, weights=weight * beta[owner]), float(w[-1]))
    return machine.__class__(codes, machine.values, machine.bias, _sentences(rows, machine))


def _sentences(rows: DataFrame, machine: SubsequenceSvm) -> Logistic | None:
    """The decision on sentences, fitted on the labels of the sampled ones (a row of PROFILE numbers each)."""

    def profile(part: pa.RecordBatch) -> dict:
        found = machine.profiles(part.column(0).to_pylist())
        return {"y": part.column(1), **{f"f{i}": pa.array(found[:, i]) for i in PROFILE}}

    got = map_text(rows, profile, "y int, " + ", ".join(f"f{i} double" for i in PROFILE)).toPandas()
    y = (got["y"].to_numpy() > 0).astype(float)
    if y.sum() < LEAST_SENTENCES or len(y) - y.sum() < LEAST_SENTENCES:
        return None
    return Logistic(got[[f"f{i}" for i in PROFILE]].to_numpy(), y, ridge=1e-3)


def toxicity(docs: DataFrame, model: SubsequenceSvm | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score (0 to 1), predicted (1 from 0.5 on) for every row."""

    def kernel_(part: pa.RecordBatch) -> dict:
        texts = part.column(1).to_pylist()
        score = np.zeros(len(texts))
        for at in range(0, len(texts), 256):
            group = texts[at : at + 256]
            score[at : at + 256] = model.scores(group) if model else 1 / (1 + np.exp(STEEP))
        return {id_col: part.column(0), "score": pa.array(score), "predicted": pa.array((score >= 0.5).astype(np.int32))}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_text(docs.select(docs[id_col], docs[text_col].alias("text")), kernel_, f"{id_col} {kind}, score double, predicted int")


def document_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The production form: learns from the labels whose id checksum modulo 5 isn't 0."""
    held_out = crc_mod("doc_id", 5) == 0
    model = fit(docs, labels.filter(~held_out))
    return toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
