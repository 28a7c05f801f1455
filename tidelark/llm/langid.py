"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to ``ORDER`` bytes deep.  A byte costs the code length of the deepest
context that has seen it, plus the escapes on the way there (method C: the escape's count is the number of distinct
bytes the context has seen); what no context has seen costs 8 bits more.  Statistics are frozen after training, so the
trees are laid out as one hash table a depth, shared by all languages (a row a known context and byte, a column a
language), and a text's code length is a sum of its entries.  The shortest code names the language.  Nothing is dense:
all 256 byte values are symbols (A-Z count as a-z) and memory grows with the contexts that were seen.

Training reads a bounded sample: the ``PER_LANG`` rows of each language with the smallest id hashes.

Defined results: null text, or text without a letter: ``und`` with score 0; no training rows: every text is ``und``;
ties go to the language that sorts first; rows with null lang teach nothing; equal rows give equal results.
"""

from __future__ import annotations

import functools
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, crc_mod, release, slices

ORDER, PER_LANG = 3, 1500
#: Bits by which a rival code must be longer for the score to halve its odds once.
SOFTEN = 4.0
#: Bits of a byte that no context tells anything about.
BLANK = 8.0
PIECE = 1 << 20
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


_ODD = np.uint64(0x9E3779B97F4A7C15)


class Places:
    """Row numbers of distinct codes: an open table of at most half load, probed for all codes at once."""

    def __init__(self, codes: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(codes)).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.rows = np.full(1 << self.bits, -1, np.int32)
        todo, at = np.arange(len(codes)), self._slot(codes)
        while len(todo):
            free = self.rows[at] < 0
            slots, first = np.unique(at[free], return_index=True)
            put = np.nonzero(free)[0][first]
            self.keys[slots], self.rows[slots] = codes[todo[put]], todo[put]
            left = np.ones(len(todo), bool)
            left[put] = False
            todo, at = todo[left], at[left] + 1 & (1 << self.bits) - 1

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (codes.astype(np.uint64) * _ODD >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, codes: np.ndarray) -> np.ndarray:
        """The row of each code, -1 for others."""
        at = self._slot(codes)
        rows = self.rows[at]
        todo = np.nonzero((rows >= 0) & (self.keys[at] != codes))[0]
        at = at[todo]
        while len(todo):
            at = at + 1 & (1 << self.bits) - 1
            rows[todo] = self.rows[at]
            far = (rows[todo] >= 0) & (self.keys[at] != codes[todo])
            todo, at = todo[far], at[far]
        return rows


class ContextTrees:
    """Frozen code lengths in bits of every known context and byte, by depth, for all languages."""

    def __init__(self, langs: list[str], codes: np.ndarray, counts: np.ndarray, order: int = ORDER) -> None:
        """``counts``: how often each code (order + 1 bytes) occurs, a column a language."""
        self.langs, self.order = langs, order
        self.known: list[Places] = []
        self.cost: list[np.ndarray] = []  # by depth: languages x codes
        self.contexts: list[Places] = []
        self.escape: list[np.ndarray] = []  # by depth: contexts x languages
        for k in range(order + 1):
            own, inverse = np.unique(codes & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
            seen = np.zeros((len(own), len(langs)))
            np.add.at(seen, inverse, counts)
            context, of = np.unique(own >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((len(context), len(langs))), np.zeros((len(context), len(langs)))
            np.add.at(total, of, seen)
            np.add.at(kinds, of, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2(total + kinds) - np.log2(kinds), 0)
                hit = np.log2(total + kinds)[of] - np.log2(seen)
            lower = self.cost[k - 1][:, self.known[k - 1].of(own & np.uint64((1 << 8 * k) - 1))].T if k else np.full(seen.shape, 8.0)
            self.cost.append(np.where(seen > 0, hit, escape[of] + lower).T.astype(np.float32).copy())
            self.known.append(Places(own))
            self.contexts.append(Places(context))
            self.escape.append(escape.astype(np.float32))

    def _unseen(self, codes: np.ndarray, k: int) -> np.ndarray:
        """Code lengths (codes x languages) of codes that depth ``k`` doesn't know."""
        place = self.contexts[k].of(codes >> np.uint64(8))
        out = np.where(place[:, None] >= 0, self.escape[k][place], 0).astype(np.float64)
        if not k:
            return out + 8.0
        shorter = codes & np.uint64((1 << 8 * k) - 1)
        at = self.known[k - 1].of(shorter)
        out += np.where(at[:, None] >= 0, self.cost[k - 1][:, at].T, 0)
        if len(far := np.nonzero(at < 0)[0]):
            out[far] += self._unseen(shorter[far], k - 1)
        return out

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code lengths (texts x languages) of the texts data[offsets[i]:offsets[i + 1]], none of them empty."""
        codes = gram_codes(data, offsets, self.order)
        at = self.known[self.order].of(codes)
        new = np.nonzero(at < 0)[0]
        at[new] = 0
        out = np.empty((len(offsets) - 1, len(self.langs)))
        more = self._unseen(codes[new], self.order)
        owner = np.searchsorted(offsets, new, side="right") - 1
        for i, cost in enumerate(self.cost[self.order]):
            bits = np.take(cost, at)
            bits[new] = 0
            out[:, i] = np.add.reduceat(bits, offsets[:-1], dtype=np.float64) + np.bincount(owner, weights=more[:, i], minlength=len(out))
        return out


def gram_codes(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """Code of each byte with its ``order`` predecessors; texts begin as after spaces."""
    symbols = _FOLD[data]
    codes = symbols.astype(np.uint64)
    for back in range(1, order + 1):
        before = np.full_like(symbols, 32)
        before[back:] = symbols[:-back] if back < len(symbols) else 32
        for k in range(back):
            at = offsets[:-1] + k
            before[at[at < len(before)]] = 32
        codes |= before.astype(np.uint64) << np.uint64(8 * back)
    return codes


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buffer, offsets and row numbers of the non-empty texts."""
    texts = column.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, np.int64)
    _, where, body = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(where, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(body, dtype=np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    rows = np.nonzero(np.diff(offsets))[0]
    return data, np.append(offsets[:-1][rows], offsets[-1]), rows


def train(docs: DataFrame, order: int = ORDER, per_lang: int = PER_LANG, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """(name, langs, codes, counts, order) of the bounded sample, or None without training rows."""
    keyed = bounded(docs).filter(docs[lang_col].isNotNull() & docs[text_col].isNotNull()).select(docs[lang_col].alias("lang"), F.xxhash64(docs[id_col]).alias("h"), docs[text_col].alias("text"))
    rows = keyed.groupBy("lang").count().collect()  # a row a language
    if not rows:
        return None
    # the smallest hashes, by their share of the hash range: no ranking, so no language meets in one task
    share = {r["lang"]: min(1.0, per_lang / r["count"]) for r in rows}
    limit = F.element_at(F.create_map(*[F.lit(x) for k, v in share.items() for x in (k, v * 2.0**64 - 2.0**63)]), F.col("lang"))
    sample = keyed.filter(F.col("h").cast("double") <= limit)

    def counted(batches):
        for whole in batches:
            for b in slices(iter([whole]), limit=PIECE):
                for lang in set(b.column(0).to_pylist()):
                    data, offsets, rows = _bytes(b.filter(pa.compute.equal(b.column(0), lang)).column(1))
                    if len(rows):
                        codes, n = np.unique(gram_codes(data, offsets, order), return_counts=True)
                        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(codes), pa.string()), "code": pa.array(codes.view(np.int64)), "n": pa.array(n)})
        release()

    # bounded by the sample: a row a language, context and byte that occur in it
    table = sample.select("lang", "text").mapInArrow(counted, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(share)
    codes, inverse = np.unique(table["code"].to_numpy(dtype=np.int64).view(np.uint64), return_inverse=True)
    counts = np.zeros((len(codes), len(langs)), np.float32)
    np.add.at(counts, (inverse, np.searchsorted(langs, table["lang"].to_numpy(dtype=str))), table["n"].to_numpy(dtype=np.float32))
    return uuid.uuid4().hex, langs, codes, counts, order


@functools.lru_cache(maxsize=1)
def _newest() -> dict[str, ContextTrees]:
    return {}


def trees_of(model) -> ContextTrees:
    """A worker's trees of the model that it used last."""
    name, *rest = model
    held = _newest()
    if name not in held:
        held.clear()
        held[name] = ContextTrees(*rest)
    return held[name]


def _lettered(data: np.ndarray, offsets: np.ndarray, column: pa.Array, rows: np.ndarray) -> np.ndarray:
    """Whether each text has a letter."""
    fold = _FOLD[data]
    plain = np.add.reduceat(((fold >= 97) & (fold <= 122)).astype(np.int32), offsets[:-1]) > 0
    for i in np.nonzero(~plain)[0]:
        plain[i] = any(c.isalpha() for c in column[int(rows[i])].as_py())
    return plain


def identify(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, lang_pred, score, bits_per_byte and the columns ``keep`` of every row, by a trained model."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by the training sample

    def kernel(part: pa.RecordBatch) -> dict:
        trees = trees_of(shared.value) if shared.value is not None else None
        n = part.num_rows
        pred, score, rate = np.full(n, "und", dtype=object), np.zeros(n), np.zeros(n)
        column = part.column(0)
        data, offsets, rows = _bytes(column)
        if trees and len(rows):
            ok = _lettered(data, offsets, column, rows)
            bits = trees.lengths(data, offsets)
            best = bits.argmin(axis=1)
            over = bits - bits[np.arange(len(bits)), best][:, None]
            odds = 1 / np.exp2(-np.minimum(over / SOFTEN, 900)).sum(axis=1)
            pred[rows[ok]] = np.array(trees.langs, dtype=object)[best[ok]]
            score[rows[ok]] = odds[ok]
            rate[rows] = bits[np.arange(len(bits)), best] / np.diff(offsets)
        out = {c: part.column(i + 1) for i, c in enumerate([id_col, *keep])}
        return out | {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(score), "bits_per_byte": pa.array(rate)}

    types = {c: docs.schema[c].dataType.simpleString() for c in (id_col, *keep)}
    schema = ", ".join(f"`{c}` {t}" for c, t in types.items()) + ", lang_pred string, score double, bits_per_byte double"

    def run(batches):
        for part in slices(batches, limit=PIECE):
            yield pa.RecordBatch.from_pydict(kernel(part))
            release()

    return bounded(docs).select(docs[text_col].alias("text"), docs[id_col], *[docs[c] for c in keep]).mapInArrow(run, schema)


def language_ids(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte: trained on the rows whose checksum modulo 4 isn't 2."""
    held_out = crc_mod("doc_id", 4) == 2
    model = train(docs.filter(~held_out))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


def with_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language can be told, a null ``lang`` set to the one that was told.

    Texts without a letter go, and texts that the best language codes in BLANK bits a byte or more: as long as without
    any statistics.  Where no row can teach, all texts with a letter stay as they are.  Null texts go; repeated rows stay.
    """
    held_out = crc_mod("doc_id", 4) == 2
    model = train(docs.filter(~held_out))
    if model is None:
        return docs.filter(docs["text"].rlike(r"\p{L}"))
    at = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[docs[c].alias(v) for c, v in at.items()])
    named = identify(renamed, model, id_col=at["doc_id"], text_col=at["text"], keep=tuple(v for k, v in at.items() if k != "doc_id"))
    kept = named.filter((F.col("lang_pred") != "und") & (F.col("bits_per_byte") < BLANK))
    return kept.select(*[(F.coalesce(kept[v], kept["lang_pred"]) if k == "lang" else kept[v]).alias(k) for k, v in at.items()])
