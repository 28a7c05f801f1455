"""Benchmark decontamination with an FM-index per training shard.

A shard is a slice of documents.  Its words become symbols; stretches in which every word occurs in some benchmark
window are laid end to end, with a separator after each (a window can lie nowhere else), and indexed: suffix array,
Burrows-Wheeler transform, wavelet tree of the transform's symbols with rank counts per level, and suffix positions
sampled by text position.  All windows are searched backward at once; their rows are walked to the next sampled
position, which gives the words they cover; overlapping covers merge into removal spans.

The benchmark is read in chunks of at most ``CHUNK_BYTES`` of text (some 180 MB of the driver's memory while a chunk's
windows are named), one broadcast each, and the documents pass the chunks in turn; so no broadcast grows with the
benchmark.

Defined results: null or wordless texts have no words, no windows and no hits; items are told apart by id (a null id
is the empty string); repeated items and documents count as they stand; an empty benchmark leaves all clean.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded, checkpointed, release, slices
from .langid import _bytes

WINDOW = 10
CHUNK_BYTES = 2 << 20
SHARD_BYTES = 1 << 20
SAMPLE_EVERY = 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_RNG = np.random.default_rng(11)
_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(0, n - 1), base, np.uint64)]))[:n]


class Words:
    """The words of a lower-cased buffer of texts: byte starts, ends, hashes, and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data = _LOWER[data]
        on = _IS_WORD[self.data]
        before = np.append(False, on[:-1])
        before[offsets[:-1]] = False
        begins = on & ~before
        after = np.append(on[1:], False)
        after[offsets[1:] - 1] = False
        self.starts = np.nonzero(begins)[0]
        self.ends = np.nonzero(on & ~after)[0] + 1
        self.first = np.searchsorted(self.starts, offsets)  # word number at each text's start, and in all
        n = len(self.data) + 1
        with np.errstate(over="ignore"):
            sums = np.zeros(n, np.uint64)
            np.cumsum(_VALUE[self.data] * _powers(_BASE, n - 1), out=sums[1:])
            self.hashes = (sums[self.ends] - sums[self.starts]) * _powers(_BACK, n)[self.starts]

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


class Windows:
    """The windows of a chunk of benchmark items, as rows of symbols (1 and up), grouped by length."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW) -> None:
        symbols: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            raw = np.frombuffer(text.encode(), np.uint8)
            if not len(raw):
                continue
            words = Words(raw, np.array([0, len(raw)]))
            codes = [symbols.setdefault(words.word(i), len(symbols) + 1) for i in range(len(words.starts))]
            size = min(window, len(codes))
            for i in range(len(codes) - size + 1) if size else ():
                found.setdefault(tuple(codes[i : i + size]), set()).add(name)
        self.spelt = [b"", *symbols]
        raw = b" ".join(symbols)
        hashed = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])).hashes if symbols else np.zeros(0, np.uint64)
        order = np.argsort(hashed, kind="stable")
        self.hashes, self.symbols = hashed[order], (order + 1).astype(np.int32)
        keys = sorted(found, key=lambda k: (len(k), k))
        self.items = [sorted(found[k]) for k in keys]
        self.lengths = np.array([len(k) for k in keys], dtype=np.int64)
        self.codes = np.zeros((len(keys), window), dtype=np.int64)  # right-aligned
        for i, k in enumerate(keys):
            self.codes[i, window - len(k) :] = k
        self.least = int(self.lengths.min()) if keys else 0

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of words by hash (0: none has it)."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int32)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.symbols[at], 0)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of an integer text, by doubling the sorted length."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.append(0, np.diff(key[order]) != 0)) if n else 0
        rank = new
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        step *= 2


class WaveletTree:
    """Ranks of symbols in a sequence: one bit level after another, zeros before ones (a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, top: int) -> None:
        self.bits = max(1, int(top).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        level = symbols
        for b in range(self.bits - 1, -1, -1):
            bit = level >> b & 1
            self.ones.append(np.append(0, np.cumsum(bit)).astype(np.int32 if len(bit) < 1 << 31 else np.int64))
            self.zeros.append(int(len(bit) - bit.sum()))
            level = np.concatenate([level[bit == 0], level[bit == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        lo, hi = np.zeros_like(at), at
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            ones, zeros = self.ones[level], self.zeros[level]
            up = (symbols >> b & 1).astype(bool)
            l1, h1 = ones[lo], ones[hi]
            lo, hi = np.where(up, zeros + l1, lo - l1), np.where(up, zeros + h1, hi - h1)
        return hi - lo


class FmIndex:
    def __init__(self, text: np.ndarray, top: int, every: int = SAMPLE_EVERY) -> None:
        text, top = np.append(text + 1, 0), top + 1  # an end mark below all symbols
        order = suffix_array(text)
        self.n = len(text)
        self.last = text[order - 1]  # the symbol before each suffix, around the end
        self.tree = WaveletTree(self.last, top)
        self.before = np.append(0, np.cumsum(np.bincount(text, minlength=top + 1)))  # suffixes of smaller symbols
        self.sampled = order % every == 0
        self.sample = order[self.sampled].astype(np.int32 if self.n < 1 << 31 else np.int64)  # one position of ``every``
        self.nth = np.cumsum(self.sampled, dtype=np.int32 if self.n < 1 << 31 else np.int64) - 1

    def search(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [lo, hi) of the suffixes that start with each right-aligned pattern."""
        lo, hi = np.zeros(len(codes), np.int64), np.full(len(codes), self.n, np.int64)
        width = codes.shape[1]
        for step in range(width):
            live = (lengths > step) & (lo < hi)
            c = codes[live, width - 1 - step] + 1
            lo[live] = self.before[c] + self.tree.rank(c, lo[live])
            hi[live] = self.before[c] + self.tree.rank(c, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to the next sampled suffix."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        todo = np.nonzero(~self.sampled[rows])[0]
        while len(todo):
            r = rows[todo]
            c = self.last[r]
            rows[todo] = self.before[c] + self.tree.rank(c, r)
            steps[todo] += 1
            todo = todo[~self.sampled[rows[todo]]]
        return self.sample[self.nth[rows]] + steps


def find(words: Words, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(window number, word number) of every occurrence of a window in a shard."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not windows.least or not len(words.starts):
        return none
    symbols = windows.of(words.hashes)
    # stretches of known words within a text, long enough for the shortest window
    edge = np.zeros(len(symbols), bool)
    edge[words.first[:-1][words.first[:-1] < len(symbols)]] = True
    known = symbols > 0
    begin = np.nonzero(known & (edge | ~np.append(False, known[:-1])))[0]
    finish = np.nonzero(known & np.append((edge | ~known)[1:], True))[0] + 1
    long = finish - begin >= windows.least
    begin, finish = begin[long], finish[long]
    if not len(begin):
        return none
    size = finish - begin
    total = int((size + 1).sum())
    at = np.repeat(begin - np.append(0, np.cumsum(size + 1)[:-1]), size + 1) + np.arange(total)  # word numbers, separators past the end
    is_word = np.ones(total, bool)
    is_word[np.cumsum(size + 1) - 1] = False
    text = np.where(is_word, symbols[np.minimum(at, len(symbols) - 1)], 0).astype(np.int64)
    for i in np.nonzero(is_word)[0]:  # equal hashes are checked letter by letter
        if windows.spelt[text[i]] != words.word(at[i]):
            text[i] = 0
    index = FmIndex(text, len(windows.spelt))
    lo, hi = index.search(windows.codes, windows.lengths)
    hit = np.nonzero(hi > lo)[0]
    if not len(hit):
        return none
    count = hi[hit] - lo[hit]
    rows = np.repeat(lo[hit] - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(int(count.sum()))
    return np.repeat(hit, count), at[index.locate(rows)]


def _chunks(benchmark: DataFrame, id_col: str, text_col: str):
    held, size = [], 0
    for r in benchmark.select(benchmark[id_col].cast("string"), benchmark[text_col]).toLocalIterator():
        held.append((r[0] or "", r[1] or ""))
        size += len(held[-1][1]) + 64
        if size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _spans(flags: np.ndarray, words: Words, lo: int, hi: int, base: int) -> np.ndarray:
    """Byte spans of the runs of flagged words lo..hi of a text that starts at byte ``base``."""
    on = np.concatenate([[False], flags[lo:hi], [False]])
    edge = np.nonzero(on[1:] != on[:-1])[0]
    return np.column_stack([words.starts[lo + edge[::2]] - base, words.ends[lo + edge[1::2] - 1] - base]).astype(np.int64)


_EXTRA = ("_n_words", "_hits", "_items", "_spans")


def _searched(docs: DataFrame, benchmark: DataFrame, finish, schema: str, window: int, place: int, id_col: str, item_text: str) -> DataFrame:
    """``finish`` (batch of docs and the _EXTRA columns -> batch of ``schema``) of every slice, searched for all windows.

    A chunk of the benchmark is one pass; what the passes before the last found is written between them.
    """
    spark = bounded(docs).sparkSession
    own = docs.columns
    marked = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", _n_words long, _hits binary, _items array<string>, _spans array<array<long>>"

    def against(shared, first: bool, last: bool):
        def run(batches):
            for part in slices(batches, own[place], SHARD_BYTES):
                windows = shared.value if shared is not None else Windows([])
                n = part.num_rows
                column = part.column(place)
                data, offsets, rows = _bytes(column)
                n_words, hits, items, spans = np.zeros(n, np.int64), [b""] * n, [[] for _ in range(n)], [[] for _ in range(n)]
                if not first:
                    hits, items = part.column(len(own) + 1).to_pylist(), part.column(len(own) + 2).to_pylist()
                if len(rows):
                    words = Words(data, offsets)
                    n_words[rows] = np.diff(words.first)
                    number, at = find(words, windows)
                    cover = np.zeros(len(words.starts) + 1, np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + windows.lengths[number], -1)
                    flags = np.cumsum(cover)[:-1] > 0
                    doc = np.searchsorted(words.first, at, side="right") - 1
                    named: dict[int, set[str]] = {}
                    for d, w in set(zip(doc.tolist(), number.tolist())):
                        named.setdefault(d, set()).update(windows.items[w])
                    for i, row in enumerate(rows):
                        lo, hi = words.first[i], words.first[i + 1]
                        own_flags = flags[lo:hi]
                        if hits[row]:
                            own_flags = own_flags | np.unpackbits(np.frombuffer(hits[row], np.uint8), count=hi - lo).astype(bool)
                        if own_flags.any():
                            hits[row] = np.packbits(own_flags).tobytes()
                            items[row] = sorted({*items[row], *named.get(i, ())})
                            flags[lo:hi] = own_flags
                            spans[row] = _spans(flags, words, lo, hi, int(offsets[i])).tolist()
                out = [part.column(i) for i in range(len(own))]
                out += [pa.array(n_words), pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.list_(pa.int64())))]
                made = pa.RecordBatch.from_arrays(out, names=[*own, *_EXTRA])
                yield finish(made) if last else made
                del part, column, data, out, made
                words = cover = flags = None
                release()

        return run

    out, held, first = docs, None, True
    for chunk in _chunks(benchmark, id_col, item_text):
        if held is not None:
            out, first = checkpointed(out.mapInArrow(against(held, first, False), marked)), False
            held.unpersist()
        held = spark.sparkContext.broadcast(Windows(chunk, window))
    return out.mapInArrow(against(held, first, True), schema)


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", id_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with _n_words (long), _hits (packed words hit), _items (array of item ids), _spans (array of byte spans).

    Columns of those names in ``docs`` are replaced.
    """
    docs = docs.drop(*_EXTRA)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", _n_words long, _hits binary, _items array<string>, _spans array<array<long>>"
    return _searched(docs, benchmark, lambda batch: batch, schema, window, docs.columns.index(text_col), id_col, item_text)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_spans, removed_bytes."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def digest(b: pa.RecordBatch) -> pa.RecordBatch:
        hits, items, spans = b.column("_hits").to_pylist(), b.column("_items").to_pylist(), b.column("_spans").to_pylist()
        n_hit = [int(np.unpackbits(np.frombuffer(h, np.uint8)).sum()) if h else 0 for h in hits]
        return pa.RecordBatch.from_pydict({
            "doc_id": b.column("doc_id"), "n_words": b.column("_n_words"), "n_hit": pa.array(n_hit, pa.int64()),
            "n_items": pa.array([len(x) for x in items], pa.int64()),
            "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
            "contaminated": pa.array([x > 0 for x in n_hit]),
            "n_spans": pa.array([len(x) for x in spans], pa.int64()),
            "removed_bytes": pa.array([sum(e - s for s, e in x) for x in spans], pa.int64()),
        })

    schema = f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, n_spans long, removed_bytes long"
    return _searched(docs.select("doc_id", "text"), benchmark, digest, schema, WINDOW, 1, "item_id", "text")


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The columns of ``docs`` with the words of benchmark windows cut out of the text (from the first to the last of
    each run) and n_chars counted anew.  Null texts and rows without a hit stay as they are; any column name may stand.
    """
    own = docs.columns
    place = own.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, spans = batch.column(place).to_pylist(), batch.column("_spans").to_pylist()
        made = [_without(t, s) if s else t for t, s in zip(texts, spans)]
        out = [batch.column(i) for i in range(len(own))]
        out[place] = pa.array(made, pa.string())
        if "n_chars" in own:
            at = own.index("n_chars")
            out[at] = pa.array([None if t is None else len(t) for t in made], batch.schema.field(at).type)
        return pa.RecordBatch.from_arrays(out, names=own)

    renamed = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(own)])
    return _searched(renamed, benchmark, cut, schema, window, place, "item_id", "text")


def _without(text: str, spans: list[list[int]]) -> str:
    raw, at, kept = text.encode(), 0, []
    for s, e in spans:
        kept.append(raw[at:s])
        at = e
    kept.append(raw[at:])
    return b"".join(kept).decode("utf-8", "ignore")
