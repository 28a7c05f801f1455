"""Removal of passages that repeat across documents, with suffix arrays per shard.

A byte goes if a string of ``LEAST`` bytes that covers it also starts in a document with a smaller id.  The work is
dealt in packed arrays, one row per pair of tasks, in one chain of stages:

1. Every string of LEAST bytes picks the least-hashed of its K-byte grams.  Equal strings pick equal grams, so all
   copies of a string meet in the bucket of the gram's hash.  A run of strings with one gram is a *context*.
   Equal contexts are combined (within a slice first): only the least document's goes on, the others' bytes go.
   Grams that a sample of the documents shows to be frequent never meet: their strings are dealt one by one.
2. Different contexts of one gram can share a string only if they agree on ``SIDE`` bytes left or right of the gram; those
   are fetched from their documents and dealt to shards by gram.
3. A shard lays its contexts end to end and sorts their suffixes by induced sorting; permuted common prefixes of LEAST
   or more join equal strings, and each join's least document keeps them.
4. The spans of all stages meet their documents and are cut.

Of the grams that do meet, one with more than ``HOT`` contexts to compare is dealt string by string too, so that no
gram fills a task.  Bucket numbers grow with the bytes of the table, so a bucket's memory does not.  The sample of
frequent grams only routes: what it misses meets by gram, with the same result.

Contexts are equal if the hashes of gram (32 bits in its bucket), whole (48 bits, of another base) and both sides
(15 bits each) are; strings dealt one by one if 128 bits of two bases are.  Rows are named by id and text (64 bits) together with the id.

Defined results: null text counts as empty; texts shorter than LEAST lose nothing; documents of equal id never take
bytes from each other; a null id counts as the largest long, so rows of null id and of that id take nothing from each
other; repeated rows get equal results; matches are of bytes, so a cut may split a character (``deduplicated`` drops
what is left of it); a long text is read in pieces of SLICE bytes and may have up to 2^31 - 1 bytes.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, checkpointed, release, slices
from .langid import _bytes
from .suffixes import permuted_lcp, suffix_array

LEAST, K = 50, 12
SIDE = (LEAST - K) // 2
HOT = 1000
#: Hot contexts whose strings are hashed at a time.
HOT_CONTEXTS = 8192
BUCKET_BYTES, SLICE = 8 << 20, 1 << 20
#: Suffix-array shards per bucket: sorting needs some sixty bytes per letter.
SHARDS = 4
_POS = 28  # bits of a position in a slice
_RECORD = np.dtype([("key", "<u4"), ("ch", "<u4"), ("cl", "<u2"), ("left", "<u2"), ("right", "<u2"), ("doc", "<u2"), ("at", "<i4"), ("n", "u1")])
_SPAN = np.dtype([("rid", "<i8"), ("doc", "<i8"), ("s", "<i4"), ("e", "<i4")])
_REP = np.dtype([("rid", "<i8"), ("doc", "<i8"), ("key", "<u8"), ("at", "<i4"), ("n", "u1"), ("hot", "u1")])
_CONTEXT = np.dtype([("doc", "<i8"), ("rid", "<i8"), ("key", "<u8"), ("at", "<i4"), ("n", "u1")])
_STRING = np.dtype([("hash", "<u8"), ("more", "<u8"), ("doc", "<i8"), ("rid", "<i8"), ("at", "<i4")])
_ROWS = "dest int, kind int, load binary"
SPANS, CONTEXTS, STRINGS = 0, 1, 2
#: A gram is frequent if the sample (documents in ``SAMPLE_OF``) has it ``SEEN`` times and it has a millionth of its contexts.
SAMPLE_OF, SEEN, SHARE = 256, 32, 1_000_000
_VALUE = np.random.default_rng(23).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE, _BASE2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA24BAED4963EE407)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Powers kept by a worker; longer tables are made for the one buffer that needs them.
_KEPT = SLICE + (SLICE >> 1)


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse."""
    got = _POWERS.get(int(base))
    if got is None or len(got[0]) < n:
        size = max(n, min(_KEPT, 2 * n))
        both = (base, np.uint64(pow(int(base), -1, 1 << 64)))
        with np.errstate(over="ignore"):
            got = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in both)
        if size <= _KEPT:
            _POWERS[int(base)] = got
    return got[0][:n], got[1][:n]


class _Hashes:
    """Hashes of any ranges of a buffer, from running sums."""

    def __init__(self, data: np.ndarray, base: np.uint64 = _BASE) -> None:
        powers, self.back = _powers(base, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            made = _VALUE[data]
            made *= powers[:-1]
            np.cumsum(made, out=self.sums[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed((self.sums[hi] - self.sums[lo]) * self.back[lo])


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ x >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(32)


def _hash_long(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """XXH64 of 8 bytes, as the SQL function xxhash64 chains it over longs."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, r: x << np.uint64(r) | x >> np.uint64(64 - r)
    with np.errstate(over="ignore"):
        h = seed + p5 + np.uint64(8)
        h = turn(h ^ turn(value.view(np.uint64) * p2, 31) * p1, 27) * p1 + p4
        h = (h ^ h >> np.uint64(33)) * p2
        h = (h ^ h >> np.uint64(29)) * p3
        return h ^ h >> np.uint64(32)


def row_ids(doc: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The SQL column xxhash64(doc, crc): a row's name by id and text."""
    return _hash_long(crc.astype(np.int64), _hash_long(np.ascontiguousarray(doc, dtype=np.int64), np.uint64(42))).view(np.int64)


def contexts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(records, gram hashes) of the texts data[offsets[i]:offsets[i + 1]]; record ``doc`` is i."""
    n = len(data)
    if n < LEAST or np.diff(offsets).max() < LEAST:
        return np.zeros(0, _RECORD), np.zeros(0, np.uint64)
    hashes, others = _Hashes(data), _Hashes(data, _BASE2)
    with np.errstate(over="ignore"):
        grams = _mixed((hashes.sums[K:] - hashes.sums[:-K]) * hashes.back[: n - K + 1])
    mask = np.uint64((1 << _POS) - 1)
    low = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= LEAST - K + 1:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if rest := LEAST - K + 1 - width:
        low = np.minimum(low[:-rest], low[rest:])
    starts = np.nonzero(np.arange(n - LEAST + 1) + LEAST <= np.repeat(offsets[1:], np.diff(offsets))[: n - LEAST + 1])[0]
    gram_at = (low[starts] & mask).astype(np.int64)
    first = np.nonzero(np.append(True, (gram_at[1:] != gram_at[:-1]) | (starts[1:] != starts[:-1] + 1)))[0]
    lo, at = starts[first], gram_at[first]
    count = np.diff(np.append(first, len(starts)))
    end = lo + count - 1 + LEAST
    key = grams[at]
    with np.errstate(over="ignore"):
        whole = _mixed(others.of(lo, end) + (at - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + count.astype(np.uint64))
    left = np.where(at - SIDE >= lo, hashes.of(np.maximum(at - SIDE, 0), at + K) >> np.uint64(48) | np.uint64(1), 0)
    right = np.where(at + K + SIDE <= end, hashes.of(at, np.minimum(at + K + SIDE, n)) >> np.uint64(48) | np.uint64(1), 0)
    out = np.zeros(len(lo), _RECORD)
    out["key"] = key >> np.uint64(32)
    out["ch"], out["cl"] = whole >> np.uint64(32), whole >> np.uint64(16) & np.uint64(0xFFFF)
    out["left"], out["right"], out["n"] = left, right, count
    owner = np.searchsorted(offsets, lo, side="right") - 1
    out["doc"], out["at"] = owner, lo - offsets[owner]
    return out, key


def _least(order_keys: tuple[np.ndarray, ...], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, class starts in it, the least doc of each row's class in order) of rows classed by ``order_keys``."""
    order = np.lexsort((doc, *reversed(order_keys)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in order_keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    first = np.nonzero(new)[0]
    return order, first, np.repeat(doc[order][first], np.diff(np.append(first, len(order))))


def _spans(rid: np.ndarray, doc: np.ndarray, s: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rid), _SPAN)
    out["rid"], out["doc"], out["s"], out["e"] = rid, doc, s, s + n - 1 + LEAST
    return out


def _equals(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What equal contexts of one gram share: the whole's hash, and its rest with both sides'."""
    rest = records["cl"].astype(np.uint64) << np.uint64(48) | records["left"].astype(np.uint64) << np.uint64(32) | records["right"].astype(np.uint64) << np.uint64(16) | records["n"]
    return records["ch"], rest


def _merged(spans: np.ndarray) -> np.ndarray:
    """The union of spans, sorted."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["s"], spans["doc"], spans["rid"]))]
    new = np.append(True, (spans["rid"][1:] != spans["rid"][:-1]) | (spans["doc"][1:] != spans["doc"][:-1]))
    group = np.cumsum(new).astype(np.int64)
    reach = np.maximum.accumulate(group << 32 | spans["e"]) & 0xFFFFFFFF
    new[1:] |= spans["s"][1:] > reach[:-1]
    first = np.nonzero(new)[0]
    out = spans[first].copy()
    out["e"] = reach[np.append(first[1:], len(spans)) - 1]
    return out


def _split(array: np.ndarray, dest: np.ndarray, kind: int, more: Callable[[np.ndarray], tuple] | None = None) -> list[tuple[int, int, bytes]]:
    """One packed row per destination."""
    order = np.argsort(dest, kind="stable")
    at = dest[order]
    first = np.nonzero(np.append(True, at[1:] != at[:-1]))[0] if len(at) else []
    out = []
    for i, j in zip(first, [*first[1:], len(at)]):
        rows = order[i:j]
        out.append((int(at[i]), kind, pickle.dumps(more(rows) if more else array[rows], protocol=5)))
    return out


def _grouped(f: Callable) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        out = f(table)
        release()
        return out

    return run


def _cogrouped(f: Callable) -> Callable:
    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        out = f(docs, table)
        release()
        return out

    return run


def _table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    d, k, x = zip(*rows) if rows else ((), (), ())
    return pa.table({"dest": pa.array(d, pa.int32()), "kind": pa.array(k, pa.int32()), "load": pa.array(x, pa.binary())})


def _loads(table: pa.Table, kind: int) -> list:
    return [pickle.loads(x) for k, x in zip(table["kind"].to_pylist(), table["load"].to_pylist()) if k == kind]


def _joined(parts: list[np.ndarray], dtype: np.dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


_FIELDS = ("n", "key", "ch", "cl", "left", "right")


def _narrow(x: np.ndarray) -> np.ndarray:
    """Numbers from 0 in the least type that holds them."""
    return x.astype(np.min_scalar_type(x.max())) if len(x) else x


def _packed(records: np.ndarray, doc: np.ndarray, crc: np.ndarray) -> tuple:
    """Records column by column, with the ids and checksums of their documents, in few bytes (for a shuffle)."""
    used, inverse = np.unique(records["doc"], return_inverse=True)
    ids = doc[used]
    columns = (_narrow(np.diff(inverse, prepend=0)), _narrow(records["at"]), *(np.ascontiguousarray(records[f]) for f in _FIELDS))
    return int(ids.min()), _narrow((ids - ids.min()).view(np.uint64)), crc[used].astype(np.uint32), columns


def _unpacked(least: int, ids: np.ndarray, crc: np.ndarray, columns: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(records, and the document and row name of each)."""
    out = np.zeros(len(columns[0]), _RECORD)
    out["at"] = columns[1]
    for f, c in zip(_FIELDS, columns[2:]):
        out[f] = c
    at = np.cumsum(columns[0], dtype=np.int64)
    doc = ids.astype(np.uint64).view(np.int64) + np.int64(least)
    return out, doc[at], row_ids(doc, crc)[at]


def _pieces(part: pa.RecordBatch):
    """(data, offsets, rows, base) of a slice's texts, the long ones in pieces that overlap by LEAST - 1 bytes."""
    data, offsets, rows = _bytes(part.column(0))
    size = np.diff(offsets)
    long = np.nonzero(size > SLICE)[0]
    if not len(long):
        yield data, offsets, rows, 0
        return
    for i in long.tolist():
        text = data[offsets[i] : offsets[i + 1]]
        for at in range(0, len(text), SLICE):
            piece = text[at : at + SLICE + LEAST - 1]
            yield piece, np.array([0, len(piece)]), rows[i : i + 1], at
    short = np.nonzero(size <= SLICE)[0]
    if len(short):
        yield data[_ranges(offsets[:-1][short], size[short])], np.append(0, np.cumsum(size[short])), rows[short], 0


def _cuts(batches):
    """Slices of documents whose row numbers fit a record."""
    for part in slices(batches, limit=SLICE):
        for at in range(0, part.num_rows, 60_000):
            yield part.slice(at, 60_000)


def frequent_grams(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the grams whose contexts are many, from a sample of the documents; SHARE of them at most."""

    def count(batches):
        for cut in _cuts(batches):
            for data, offsets, rows, _ in _pieces(cut):
                _, key = contexts(data, offsets) if len(rows) else (None, np.zeros(0, np.uint64))
                key, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_pydict({"key": pa.array(key.view(np.int64)), "n": pa.array(n)})
            release()

    sampled = docs.filter(F.pmod(F.xxhash64("doc"), F.lit(SAMPLE_OF)) == 0).select("text")
    found = checkpointed(sampled.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")))
    total = found.agg(F.sum("n")).first()[0] or 0
    rows = found.filter(F.col("n") >= max(SEEN, total / SHARE)).select("key").toPandas()  # at most SHARE rows
    return np.sort(rows["key"].to_numpy(dtype=np.int64).view(np.uint64))


def _dealt_strings(data: np.ndarray, starts: np.ndarray, n: np.ndarray, doc: np.ndarray, rid: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The strings of contexts that begin at ``starts`` of ``data`` and at ``at`` of their texts."""
    where = _ranges(starts, n)
    out = np.zeros(len(where), _STRING)
    out["hash"], out["more"] = (_Hashes(data, b).of(where, where + LEAST) for b in (_BASE, _BASE2))
    out["doc"], out["rid"], out["at"] = np.repeat(doc, n), np.repeat(rid, n), _ranges(at, n)
    return out


def _deal(buckets: int, frequent):
    """Stage 1, on slices of documents: records to gram buckets, strings of frequent grams to string buckets."""

    def run(batches):
        often = frequent.value
        for cut in _cuts(batches):
            for data, offsets, rows, base in _pieces(cut):
                records, key = contexts(data, offsets) if len(rows) else (np.zeros(0, _RECORD), np.zeros(0, np.uint64))
                if not len(records):
                    continue
                doc, crc = cut.column(1).to_numpy()[rows], cut.column(2).to_numpy()[rows]
                rid = row_ids(doc, crc)
                out, spans = [], []
                if len(often):
                    hot = often[np.minimum(np.searchsorted(often, key), len(often) - 1)] == key
                    if hot.any():
                        r = records[hot]
                        d = r["doc"]
                        strings = _dealt_strings(data, offsets[d] + r["at"], r["n"].astype(np.int64), doc[d], rid[d], r["at"].astype(np.int64) + base)
                        gone, kept = _strings(strings)
                        spans.append(gone)
                        out += _split(kept, (kept["hash"] % np.uint64(buckets)).astype(np.int64), STRINGS)
                        records, key = records[~hot], key[~hot]
                records["at"] += base
                mine = doc[records["doc"]]
                order, _, least = _least((key, *_equals(records)), mine)
                gone = order[mine[order] > least]
                kept = order[mine[order] == least]
                spans.append(_spans(rid[records["doc"][gone]], mine[gone], records["at"][gone], records["n"][gone].astype(np.int64)))
                merged = _merged(np.concatenate(spans))
                out += _split(merged, np.full(len(merged), int(rid[0]) % buckets), SPANS)

                # kept in the order of the texts, so that a document's records stay together
                kept.sort()
                records, key = records[kept], key[kept]
                out += _split(records, (key % np.uint64(buckets)).astype(np.int64), CONTEXTS, lambda i, r=records, d=doc, c=crc: _packed(r[i], d, c))
                yield from _table(out).to_batches()
            release()

    return run


def _meet(buckets: int, most: int):
    """Stage 2, on a gram bucket: spans of equal contexts, and the contexts that must be compared."""

    def run(table: pa.Table) -> pa.Table:
        spans, loads = _loads(table, SPANS), _loads(table, CONTEXTS)
        out = []
        if strings := _loads(table, STRINGS):
            spans.append(_strings(np.concatenate(strings))[0])
            del strings
        if loads:
            records, doc, rid = (np.concatenate(x) for x in zip(*(_unpacked(*x) for x in loads)))
            del loads
            key = records["key"].astype(np.uint64)
            order, first, least = _least((key, *_equals(records)), doc)
            gone = order[doc[order] > least]
            spans.append(_spans(rid[gone], doc[gone], records["at"][gone], records["n"][gone].astype(np.int64)))
            # classes that share their gram and a side with another class
            head = order[first]
            shares = np.zeros(len(head), bool)
            for side in ("left", "right"):
                tag = key[head] << np.uint64(16) | records[side][head]
                _, inverse, count = np.unique(tag, return_inverse=True, return_counts=True)
                shares |= (count[inverse] > 1) & (records[side][head] > 0)
            _, inverse = np.unique(key[head], return_inverse=True)
            hot = np.bincount(inverse, weights=shares)[inverse] > most if len(head) else shares
            size = np.diff(np.append(first, len(order)))
            use = np.repeat(shares, size) & (doc[order] == least)
            rows = order[use]
            reps = np.zeros(len(rows), _REP)
            reps["rid"], reps["doc"], reps["key"], reps["at"], reps["n"] = rid[rows], doc[rows], key[rows], records["at"][rows], records["n"][rows]
            reps["hot"] = np.repeat(hot, size)[use]
            out += _split(reps, reps["rid"] % buckets, CONTEXTS)
        spans = _merged(_joined(spans, _SPAN))
        return _table(out + _split(spans, spans["rid"] % buckets, SPANS))

    return run


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start..start + size - 1 of all ranges, end to end."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def _fetch(shards: int):
    """Stage 3a, on a bucket of documents: the contexts' bytes, dealt to shards by gram (or string by string)."""

    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        reps = _joined(_loads(table, CONTEXTS), _REP)
        spans = _loads(table, SPANS)
        out = []
        if len(reps) and docs.num_rows:
            data, offsets, rows = _bytes(docs["text"].combine_chunks())
            own = _owners(docs["rid"].to_numpy()[rows], docs["doc"].to_numpy()[rows], reps)
            start, size = offsets[:-1][own] + reps["at"], reps["n"].astype(np.int64) - 1 + LEAST
            hot = np.nonzero(reps["hot"] > 0)[0]
            strings = []
            for i in range(0, len(hot), HOT_CONTEXTS):
                part = hot[i : i + HOT_CONTEXTS]
                bodies = data[_ranges(start[part], size[part])]
                begin, r = np.cumsum(size[part]) - size[part], reps[part]
                strings.append(_dealt_strings(bodies, begin, r["n"].astype(np.int64), r["doc"], r["rid"], r["at"].astype(np.int64)))
            if strings:
                gone, kept = _strings(np.concatenate(strings))
                spans.append(gone)
                out += _split(kept, (kept["hash"] % np.uint64(shards)).astype(np.int64), STRINGS)
            cool = np.nonzero(reps["hot"] == 0)[0]
            made = np.zeros(len(cool), _CONTEXT)
            for f in ("rid", "doc", "key", "at", "n"):
                made[f] = reps[f][cool]
            begin, length = start[cool], size[cool]
            out += _split(made, (made["key"] % np.uint64(shards)).astype(np.int64), CONTEXTS, lambda i: (made[i], data[_ranges(begin[i], length[i])].tobytes()))
        spans = _merged(_joined(spans, _SPAN))
        return _table(out + _split(spans, np.full(len(spans), table["dest"][0].as_py() if table.num_rows else 0), SPANS))

    return run


def _owners(rid: np.ndarray, doc: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The row that each of ``wanted`` (rid, doc) names."""
    by = np.lexsort((doc, rid))
    rid, doc = rid[by], doc[by]
    at = np.searchsorted(rid, wanted["rid"])
    while len(other := np.nonzero(doc[at] != wanted["doc"])[0]):  # rows of one name and unlike ids
        at[other] += 1
    return by[at]


def _strings(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the strings that a smaller document has, and the rows of the least documents."""
    order, _, least = _least((strings["hash"], strings["more"]), strings["doc"])
    gone = strings[order[strings["doc"][order] > least]]
    return _spans(gone["rid"], gone["doc"], gone["at"], np.ones(len(gone), np.int64)), strings[order[strings["doc"][order] == least]]


def shard_spans(rows: np.ndarray, body: bytes) -> np.ndarray:
    """Spans to remove among a shard's contexts (laid end to end in ``body``), by suffix array and common prefixes."""
    if not len(rows):
        return np.zeros(0, _SPAN)
    n = rows["n"].astype(np.int64)
    size = n - 1 + LEAST
    starts = np.cumsum(size + 1) - (size + 1)
    text = np.ones(int((size + 1).sum()) + 1, np.int32)  # 1: separator
    text[-1] = 0
    text[_ranges(starts, size)] = np.frombuffer(body, np.uint8).astype(np.int32) + 2
    order = suffix_array(text)
    common = permuted_lcp(text, order, starts, 4 * LEAST + 256)[order]
    doc = np.full(len(text), np.iinfo(np.int64).max)
    valid = _ranges(starts, n)
    context = np.repeat(np.arange(len(rows)), n)
    doc[valid] = rows["doc"][context]
    first = np.nonzero(np.append(True, common[1:] < LEAST))[0]
    least = np.empty(len(text), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(doc[order], first), np.diff(np.append(first, len(order))))
    gone = doc[valid] > least[valid]
    at = (valid - starts[context] + rows["at"][context])[gone]
    context = context[gone]
    return _spans(rows["rid"][context], rows["doc"][context], at, np.ones(len(at), np.int64))


def _shard(buckets: int):
    """Stage 3b, on a shard of contexts: spans by suffix array; spans are dealt to their documents."""

    def run(table: pa.Table) -> pa.Table:
        spans = _loads(table, SPANS)
        if strings := _loads(table, STRINGS):
            spans.append(_strings(np.concatenate(strings))[0])
        if loads := _loads(table, CONTEXTS):
            spans.append(shard_spans(np.concatenate([r for r, _ in loads]), b"".join([b for _, b in loads])))
        spans = _merged(_joined(spans, _SPAN))
        return _table(_split(spans, spans["rid"] % buckets, SPANS))

    return run


def _cut(docs: pa.Table, table: pa.Table):
    """(text bytes or None, merged spans) of each document of a bucket."""
    spans = _merged(_joined(_loads(table, SPANS), _SPAN))
    rid, doc = (docs[c].to_numpy() if docs.num_rows else np.zeros(0, np.int64) for c in ("rid", "doc"))
    lo, hi = np.searchsorted(spans["rid"], rid, "left"), np.searchsorted(spans["rid"], rid, "right")
    of, s, e = spans["doc"].tolist(), spans["s"].tolist(), spans["e"].tolist()
    for text, own, i, j in zip(docs["text"], doc.tolist(), lo.tolist(), hi.tolist()):
        raw = text.as_py()
        yield None if raw is None else raw.encode(), [(s[k], e[k]) for k in range(i, j) if of[k] == own]


def _kept(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    if not spans:
        return raw
    at, kept = 0, []
    for s, e in spans:
        kept.append(raw[at:s])
        at = e
    kept.append(raw[at:])
    return b"".join(kept)


def _repeats(docs: DataFrame, finish: Callable[[pa.Table, pa.Table], pa.Table], schema: str, most: int = HOT) -> DataFrame:
    """Run all stages; ``docs`` has the columns id (long) and text and any others; ``finish`` makes the rows."""
    total = bounded(docs).select(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    keyed = docs.withColumns({"doc": F.coalesce(F.col("id"), F.lit((1 << 63) - 1)), "crc": F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0))})
    keyed = keyed.withColumn("rid", F.xxhash64("doc", "crc")).withColumn("dest", F.pmod("rid", F.lit(buckets)).cast("int"))
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_grams(keyed))  # SHARE longs at most
    dealt = keyed.select("text", "doc", "crc").mapInArrow(_deal(buckets, frequent), _ROWS)
    keyed = keyed.drop("crc")
    met = dealt.groupBy("dest").applyInArrow(_grouped(_meet(buckets, most)), _ROWS)
    fetched = keyed.groupBy("dest").cogroup(met.groupBy("dest")).applyInArrow(_cogrouped(_fetch(buckets * SHARDS)), _ROWS)
    spans = fetched.groupBy("dest").applyInArrow(_grouped(_shard(buckets)), _ROWS)
    return keyed.groupBy("dest").cogroup(spans.groupBy("dest")).applyInArrow(_cogrouped(finish), schema)


def repeat_digests(docs: DataFrame, most: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""

    def finish(rows: pa.Table, table: pa.Table) -> pa.Table:
        n_bytes, n_removed, n_spans, sha = [], [], [], []
        for raw, spans in _cut(rows, table):
            raw = raw or b""
            kept = _kept(raw, spans)
            n_bytes.append(len(raw))
            n_removed.append(len(raw) - len(kept))
            n_spans.append(len(spans))
            sha.append(hashlib.sha256(kept).hexdigest())
        return pa.table({"doc_id": rows["id"], "n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})

    chosen = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text"))
    return _repeats(chosen, finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", most)


def deduplicated(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with repeated passages cut out of the text and n_chars counted anew."""
    own = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def finish(rows: pa.Table, table: pa.Table) -> pa.Table:
        made = [None if raw is None else _kept(raw, spans).decode("utf-8", "ignore") for raw, spans in _cut(rows, table)]
        columns = {c: rows["id"] if c == "doc_id" else pa.array(made, pa.string()) if c == "text" else rows[f"_{i}"] for i, c in enumerate(own)}
        if "n_chars" in own:
            columns["n_chars"] = pa.array([None if t is None else len(t) for t in made], rows[f"_{own.index('n_chars')}"].type)
        return pa.table(columns)

    chosen = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text"), *[docs[c].alias(f"_{i}") for i, c in enumerate(own) if c not in ("doc_id", "text")])
    return _repeats(chosen, finish, schema)
