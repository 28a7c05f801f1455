"""Near copies of documents: texts whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

Equal sets meet first (one row each from there on).  A set's SimHash has 256 bits, each the majority vote of one hash of
its shingles: with 64 bits, the radius that holds copies of 0.8 would hold 3% of all pairs.  Keys of some of the bits
deal the fingerprints into blocks; a block is sorted by set size and population count, cut into tiles, and tiles are
compared by exclusive-or and bit counts, skipping those whose population counts are further apart than the radius or
whose sizes no copies can have.  Radius and number of keys come from the exact chance that a bit differs: a pair at 0.8
is missed less than once in 100,000 (``LARGE``, ``SMALL``).

Sets that fingerprints connect form a cell, cut into sub-blocks that meet pairwise where it is large.  In a cell every pair
is checked exactly: sets this similar share one of their least hashes, and those that do are intersected unless links
already join them.  A block and a cell return links as a forest, never all pairs.

Defined results: words, case and texts of up to 5 words are as in ``simhash``; null, empty and wordless texts are
copies of one another; a null id is no document's least while its group has another.
"""

from __future__ import annotations

from functools import cache
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, checkpointed, map_text, release, utf8_len
from .simhash import _LOWER, _WORDS, SEED, Forest, components, named_rows

SHINGLE, WORDS = 5, 4
#: Rows and bytes of text of two sub-blocks of a cell.
BLOCK, BLOCK_BYTES = 2048, 32 << 20
#: Bits of a key: LEAST, or more, until a block of unlike sets has at most AIM rows; blocks above FULL rows are cut.
LEAST, AIM, FULL, TILE = 5, 16384, 32768, 256


class Settings(NamedTuple):
    """How far fingerprints of copies lie apart."""

    chance: float  #: that a bit differs, at most, in two sets of similarity 0.8
    radius: int  #: differing bits of linked fingerprints
    first: int  #: differing bits of their first words


#: Chances are the largest over all sizes: for sets of 12 shared shingles and 3 others, and (SMALL) for 4 shingles of 5.
LARGE, SMALL = Settings(0.1612, 70, 25), Settings(0.1875, 80, 64)
#: Sets below TINY shingles have no copies but equal sets; SMALL holds where the smaller set has TINY.
TINY = 4
#: Chance that a pair at 0.8 is beyond the radius or shares no key (beyond LARGE.first: 0.0000025 more).
MISS = 7e-6
_STEP = 4096
_ADDED = np.arange(WORDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_MIXERS = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_HALF = np.uint64(33)
_FP = [f"w{i}" for i in range(WORDS)]


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    from xxhash import xxh64_intdigest

    words = _WORDS.findall((text or "").encode().translate(_LOWER))
    whole = b" ".join(words)
    if len(words) <= SHINGLE:
        return np.array([xxh64_intdigest(whole, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = len(words) - SHINGLE + 1
    return np.unique(np.fromiter((xxh64_intdigest(whole[s:e], SEED) for s, e in zip(starts[:n].tolist(), ends[SHINGLE - 1 :].tolist())), np.uint64, n))


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The words of the SimHash of a set: each hash votes with its bits, mixed anew for every word."""
    votes = np.zeros(WORDS * 64, dtype=np.int64)
    for at in range(0, len(hashes), _STEP):
        mixed = hashes[at : at + _STEP, None] + _ADDED
        for by in _MIXERS:
            mixed ^= mixed >> _HALF
            mixed *= by
        mixed ^= mixed >> _HALF
        bits = np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little")
        for part in range(0, len(bits), 255):
            votes += bits[part : part + 255].sum(axis=0, dtype=np.uint8)
    return np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.uint64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, _rid, size, node (a hash of the shingle set), n (shingles of the set) and the words of its fingerprint."""
    from xxhash import xxh64_intdigest

    def kernel(part: pa.RecordBatch) -> dict:
        sets = [shingles(t) for t in part.column(0).to_pylist()]
        node = np.array([xxh64_intdigest(s.tobytes(), SEED) for s in sets], dtype=np.uint64).view(np.int64)
        made = np.array([fingerprint(s) for s in sets], dtype=np.uint64).reshape(-1, WORDS).view(np.int64)
        out = {"doc_id": part.column(1), "_rid": part.column(2), "size": part.column(3), "node": pa.array(node), "n": pa.array(np.array([len(s) for s in sets], np.int64))}
        return out | {w: pa.array(made[:, i].copy()) for i, w in enumerate(_FP)}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_text(docs.select("text", "doc_id", "_rid", utf8_len().alias("size")), kernel, f"doc_id {kind}, _rid long, size long, node long, n long, " + ", ".join(f"{w} long" for w in _FP))


@cache
def keys_needed(take: int, settings: Settings) -> int:
    """The least number of keys of ``take`` bits by which, and by the radius, no more than MISS of the pairs at 0.8 are missed."""
    bits, p = WORDS * 64, settings.chance
    weights = np.array([comb(bits, d) * p**d * (1 - p) ** (bits - d) for d in range(bits + 1)])
    apart = np.array([1 - comb(bits - d, take) / comb(bits, take) for d in range(settings.radius + 1)])
    left, beyond = weights[: settings.radius + 1] * apart, weights[settings.radius + 1 :].sum()
    if beyond > MISS:
        raise ValueError("no number of keys makes up for this radius")
    keys = 1
    while left.sum() + beyond > MISS:
        left *= apart
        keys += 1
    return keys


@cache
def key_bits(take: int) -> np.ndarray:
    """The bits of every key, cut from permutations of all bits."""
    rng, bits, keys = np.random.default_rng(SEED), WORDS * 64, keys_needed(take, SMALL)
    each = max(1, bits // max(take, 1))
    return np.concatenate([rng.permutation(bits)[: each * take].reshape(each, take) for _ in range(-(-keys // each))])[:keys]


def dealt(nodes: DataFrame, take: int, counts: bool = False) -> DataFrame:
    """key, node, n and fingerprint for every key of every set (or key and rows, for each batch)."""
    chosen, few = key_bits(take), keys_needed(take, LARGE)
    places = np.int64(1) << np.arange(take, dtype=np.int64)

    def run(batches):
        for b in batches:
            n, node = b.column(1).to_numpy(), b.column(0)
            words = np.stack([b.column(2 + i).to_numpy() for i in range(WORDS)], axis=1)
            bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little").astype(np.int64)
            small = np.nonzero(n <= TINY + 1)[0]
            for k, of in enumerate(chosen):
                # smaller sets than TINY + 2 may be SMALL pairs and have more keys
                at = np.arange(len(n)) if k < few else small
                if not len(at):
                    break
                key = bits[np.ix_(at, of)] @ places + (k << take)
                if counts:
                    key, rows = np.unique(key, return_counts=True)
                    yield pa.RecordBatch.from_pydict({"key": pa.array(key), "rows": pa.array(rows)})
                else:
                    out = {"key": pa.array(key), "node": node.take(pa.array(at)), "n": pa.array(n[at])}
                    yield pa.RecordBatch.from_pydict(out | {w: pa.array(words[at, i]) for i, w in enumerate(_FP)})

    rows = bounded(nodes.filter(F.col("n") >= TINY).select("node", "n", *_FP))
    return rows.mapInArrow(run, "key long, rows long" if counts else "key long, node long, n long, " + ", ".join(f"{w} long" for w in _FP))


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` with the rows a[i] and b[i] linked; every row names the least of its component, before and after."""
    while len(a):
        for x, y in zip(root[a[:1024]].tolist(), root[b[:1024]].tolist()):
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            root[max(x, y)] = min(x, y)
        while not np.array_equal(up := root[root], root):
            root = up
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def tiled_links(fps: np.ndarray, n: np.ndarray, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """An order of a block's sets and, in that order, the component root of each, by comparing tile with tile.

    ``side`` marks two sub-blocks; sets of one sub-block are then only compared with the other's.
    """
    counts = np.bitwise_count(fps).sum(axis=1, dtype=np.int64)
    order = np.lexsort((counts, n))
    fps, n, counts, side = fps[order], n[order], counts[order], None if side is None else side[order]
    root = np.arange(len(n))
    firsts = np.ascontiguousarray(fps[:, 0])
    bits, ones = np.empty((TILE, TILE), np.uint64), np.empty((TILE, TILE), np.uint8)
    starts = range(0, len(n), TILE)
    low, high = (np.array([f(counts[s : s + TILE]) for s in starts]) for f in (np.min, np.max))
    for i, at in enumerate(starts):
        a = firsts[at : at + TILE]
        settings = SMALL if n[at] <= TINY else LARGE
        for j in range(i, len(starts)):
            on = j * TILE
            if 4 * n[on] > 5 * n[min(at + TILE, len(n)) - 1]:
                break
            if low[j] - high[i] > settings.radius or low[i] - high[j] > settings.radius:
                continue
            b = firsts[on : on + TILE]
            x, c = bits[: len(a), : len(b)], ones[: len(a), : len(b)]
            np.bitwise_count(np.bitwise_xor(a[:, None], b[None, :], out=x), out=c)
            p, q = np.nonzero(c <= settings.first)
            p, q = p + at, q + on
            less, more = np.minimum(n[p], n[q]), np.maximum(n[p], n[q])
            # sets of one size differ in one shingle of nine or more, if at all
            may = (root[p] != root[q]) & (5 * less >= 4 * more) & ((less < more) | (less > 8))
            if side is not None:
                may &= side[p] != side[q]
            p, q, less = p[may], q[may], less[may]
            apart = np.bitwise_count(fps[p] ^ fps[q]).sum(axis=1, dtype=np.int64)
            near = apart <= np.where(less <= TINY, SMALL.radius, LARGE.radius)
            root = joined(root, p[near], q[near])
    return order, root


def fingerprint_links(nodes: DataFrame) -> DataFrame:
    """fp, root: a forest of the sets (columns node, n and fingerprint) whose fingerprints share a key and lie within the radius."""
    take = max(LEAST, int(max(nodes.count() - 1, 0) // AIM).bit_length())
    large = dealt(nodes, take, counts=True).groupBy("key").agg(F.sum("rows").alias("rows")).filter(F.col("rows") > FULL)
    # at most one for FULL rows
    large = F.broadcast(large.select("key", F.ceil(F.col("rows") * 2 / FULL).cast("int").alias("subs")))
    cells, mine = sub_blocks(dealt(nodes, take).join(large, "key", "left").withColumn("subs", F.coalesce("subs", F.lit(1))))

    def compare(table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        fps = np.stack([table[w].to_numpy() for w in _FP], axis=1).view(np.uint64)
        two = len(node) and table["a"][0].as_py() != table["b"][0].as_py()
        order, root = tiled_links(fps, table["n"].to_numpy(), table["side"].to_numpy() if two else None)
        node = node[order]
        linked = np.nonzero(root != np.arange(len(node)))[0]
        return pa.table({"fp": pa.array(node[linked]), "root": pa.array(node[root[linked]])})

    cells = cells.select("key", "meet.a", "meet.b", (mine == F.col("meet.a")).alias("side"), "node", "n", *_FP)
    return cells.groupBy("key", "a", "b").applyInArrow(compare, "fp long, root long").distinct()


def sub_blocks(rows: DataFrame):
    """``rows`` with every pair of sub-blocks of 0 to subs - 1 in which a row's meets (column meet), and the row's own."""
    mine = F.pmod(F.xxhash64("node"), F.col("subs")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("subs") - 1), lambda o: F.struct(F.least(mine, o).alias("a"), F.greatest(mine, o).alias("b")))
    return rows.withColumn("meet", F.explode(meets)), mine


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sorted sets is 0.8 or more."""
    if 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    return 9 * int((both[1:] == both[:-1]).sum()) >= 4 * len(both)


def linked_sets(sets: list[np.ndarray], side: np.ndarray | None = None) -> np.ndarray:
    """The component root of each set by exact similarity; ``side`` marks two sub-blocks, only compared with each other."""
    root = Forest(len(sets)).root
    met: dict[int, list[int]] = {}
    for i, mine in enumerate(sets):
        # sets of similarity 0.8 share over four fifths of the larger one, so also one of these least hashes
        least = mine[: len(mine) - (4 * len(mine) + 4) // 5 + 1].tolist()
        near = np.unique(np.fromiter((j for h in least for j in met.get(h, ())), np.int64))
        if side is not None:
            near = near[side[near] != side[i]]
        while len(near := near[root[near] != root[i]]):
            if similar(mine, sets[near[0]]):
                a, b = root[near[0]], root[i]
                root[root == max(a, b)] = min(a, b)
            near = near[1:]
        for h in least:
            met.setdefault(h, []).append(i)
    return root


def exact_links(cells: DataFrame) -> DataFrame:
    """fp, root: a forest of the similar pairs in each cell (columns cell, a, b, side, node, text)."""

    def compare(table: pa.Table) -> pa.Table:
        node, at = np.unique(table["node"].to_numpy(), return_index=True)  # repeated rows of one document
        texts = table["text"].take(pa.array(at)).to_pylist()
        two = len(node) and table["a"][0].as_py() != table["b"][0].as_py()
        root = linked_sets([shingles(t) for t in texts], table["side"].to_numpy()[at] if two else None)
        linked = np.nonzero(root != np.arange(len(node)))[0]
        out = pa.table({"fp": pa.array(node[linked]), "root": pa.array(node[root[linked]])})
        if len(node) > 256:
            del texts
            release()
        return out

    return cells.groupBy("cell", "a", "b").applyInArrow(compare, "fp long, root long").distinct()


def one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` but one of each group of near copies: its least id (of equal ids, one row)."""
    keyed, restored = named_rows(docs)
    prints = checkpointed(signatures(keyed))
    nodes = prints.groupBy("node").agg(F.min("_rid").alias("_rid"), F.max("size").alias("size"), *[F.any_value(c).alias(c) for c in ("n", *_FP)])
    nodes = checkpointed(nodes)
    near = components(fingerprint_links(nodes))
    # a component's root isn't listed as one of its nodes
    members = near.union(near.select("root", "root")).distinct()
    members = checkpointed(nodes.select("node", "_rid", "size").join(members, "node"))
    subs = members.groupBy("root").agg(F.greatest(F.lit(1), F.ceil(F.count("*") * 2 / BLOCK), F.ceil(F.sum("size") * 2 / BLOCK_BYTES)).cast("int").alias("subs"))
    subs = subs.withColumn("subs", F.when(F.col("subs") <= 2, 1).otherwise(F.col("subs")))
    cells, mine = sub_blocks(members.join(subs, "root").join(keyed.select("_rid", "text"), "_rid"))
    links = exact_links(cells.select(F.col("root").alias("cell"), "meet.a", "meet.b", (mine == F.col("meet.a")).alias("side"), "node", "text"))
    roots = components(links).withColumnRenamed("node", "_node")
    named = prints.select("doc_id", "_rid", "node").join(roots, F.col("node") == F.col("_node"), "left")
    # a null id is no document's least while the group has another
    head = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_rid")))
    heads = named.groupBy(F.coalesce("root", "node").alias("root")).agg(head.alias("h")).select(F.col("h._rid").alias("_rid"))
    # equal rows have one _rid and meet here, already dealt by it
    return restored(keyed.join(heads, "_rid", "left_semi").dropDuplicates(["_rid", "doc_id"]))
