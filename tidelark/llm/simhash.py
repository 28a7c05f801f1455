"""SimHash near-duplicates: tiled exact comparison of fingerprints.

Fingerprints are 64-bit majority votes over the XXH64 (seed 42) of word shingles.  Equal fingerprints meet first (one
row each from there on).  Two fingerprints within ``RADIUS`` differing bits agree on at least m of RADIUS + m bands of
bits, so the leading bits of every choice of m bands deal the fingerprints into blocks.  One band is enough for 2^25
fingerprints; m grows with their number (and the key with it), so that a block of unlike fingerprints stays near ``AIM``
rows.  A block is sorted by population count, cut into tiles, and tiles are compared by exclusive-or and bit counts, skipping pairs of tiles whose population counts
are further apart than the radius.  Blocks above ``BLOCK`` rows are cut into sub-blocks that meet pairwise.  A task
returns links as a forest (each row to the least of its component there), never all pairs; the forests are joined
by alternating large-star and small-star steps on DataFrames, checkpointed each round.

Defined results: null, empty and wordless texts have fingerprint zero and link like any other; repeated rows keep
their own rows; a null id never names a component unless its component has no other; extra columns are ignored.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, map_text

RADIUS, SHINGLE, SEED = 3, 3, 42
TILE, BLOCK, AIM = 256, 4096, 512
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_STEP = 50_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    from xxhash import xxh64_intdigest

    words = _WORDS.findall((text or "").encode().translate(_LOWER))
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxh64_intdigest(whole, SEED)], dtype=np.uint64)
        votes = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n = 1
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.append(0, ends[:-1] + 1)
        n, votes = len(words) - shingle + 1, np.zeros(64, dtype=np.int64)
        for at in range(0, n, _STEP):
            pairs = zip(starts[at : min(at + _STEP, n)].tolist(), ends[at + shingle - 1 : min(at + _STEP, n) + shingle - 1].tolist())
            hashes = np.array([xxh64_intdigest(whole[s:e], SEED) for s, e in pairs], dtype=np.uint64)
            votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), shingle: int = SHINGLE) -> DataFrame:
    """id, fp (the fingerprint as a signed long) and the columns ``keep``."""

    def kernel(part: pa.RecordBatch) -> dict:
        made = np.array([fingerprint(t, shingle) for t in part.column(0).to_pylist()], dtype=np.uint64)
        out = {c: part.column(i + 1) for i, c in enumerate([id_col, *keep])}
        return out | {"fp": pa.array(made.view(np.int64))}

    types = {c: docs.schema[c].dataType.simpleString() for c in (id_col, *keep)}
    return map_text(docs.select(docs[text_col].alias("text"), docs[id_col], *[docs[c] for c in keep]), kernel, ", ".join(f"`{c}` {t}" for c, t in types.items()) + ", fp long")


class Forest:
    """Components of one task's rows, each named by its least position."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray, near: np.ndarray) -> None:
        """Link the rows a[i] and b[j] wherever near[i, j]."""
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = near & (ra[:, None] != rb[None, :])
            i, j = np.unravel_index(apart.argmax(), apart.shape)
            if not apart[i, j]:
                return
            # all that meet row i's component at once
            met = np.unique(np.append(rb[apart[i]], ra[i]))
            self.root[np.isin(self.root, met)] = met[0]


def tiled_links(fps: np.ndarray, side: np.ndarray | None = None, radius: int = RADIUS, tile: int = TILE) -> np.ndarray:
    """The component root of each fingerprint of a block (position of a row), by comparing tile with tile.

    ``side`` marks two sub-blocks; rows of one sub-block are then only compared with the other's.
    """
    counts = np.bitwise_count(fps)
    order = np.argsort(counts, kind="stable")
    forest = Forest(len(fps))
    cuts = [order[i : i + tile] for i in range(0, len(order), tile)]
    for i, a in enumerate(cuts):
        top = int(counts[a[-1]])
        for b in cuts[i:]:
            if int(counts[b[0]]) - top > radius:
                break
            near = np.bitwise_count(fps[a][:, None] ^ fps[b][None, :]) <= radius
            if side is not None:
                near &= side[a][:, None] != side[b][None, :]
            forest.link(a, b, near)
    return forest.root


def band_choices(n: int, radius: int) -> list[list[tuple[int, int]]]:
    """For each key its bands, as (bits to the right, bits taken), such that a block of n random numbers has about AIM rows."""
    bits = int(max(n, 1) / AIM).bit_length()
    m = next((m for m in range(1, 64 - radius) if 64 // (radius + m) * m >= bits), 63 - radius)
    width = 64 // (radius + m)
    take = min(width, -(-bits // m))
    return [[(64 - b * width - take, take) for b in chosen] for chosen in combinations(range(radius + m), m)]


def near_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fp, root: a forest whose components are those of all links among the distinct fingerprints (column fp)."""
    keys = []
    for i, bands in enumerate(band_choices(distinct.count(), radius)):
        part = F.lit(0).cast("long")
        for right, take in bands:
            part = F.shiftleft(part, take).bitwiseOR(F.shiftrightunsigned("fp", right).bitwiseAND(F.lit((1 << take) - 1).cast("long")))
        keys.append(F.struct(F.lit(i).alias("band"), part.alias("part")))
    key = F.explode(F.array(*keys))
    dealt = distinct.select("fp", key.alias("k")).select("fp", "k.band", "k.part")
    # blocks too large for a task are cut in sub-blocks by hash; only those are listed here
    large = dealt.groupBy("band", "part").count().filter(F.col("count") > BLOCK).withColumn("subs", F.ceil(F.col("count") / (BLOCK / 2)).cast("int")).drop("count")
    dealt = dealt.join(large, ["band", "part"], "left").withColumn("subs", F.coalesce("subs", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("subs")).cast("int")
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("subs") - 1), lambda o: F.struct(F.least(mine, o).alias("a"), F.greatest(mine, o).alias("b"))))
    cells = dealt.withColumn("cell", meets).select("fp", "band", "part", "cell.a", "cell.b", (mine == F.col("cell.a")).alias("side"))

    def compare(table: pa.Table) -> pa.Table:
        fps = table["fp"].to_numpy().view(np.uint64)
        two = table["a"][0].as_py() != table["b"][0].as_py() if len(fps) else False
        root = tiled_links(fps, table["side"].to_numpy() if two else None, radius)
        linked = np.nonzero(root != np.arange(len(fps)))[0]
        return pa.table({"fp": pa.array(fps[linked].view(np.int64)), "root": pa.array(fps[root[linked]].view(np.int64))})

    return cells.groupBy("band", "part", "a", "b").applyInArrow(compare, "fp long, root long").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root (the least node of its component) of every linked node, by large-star and small-star steps."""
    edges = links.select(F.greatest("fp", "root").alias("u"), F.least("fp", "root").alias("v")).filter("u <> v").distinct()
    edges = checkpointed(edges)
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = large.join(small, "u").select(F.col("v").alias("a"), "m").union(small.select(F.col("u").alias("a"), "m"))
        edges = checkpointed(edges.filter("a <> m").select(F.col("a").alias("u"), F.col("m").alias("v")).distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def grouped(prints: DataFrame, id_col: str, radius: int) -> DataFrame:
    """``prints`` (written fingerprints with ids) and component_id, the least id reachable."""
    distinct = checkpointed(prints.groupBy("fp").agg(F.min(id_col).alias("least")))
    roots = components(near_links(distinct.select("fp"), radius))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    heads = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(heads, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """id, fingerprint (16 hex digits), component_id (the least id reachable)."""
    out = grouped(checkpointed(fingerprints(docs, id_col, text_col, shingle=shingle)), id_col, radius)
    return out.select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` but one of each group of near duplicates: its least id (of equal ids, one row)."""
    keyed, restored = named_rows(docs)
    groups = grouped(checkpointed(fingerprints(keyed, keep=("_rid",), shingle=shingle)), "doc_id", radius)
    # a null id is no document's least while the group has another
    head = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_rid")))
    heads = groups.groupBy("root").agg(head.alias("h")).select(F.col("h._rid").alias("_rid"))
    # equal rows have one _rid and meet here, already dealt by it
    return restored(keyed.join(heads, "_rid", "left_semi").dropDuplicates(["_rid", "doc_id"]))


def named_rows(docs: DataFrame):
    """(doc_id, text, _rid, which names a row by id and text, and the other columns under names of their own; the way back)."""
    at = {c: c if c in ("doc_id", "text") else f"_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[docs[c].alias(v) for c, v in at.items()])
    return renamed.withColumn("_rid", F.xxhash64("doc_id", "text")), lambda rows: rows.select(*[rows[v].alias(c) for c, v in at.items()])
