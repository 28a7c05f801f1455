"""The corpus operators against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
QUERY = ["op1_toxicity", "op2_simhash", "op3_quality", "op4_suffix_dedup", "op5_decontamination", "op6_token_counts", "op7_language_id", "op8_hilbert_shards", "op9_piece_codec", "op10_exact_topk"]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)], SCHEMA)


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


ODD = ["", None, " ", "\t\n", "a", "a b", "<|endoftext|> it's", "İstanbul ΣΑΣ", "é日本語 ▁x  y ", "x" * 3000, "\x00\x01\x85", "don't 'RE 12²"]


# -- every operator on empty tables, odd rows, repeated rows and clashing columns ----------------------------------


def _run(spark, name, d):
    from tidelark.llm import decontam, langid, nearcopies, piece_codec, quality, sharding, simhash, substrings, token_counts, toxicity

    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (None, 1, None)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "a b"), (None, None)], "item_id long, text string")
    return {
        "op1": lambda: toxicity.document_toxicity(d, labels), "op2": lambda: simhash.near_duplicates(d), "op3": lambda: quality.document_quality(d, labels), "op4": lambda: substrings.repeat_digests(d),
        "op5": lambda: decontam.contamination(d, bench), "op6": lambda: token_counts.token_counts(d), "op7": lambda: langid.language_ids(d), "op8": lambda: sharding.hilbert_shards(d), "op9": lambda: piece_codec.encode_digests(d),
        "one_per_group": lambda: simhash.one_per_group(d), "near_one_per_group": lambda: nearcopies.one_per_group(d), "with_language": lambda: langid.with_language(d), "deduplicated": lambda: substrings.deduplicated(d), "decontaminated": lambda: decontam.decontaminated(d, bench),
    }[name]()


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9"])
def test_odd_tables(spark, name):
    rows = [(i, t, None if i % 3 else "en", None if i % 2 else "s", None) for i, t in enumerate(ODD)] + [(3, "a", "en", "s", 1), (3, "a", "en", "s", 1), (None, None, None, None, None)]
    d = spark.createDataFrame(rows, SCHEMA).withColumns({"text_": F.lit(1), "fp": F.lit(2), "score": F.lit("x"), "rid": F.lit(3), "doc": F.lit("y")})
    assert _run(spark, name, d).count() == len(rows)
    assert _run(spark, name, d.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["one_per_group", "near_one_per_group", "with_language", "deduplicated", "decontaminated"])
def test_stages_keep_the_columns(spark, name):
    d = docs(spark, [*ODD, "a", "some words of a text here"]).withColumns({c: F.lit(7) for c in ("fp", "lang_pred", "rid", "_rid", "node", "root", "_spans", "_hits", "_items", "_n_words", "c0", "_0", "dest")})
    out = _run(spark, name, d)
    assert out.columns == d.columns and out.count() <= d.count() and out.filter("_rid <> 7 OR _spans <> 7 OR c0 <> 7 OR _0 <> 7 OR node <> 7").count() == 0
    assert _run(spark, name, d.limit(0)).count() == 0


# -- op1, op3, op7: held-out accuracy ------------------------------------------------------------------------------


def test_toxicity_finds_held_out_and_gapped_insults(spark):
    from tidelark.llm import toxicity as M

    rng = random.Random(1)
    words = ["".join(rng.choice(["th", "er", "an", "on", "ti", "es", "in", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    texts, toxic = [], []
    for i in range(500):
        t = [rng.choice(words) for _ in range(60)]
        toxic.append(int(i % 4 == 0))
        if toxic[-1]:
            t[rng.randrange(60)] = rng.choice(["moron", "worthless", "chlla" + rng.choice(["ero", "dad", "ndo"])])
        texts.append(" ".join(t))
    d = docs(spark, texts)
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(toxic)], "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in M.document_toxicity(d, labels).collect()}
    held = [i for i in out if out[i]["held_out"]]
    assert held == [i for i in out if crc32(str(i).encode()) % 5 == 0] or set(held) == {i for i in out if crc32(str(i).encode()) % 5 == 0}
    assert np.mean([out[i]["predicted"] == toxic[i] for i in held]) > 0.97
    model = M.fit(d, labels)
    assert (model.worst(["you m o r o n", "mor0n", "worth-less", "chllazzz"]) > 0).all() and (model.worst(["then on", ""]) < 0).all()
    assert model.sentence is not None and (model.scores(["you m o r o n", "mor0n", "worth-less", "chllazzz"]) > 0.5).all() and (model.scores(["then on", "", None]) < 0.5).all()


def test_toxicity_by_language_on_held_out_rows(spark):
    """In every language; counted together where a language has few held-out toxic rows."""
    from tidelark.llm import toxicity as M

    d, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = M.document_toxicity(d, labels).filter("held_out").join(labels, "doc_id").join(d.select("doc_id", "lang"), "doc_id").groupBy("lang", "toxic").agg(F.count("*").alias("n"), F.sum("predicted").alias("p")).collect()
    rate = lambda rows: sum(r["p"] for r in rows) / sum(r["n"] for r in rows)
    toxic, clean = [r for r in out if r["toxic"] == 1], [r for r in out if r["toxic"] == 0]
    assert rate([r for r in toxic if r["lang"] == "en"]) >= 0.9 and rate([r for r in toxic if r["lang"] != "en"]) >= 0.7
    assert all(r["p"] <= 0.03 * r["n"] for r in clean)


def test_kernel_matches_its_definition():
    from itertools import combinations

    from tidelark.llm.toxicity import LAMBDA, SPAN, P, kernel

    def phi(w):
        out = {}
        for c in combinations(range(len(w)), P):
            if c[-1] - c[0] < SPAN:
                k = "".join(w[i] for i in c)
                out[k] = out.get(k, 0) + LAMBDA ** (c[-1] - c[0] + 1)
        n = sum(v * v for v in out.values()) ** 0.5
        return {k: v / n for k, v in out.items()}

    a, b = ["banana", "idiot", "idxiot"], ["idiot", "ananas"]
    want = [[sum(v * phi(y).get(k, 0) for k, v in phi(x).items()) for y in b] for x in a]
    assert np.allclose(kernel(a, b), want)


def test_language_and_quality_on_held_out_rows(spark):
    from tidelark.llm import langid, quality

    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in d.select("doc_id", "lang").collect()}
    out = langid.language_ids(d).collect()
    held = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98 and all(0 <= r["score"] <= 1 for r in out)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = {r["doc_id"]: r["quality"] for r in labels.collect()}
    kept = {r["doc_id"]: r["keep"] for r in quality.document_quality(d, labels).collect()}
    assert np.mean([kept[i] == (q == 1) for i, q in good.items() if crc32(str(i).encode()) % 5 == 0]) > 0.9


def test_sparse_sites_shrink_toward_their_parents(spark):
    from tidelark.llm.quality import quality

    rows = [(i, "t", "en", "big", 1) for i in range(200)] + [(900, "t", "en", "tiny", 1)]
    out = {r["doc_id"]: r for r in quality(spark.createDataFrame(rows, SCHEMA), None).collect()}
    assert abs(out[900]["host_rate"] - 0.5) < 0.01 and out[0]["keep"]


def test_quality_matches_plain_posteriors(spark):
    """Rates, concentrations and scores from the documents' evidence, site by site."""
    from tidelark.llm import quality as M

    rng = random.Random(12)
    rows = [(i, "".join(rng.choice("abc DE\n.!1") for _ in range(rng.randint(0, 80))), rng.choice(["en", "de"]), rng.choice(["a", "http://x.y/p/q", "http://x.y/z", None]), 1) for i in range(120)] + [(900, "lone", "fr", "only", 1)]
    x = M.features(pa.array([r[1] for r in rows]))
    model = M.Logistic(x, np.array([float(i % 3 > 0) for i in range(len(rows))]))
    got = {r["doc_id"]: r for r in M.quality(spark.createDataFrame(rows, SCHEMA), model).collect()}
    odds = dict(zip([r[0] for r in rows], model.log_odds(x)))
    p = {i: 1 / (1 + np.exp(-o)) for i, o in odds.items()}
    paths, hosts = {}, {}
    for i, r in got.items():
        paths.setdefault((r["host"], r["path"]), []).append(p[i])
        hosts.setdefault(r["host"], []).append(p[i])
    mu = sum(p.values()) / len(p)

    def fitted(groups):  # (values, parent rate)
        n = np.array([len(v) for v, _ in groups], float)
        rate, parent = np.array([np.mean(v) for v, _ in groups]), np.array([q for _, q in groups])
        spread = max((n * (rate - parent) ** 2).sum() - (parent * (1 - parent)).sum(), 1e-9)
        between = spread / max(n.sum() - (n * n).sum() / n.sum(), 1e-9)
        return min(M.MOST, max(M.LEAST, (parent * (1 - parent)).mean() / between - 1))

    k_host = fitted([(v, mu) for v in hosts.values()])
    whole = {h: (sum(v) + k_host * mu) / (len(v) + k_host) for h, v in hosts.items()}
    k_path = fitted([(v, whole[h]) for (h, _), v in paths.items()])
    for i, r in got.items():
        h, v = hosts[r["host"]], paths[r["host"], r["path"]]
        host = (sum(h) - p[i] + k_host * mu) / (len(h) - 1 + k_host)
        path = (sum(v) - p[i] + k_path * host) / (len(v) - 1 + k_path)
        score = 1 / (1 + np.exp(-(odds[i] + np.log(path / (1 - path)) - np.log(mu / (1 - mu)))))
        assert [r["evidence"], r["host_rate"], r["path_rate"], r["score"]] == pytest.approx([p[i], host, path, score], rel=1e-6)
        assert r["keep"] == (r["score"] >= M.THRESHOLD)


def _plain_bits(train, text, order):
    """Code length of a text by escape method C over bytes, straight from the training texts."""
    fold = lambda t: t.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
    padded = [b" " * order + fold(t) for t in train]
    total, history = 0.0, b" " * order
    for s in fold(text):
        for k in range(order, -1, -1):
            ctx = history[len(history) - k :]
            seen = [t[i] for t in padded for i in range(order, len(t)) if t[i - k : i] == ctx]
            kinds = len(set(seen))
            if s in seen:
                total += np.log2((len(seen) + kinds) / seen.count(s))
                break
            total += np.log2((len(seen) + kinds) / kinds) if seen else 0
        else:
            total += 8
        history += bytes([s])
    return total


def test_language_ids_match_a_plain_escape_model(spark):
    """Predictions, scores and code lengths of the query against brute force, in several scripts."""
    from tidelark.llm import langid

    rng = random.Random(8)
    scripts = {"ar": "ابتثجح ", "ja": "日本語のは ", "ru": "абвгд ", "xx": "abcde "}
    rows = [(i, "".join(rng.choice(a) for _ in range(rng.randint(3, 25))), lang) for i, (lang, a) in enumerate(list(scripts.items()) * 12)]
    rows += [(100 + i, t, None) for i, t in enumerate(["Ξένο κείμενο", "аб日", "ABC ж", "123", ""])]
    out = {r["doc_id"]: r for r in langid.language_ids(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    train = {x: [t for i, t, y in rows if y == x and crc32(str(i).encode()) % 4 != 2] for x in scripts}
    for i, t, _ in rows:
        if not any(c.isalpha() for c in t):
            assert (out[i]["lang_pred"], out[i]["score"]) == ("und", 0)
            continue
        bits = {x: _plain_bits(train[x], t, langid.ORDER) for x in sorted(scripts)}
        best = min(bits, key=bits.get)
        assert out[i]["lang_pred"] == best
        assert out[i]["score"] == pytest.approx(1 / sum(2 ** (-(b - bits[best]) / langid.SOFTEN) for b in bits.values()), rel=1e-4)
        assert out[i]["bits_per_byte"] == pytest.approx(bits[best] / len(t.encode()), rel=1e-4)
    held = [(i, x) for i, _, x in rows if x and out[i]["held_out"] and out[i]["lang_pred"] != "und"]
    assert held and all(out[i]["lang_pred"] == x for i, x in held)


def test_language_stage_rejects_by_its_code_lengths(spark):
    """Texts that no language's code shortens go, null languages are named; without training rows lettered texts stay."""
    from tidelark.llm import langid

    rows = [(i, "the cat sat on the mat and the dog ran " * 3, "en", 5) for i in range(40)]
    rows += [(50, "the dog and the cat", None, 5), (51, "ωψχφυτσρποξνμλκ", None, 5), (52, "12 34", "en", 5), (53, None, None, 5)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, _0 int")
    out = {r["doc_id"]: r for r in langid.with_language(d).collect()}
    assert set(out) == {*range(40), 50} and out[50]["lang"] == "en" and out[50]["_0"] == 5
    untaught = d.withColumn("lang", F.lit(None).cast("string"))
    assert {r["doc_id"] for r in langid.with_language(untaught).collect()} == {*range(40), 50, 51}


# -- op2 --------------------------------------------------------------------------------------------------------------


def _simhash(t):
    words = re.findall("[^\x20\x09-\x0d]+", low(t))
    if not words:
        return 0
    sh = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    votes = [0] * 64
    for s in sh:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if votes[b] * 2 > len(sh))


def _near_components(rows):
    fp = np.array([_simhash(t) for _, t in rows], dtype=np.uint64)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in np.nonzero(np.bitwise_count(fp[i] ^ fp) <= 3)[0]:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, format(int(fp[i]), "016x"), least[find(i)]) for i, (d, _) in enumerate(rows))


def near_texts(n, seed=1):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(60)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(60)] = f"z{rng.randrange(9)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [4096, 48])
def test_simhash_components(spark, monkeypatch, block):
    from tidelark.llm import simhash

    monkeypatch.setattr(simhash, "BLOCK", block)
    texts = [*near_texts(300), "", "  ", "a", "a b", "A\tb\nc d", "x"]
    got = sorted(map(tuple, simhash.near_duplicates(docs(spark, texts)).collect()))
    assert got == _near_components(list(enumerate(texts)))
    kept = simhash.one_per_group(docs(spark, texts)).select("doc_id").collect()
    assert {r["doc_id"] for r in kept} == {x[2] for x in got} and len(kept) == len({x[2] for x in got})


@pytest.mark.parametrize("block", [2048, 16])
def test_near_dedup_takes_copies_of_four_fifths(spark, monkeypatch, block):
    import corpus_pipeline
    from tidelark.llm import nearcopies

    monkeypatch.setattr(nearcopies, "BLOCK", block)
    rng = random.Random(6)
    fresh = iter(range(10**6))
    texts = [" ".join(f"v{next(fresh)}" for _ in range(rng.choice([60, 140, 300]))) for _ in range(60)]
    planted = 0
    for t in texts[:60]:
        for edits in (1, 2, 3, 4):
            w = t.split()
            for at in rng.sample(range(len(w)), edits):
                w[at] = f"v{next(fresh)}"
            texts.append(" ".join(w))
    # a large group: copies of one text that are not all copies of one another
    texts += [" ".join(w[:i] + [f"v{next(fresh)}"] + w[i + 1 :]) for w in [texts[0].split()] for i in range(len(w))]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for t in texts for w in [t.split()]]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            share = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            if share >= 0.8:
                planted += share < 0.95
                a, b = group[i], group[j]
                group = [min(a, b) if g == max(a, b) else g for g in group]
    assert planted > 100 and len(set(group)) > 60
    got = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs(spark, texts), "").select("doc_id").collect()]
    assert sorted(got) == sorted(set(group))
    odd = docs(spark, [*ODD, "a", "some words of a text here"])
    assert nearcopies.one_per_group(odd).count() == len(ODD) - 3 + 1 and nearcopies.one_per_group(odd.limit(0)).count() == 0


def _partition(n, pairs):
    group = list(range(n))
    for a, b in pairs:
        x, y = sorted((group[a], group[b]))
        group = [x if g == y else g for g in group]
    return group


@pytest.mark.parametrize("sides", [False, True])
def test_wide_fingerprints_in_tiles(monkeypatch, sides):
    """Votes and tiles of the near-dedup's fingerprints against plain ones."""
    from tidelark.llm import nearcopies

    hashes = nearcopies.shingles(" ".join(f"w{i}" for i in range(700)))
    votes = [0] * 256
    for h in hashes.tolist():
        for w in range(4):
            x = (h + w * 0x9E3779B97F4A7C15) % 2**64
            for by in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
                x = (x ^ x >> 33) * by % 2**64
            x ^= x >> 33
            for b in range(64):
                votes[64 * w + b] += x >> b & 1
    bits = sum(1 << b for b in range(256) if votes[b] * 2 > len(hashes))
    assert nearcopies.fingerprint(hashes).tolist() == [bits >> 64 * w & 2**64 - 1 for w in range(4)]

    monkeypatch.setattr(nearcopies, "TILE", 8)
    rng = random.Random(8)
    made = []
    for _ in range(120):
        seed = rng.getrandbits(256)
        for flips in (20, 60, 90):
            made.append((seed ^ sum(1 << b for b in rng.sample(range(256), flips)), rng.choice([4, 5, 8, 9, 10, 40, 48, 60])))
        made.append((seed, rng.choice([4, 5, 9, 40])))
    fps = np.array([[f >> 64 * w & 2**64 - 1 for w in range(4)] for f, _ in made], dtype=np.uint64)
    n, side = np.array([k for _, k in made]), np.array([rng.random() < 0.5 for _ in made]) if sides else None
    pairs = []
    for i, (f, k) in enumerate(made):
        for j, (g, m) in enumerate(made[:i]):
            x, less, more = f ^ g, min(k, m), max(k, m)
            most, first = (80, 64) if less == 4 else (70, 25)
            may = 5 * less >= 4 * more and (k != m or k > 8) and (not sides or side[i] != side[j])
            if may and x.bit_count() <= most and (x & 2**64 - 1).bit_count() <= first:
                pairs.append((i, j))
    order, root = nearcopies.tiled_links(fps, n, side)
    want = _partition(len(made), pairs)
    got = _partition(len(made), [(order[i], order[r]) for i, r in enumerate(root)])
    assert len(pairs) > 5 and got == want


def test_keys_hold_the_stated_misses():
    """Pairs of sets at 0.8 are within the radius and share a key."""
    from tidelark.llm import nearcopies

    rng = np.random.default_rng(3)
    for both, a, b in ((4, 0, 1), (12, 1, 2), (48, 6, 6)):
        settings = nearcopies.SMALL if both == 4 else nearcopies.LARGE
        of = nearcopies.key_bits(8)[: nearcopies.keys_needed(8, settings)]
        for _ in range(1000):
            h = rng.integers(0, 2**64, both + a + b, dtype=np.uint64)
            x = nearcopies.fingerprint(h[: both + a]) ^ nearcopies.fingerprint(np.append(h[:both], h[both + a :]))
            bits = np.unpackbits(x.view(np.uint8), bitorder="little")
            assert bits.sum() <= settings.radius and bits[:64].sum() <= settings.first and not bits[of].any(axis=1).all()


@pytest.mark.parametrize("full", [32768, 8])
def test_near_dedup_gets_its_rows_by_fingerprints(spark, monkeypatch, full):
    """SimHashes connect what the stage then checks; without their links, only equal sets are copies."""
    import corpus_pipeline
    from tidelark.llm import nearcopies, simhash

    monkeypatch.setattr(nearcopies, "FULL", full)
    fresh = iter(range(10**6))
    base = [[f"v{next(fresh)}" for _ in range(60)] for _ in range(8)]
    texts = [" ".join(w[:at] + [f"v{next(fresh)}"] + w[at + 1 :]) for w in base for at in (0, 30)] + ["a b c d e f g h", "a b c d e f g h i"]
    d = docs(spark, [*texts, texts[0]])
    prints = nearcopies.signatures(simhash.named_rows(d)[0]).dropDuplicates(["node"]).cache()
    name = {r["node"]: r["doc_id"] % len(texts) for r in prints.collect()}
    got = _partition(len(texts), [(name[r["fp"]], name[r["root"]]) for r in nearcopies.fingerprint_links(prints).collect()])
    assert got == [i // 2 * 2 for i in range(len(texts))]
    kept = corpus_pipeline.near_dedup(spark, d, "").select("doc_id").collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(0, len(texts), 2))
    monkeypatch.setattr(nearcopies, "fingerprint_links", lambda nodes: nodes.select(nodes["node"].alias("fp"), nodes["node"].alias("root")).limit(0))
    assert corpus_pipeline.near_dedup(spark, d, "").count() == len(texts)


@pytest.mark.parametrize("aim", [512, 0.5, 1e-5])
def test_links_by_any_number_of_bands(spark, monkeypatch, aim):
    """Keys of one band and of several: all links within the radius, and no others, at every block size."""
    from tidelark.llm import simhash

    monkeypatch.setattr(simhash, "AIM", aim)
    rng = random.Random(6)
    seeds = [rng.getrandbits(64) for _ in range(60)]
    fps = {s ^ sum(1 << b for b in rng.sample(range(64), k)) for s in seeds for k in (0, 1, 2, 3, 4, 5)}
    links = simhash.near_links(spark.createDataFrame([(f - (1 << 64) if f >= 1 << 63 else f,) for f in fps], "fp long")).collect()
    root = {f: f for f in fps}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for r in links:
        a, b = top(r["fp"] % (1 << 64)), top(r["root"] % (1 << 64))
        root[max(a, b)] = min(a, b)
    want = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= 3 and want[b] < want[a]:
                    want[a], changed = want[b], True
    assert {f: top(f) for f in fps} == want


# -- op4 --------------------------------------------------------------------------------------------------------------


def _repeats(rows):
    first, inf = {}, float("inf")
    raw = [(inf if d is None else d, d, (t or "").encode()) for d, t in rows]
    for k, _, b in raw:
        for i in range(len(b) - 49):
            first[b[i : i + 50]] = min(k, first.get(b[i : i + 50], inf))
    out = []
    for k, d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < k:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, y in zip(b, gone) if not y)
        out.append((d, len(b), sum(gone), sum(1 for i in range(len(gone)) if gone[i] and (not i or not gone[i - 1])), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [1000, 4])
def test_repeated_passages(spark, monkeypatch, most):
    from tidelark.llm import substrings

    monkeypatch.setattr(substrings, "BUCKET_BYTES", 20_000)
    rng = random.Random(5)
    words = ["ab", "c", "déf", "the", "x" * 20]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [*(make(25) for _ in range(6)), "a" * 300]
    rows = [(i, make(rng.randint(0, 30)) + rng.choice(["", " ", "\n"]) + rng.choice(passages) + make(rng.randint(0, 20))) for i in range(150)]
    rows += [(None, passages[0]), (3, passages[1]), (3, passages[1]), (900, None), (901, ""), (902, "a" * 200), (1, "a" * 90 + "b" + "a" * 90)]
    got = substrings.repeat_digests(spark.createDataFrame(rows, "doc_id long, text string"), most=most)
    assert sorted(map(tuple, got.collect()), key=str) == _repeats(rows)


def test_passages_of_frequent_grams_and_long_texts(spark, monkeypatch):
    """A line that every document has is dealt string by string from the start; a text of over SLICE bytes is read in pieces."""
    from tidelark.llm import substrings

    monkeypatch.setattr(substrings, "SAMPLE_OF", 1)
    monkeypatch.setattr(substrings, "SEEN", 20)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 50_000)
    rng = random.Random(9)
    make = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    line = "All rights reserved; see the licence of this work for what you may do with it."
    rows = [(i, make(rng.randint(0, 60)) + line + make(rng.randint(0, 60))) for i in range(120)]
    long = make(substrings.SLICE + 5000)
    rows += [(500, long[: substrings.SLICE - 30]), (400, long), (600, long[substrings.SLICE - 200 : substrings.SLICE + 200]), (None, line)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = d.select("text", F.col("doc_id").alias("doc"))
    assert len(substrings.frequent_grams(keyed))
    assert sorted(map(tuple, substrings.repeat_digests(d).collect()), key=str) == _repeats(rows)


def test_suffix_arrays(monkeypatch):
    from tidelark.llm import suffixes

    rng = np.random.default_rng(0)
    for trial in range(150):
        text = np.append(np.tile(rng.integers(1, 4, 7), 20) if trial % 3 == 0 else rng.integers(1, 2 + trial % 4, rng.integers(1, 400)), 0)
        monkeypatch.setattr(suffixes, "SPARSE", 1 if trial % 2 else 3)
        raw = text.astype(np.uint8).tobytes()
        order = suffixes.suffix_array(text)
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        common = suffixes.permuted_lcp(text, order, np.array([0]), 2000)
        for a, b in zip(order[1:], order[:-1]):
            x, y = raw[a:], raw[b:]
            assert common[a] == next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def test_row_ids_are_those_of_sql(spark):
    from tidelark.llm.substrings import row_ids

    rows = [(1, 2), (-5, 4_000_000_000), ((1 << 63) - 1, 0)]
    got = [r[0] for r in spark.createDataFrame(rows, "a long, b long").select(F.xxhash64("a", "b")).collect()]
    assert got == row_ids(np.array([a for a, _ in rows]), np.array([b for _, b in rows])).tolist()


# -- op5 --------------------------------------------------------------------------------------------------------------


def _leaks(rows, items):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = {}
    for i, t in items:
        w = word.findall(low(t))
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add("" if i is None else str(i))
    out = []
    for d, t in rows:
        w, hit, names = word.findall(low(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    names |= found
                    hit |= set(range(k, k + n))
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [8 << 20, 100])
def test_contamination(spark, monkeypatch, chunk):
    from tidelark.llm import decontam

    monkeypatch.setattr(decontam, "CHUNK_BYTES", chunk)
    rng = random.Random(3)
    vocab = ["a", "bb", "Éa", "x1", "the", "9"]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 40))) + rng.choice(["", ".", "\n", "é"])) for i in range(150)] + [(None, None), (7, ""), (8, "   ")]
    items = [(1, "a bb the"), (2, "the"), (3, ""), (4, None), (None, "x1 x1"), (5, " ".join(rng.choice(vocab) for _ in range(14))), (6, rows[3][1]), (2, "a a a a a")]
    got = decontam.contamination(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r)[:6] for r in got.collect()), key=str) == _leaks(rows, items)


def test_spans_are_cut_from_texts(spark):
    from tidelark.llm import decontam

    d = docs(spark, ["Keep me. ONE two Three, four! Keep too.", "clean"])
    bench = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    out = [r["text"] for r in decontam.decontaminated(d, bench).orderBy("doc_id").collect()]
    assert out == ["Keep me. ! Keep too.", "clean"]


# -- op6, op9: the libraries -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(1)
    alphabet = [*map(chr, range(0x250)), "̀", "́", " ", "　", "’", "﻿", "​", "<|endoftext|>", "'s", "▁"]
    return [t or "" for t in ODD] + ["".join(rng.choice(alphabet) for _ in range(30)) for _ in range(400)] + ["".join(rng.choice("abcdefghij  '<|!?é\n") for _ in range(40)) for _ in range(300)]


def test_token_counts_are_the_librarys(spark, odd_texts):
    from tidelark.llm.token_counts import PrefixBpe, default_path, token_counts

    bpe = PrefixBpe(default_path())
    want = [len(bpe.library.encode(t, add_special_tokens=False).ids) for t in odd_texts]
    assert [r["n_tokens"] for r in token_counts(docs(spark, odd_texts)).orderBy("doc_id").collect()] == want
    for t in [x[:120] for x in odd_texts[:12] + odd_texts[-60:]]:
        table = bpe.table(t)
        for p in range(len(t) + 1):
            assert table.count_at(p) == len(bpe.library.encode(t[:p], add_special_tokens=False).ids)
    long = "word " * 3000
    row = token_counts(docs(spark, [long])).first()
    assert row["over_limit"] and bpe.count(long[: row["fit_chars"]]) <= 2048 < bpe.count(long[: row["fit_chars"] + 6])


def test_prefixes_that_fit_a_budget(spark, odd_texts):
    """In any script, and for long texts: the longest prefix that ends with a word and holds the budget."""
    from tidelark.llm.token_counts import PrefixBpe, default_path, token_counts

    bpe = PrefixBpe(default_path())
    count = lambda t: len(bpe.library.encode(t, add_special_tokens=False).ids)
    for t in [*odd_texts[:200:7], "日本 hello world " * 40, "Ελλάδα и мир cafe\u0301 İs " * 30]:
        table = bpe.table(t)
        assert table.total == count(t)
        for budget in (0, 1, 7, 40):
            p = table.fit(budget)
            assert p == bpe.table(t, budget).fit(budget) and count(t[:p]) <= budget
            after = next((e for e in table.ends if e > p), None)
            assert p == len(t) or after is None or count(t[:after]) > budget
    long = "日 hello мир word, " * 50_000  # 1.2 MB
    text = long + "xyz" * 10_000
    rows = {r["doc_id"]: r for r in token_counts(docs(spark, [long, text])).collect()}
    for i, t in enumerate([long, text]):
        p = rows[i]["fit_chars"]
        assert rows[i]["n_bytes"] == len(t.encode()) and count(t[:p]) <= 2048 < count(t[: p + 12])
    assert rows[0]["n_tokens"] == count(long)


def test_piece_codec_is_the_librarys(spark, odd_texts):
    from tidelark.llm.piece_codec import PieceCodec, default_path, encode_digests, encode_pieces

    codec = PieceCodec(default_path())
    got = encode_digests(docs(spark, odd_texts)).orderBy("doc_id").collect()
    for t, r in zip(odd_texts, got):
        ids = codec.library.encode(t, add_eos=True)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(codec.library.decode(ids)))
    for r in encode_pieces(docs(spark, odd_texts[:40])).orderBy("doc_id").collect():
        raw = odd_texts[r["doc_id"]].encode()
        assert r["starts"] == sorted(r["starts"]) and b"".join(raw[s:e] for s, e in zip(r["starts"], r["ends"])) == raw


def test_digests_cover_the_source_spans(spark, odd_texts, monkeypatch):
    from tidelark.llm.piece_codec import PieceCodec, default_path, encode_digests, encode_pieces

    texts = [*odd_texts, "▁a ▁ b▁▁c  d ", " lead", "▁", "^a ^b"]
    want = {r["doc_id"]: r for r in encode_pieces(docs(spark, texts)).collect()}
    for r in encode_digests(docs(spark, texts)).collect():
        w = want[r["doc_id"]]
        assert r["n_tokens"] == len(w["ids"]) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, w["ids"])).encode()).hexdigest()
        assert r["spans_sha256"] == hashlib.sha256(np.array([*w["starts"], *w["ends"]], dtype="<i8").tobytes()).hexdigest()
    # a model with a character map goes through the longest-prefix matching
    codec, met = PieceCodec(default_path()), []
    longest = type("Map", (), {"longest": lambda self, data, at: met.append(at)})()
    monkeypatch.setattr(codec, "char_map", longest)
    whole = codec.round_trips(["some text"])[0]
    codec.apart = False
    again = codec.round_trips(["some text"])[0]
    assert met and whole[:3] == again[:3] and whole.starts.tolist() == again.starts.tolist() and whole.ends.tolist() == again.ends.tolist()


def test_longest_prefix_of_a_character_map():
    import struct

    from tidelark.llm.piece_codec import CharMap

    # a double array that holds the one key "a" -> "b"
    units = [0] * 512
    units[0] = 256 << 10
    units[256 ^ ord("a")] = ord("a") | 1 << 8 | (1 << 10)
    units[(256 ^ ord("a")) ^ 1] = 0x80000000
    blob = struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + b"b\0"
    assert CharMap(blob).longest(b"ab", 0) == (1, b"b") and CharMap(blob).longest(b"xa", 0) is None


# -- op8, op10 --------------------------------------------------------------------------------------------------------


def test_hilbert_steps_are_neighbours():
    from tidelark.llm.sharding import hilbert_index

    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), axis=-1).reshape(-1, 3)
    index = hilbert_index(grid, 3)
    path = grid[np.argsort(index)]
    assert sorted(index) == list(range(512)) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shards_differ_by_one_row_at_most(spark):
    from tidelark.llm.sharding import hilbert_shards

    d = docs(spark, [f"text {i % 7}" for i in range(101)] + [None])
    out = hilbert_shards(d).toPandas()
    n = out.groupby("shard")["slot"].agg(["count", "min", "max", "nunique"])
    assert len(n) == 8 and n["count"].max() - n["count"].min() <= 1
    assert (n["min"] == 0).all() and (n["max"] == n["count"] - 1).all() and (n["nunique"] == n["count"]).all()
    assert sorted(out["doc_id"]) == list(range(102)) and out.set_index("doc_id").loc[101, ["size", "text_crc32"]].tolist() == [1, 0]


def test_shards_follow_the_curve_and_prune(spark):
    """Every row's place against a plain sort by cells, curve, checksum and id; shards hold few values of a dimension."""
    from tidelark.llm.sharding import hilbert_index, hilbert_shards

    rng = random.Random(3)
    rows = [(i, "x" * rng.randint(0, 3) or None, rng.choice(["en", "de", None]), rng.choice("abcdefgh"), rng.choice([None, 0, 5, 900, 70_000])) for i in range(300)] + [(None, "y", "en", "a", 5), (7, "t", "en", "a", 5)]
    out = hilbert_shards(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    bits, top = 8, 255
    text_cell = lambda v: 0 if v is None else crc32(v.encode()) % top + 1
    number_cell = lambda v: 0 if v is None else min(top, int(np.log2(max(v, 0) + 1) * (top // 48)) + 1)
    cells = np.array([[text_cell(r[2]), text_cell(r[3]), number_cell(r[4])] for r in rows])
    curve = hilbert_index(cells, bits).tolist()
    crc = [crc32((r[1] or "").encode()) if r[1] is not None else 0 for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (curve[i], crc[i], rows[i][0] is not None, rows[i][0] or 0))
    n = len(rows)
    want = [(rows[i][0], len(rows[i][1] or "") + 1, crc[i], at * 8 // n, at + -(-(at * 8 // n) * n // 8), curve[i]) for at, i in enumerate(order)]
    got = sorted(out, key=lambda r: (r["shard"], r["slot"]))
    assert [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["curve"]) for r in got] == [(a, b, c, d, f) for a, b, c, d, _, f in want]
    assert [r["slot"] for r in got] == [k for s in range(8) for k in range(sum(w[3] == s for w in want))]
    # a reader of one source opens fewer shards than rows dealt at random would need
    by_source = {s: {r["shard"] for r in got if r["doc_id"] is not None and rows[r["doc_id"]][3] == s} for s in "abcdefgh"}
    assert sum(map(len, by_source.values())) < 8 * 8 * 0.75


def test_topk_against_all_pairs(spark):
    from tidelark.llm.topk import exact_topk

    rng = np.random.default_rng(2)
    vectors = [(i, rng.normal(size=6).round(1).tolist()) for i in range(400)] + [(i, [1.0] * 6) for i in range(400, 460)]
    bad = [(1000, None), (1001, [1.0, None] + [0.0] * 4), (1002, [float("nan")] * 6), (None, [1.0] * 6), (1020, [float("inf")] * 6), (1040, [])]
    out = exact_topk(spark.createDataFrame(vectors + bad, "vec_id long, embedding array<double>"))
    got = sorted(map(tuple, out.collect()))
    ints = {i: np.floor(64 * np.array(v)).astype(int) for i, v in vectors}
    want = []
    for q in ints:
        if q % 20 == 0:
            best = sorted((-int(ints[q] @ ints[i]), i) for i in ints if i != q)[:20]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_topk_of_odd_rows(spark, monkeypatch):
    """Repeated ids (valid, invalid and equal rows), ties, several rounds of queries, an empty table, clashing names."""
    from tidelark.llm import topk

    monkeypatch.setattr(topk, "QUERY_BYTES", 300)
    schema = "vec_id long, embedding array<double>, id int, v string, score string, kth int"
    rows = [(20, [None, 1.0]), (20, [1.0, 1.0]), (20, [1.0, 1.0]), (20, [0.5, 2.0]), (40, [1.0, 1.0]), (60, [-1.0, 0.25, 3.0])]
    rows += [(i, [float(i % 3), 1.0]) for i in range(100, 160)] + [(20, None), (80, []), (120, [3.0, 3.0])]
    d = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], schema).repartition(3)
    out = topk.exact_topk(d)
    ints = [(i, np.floor(64 * np.array([*v, *[0.0] * (3 - len(v))])).astype(int)) for i, v in rows if v and None not in v]
    for q in (20, 40, 60, 100, 120, 140):
        got = [(r["score"], r["vec_id"]) for r in out.filter(out["query_id"] == q).orderBy("rank").collect()]
        own = [v for i, v in ints if i == q]
        wants = []
        for mine in own:
            scores = sorted((-int(mine @ v), i) for i, v in ints)
            scores.remove((-int(mine @ mine), q))
            wants.append([(-s, i) for s, i in scores[:20]])
        assert got in wants, q
    assert out.count() == 120 and out.select("query_id", "rank").distinct().count() == 120
    assert topk.exact_topk(d.limit(0)).count() == 0


# -- registered queries and the pipeline ------------------------------------------------------------------------------


@pytest.mark.parametrize("name", QUERY)
def test_registered(spark, name):
    import __spark_entry__

    out = __spark_entry__.queries()[name](spark, SF)
    assert out.count() > 0


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(4)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, item = make(30), make(14)
    texts = [make(60) for _ in range(40)] + [make(30) + " " + shared + " " + make(30) for _ in range(3)] + [make(20) + " " + item + " " + make(20)] + ["123 456", None, ""]
    texts += [texts[0], texts[0], texts[1]]
    d = docs(spark, texts)
    d.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(i, t) for i, t in enumerate(texts) if t and any(c.isalpha() for c in t)]
    keep = {c for _, _, c in _near_components(rows)}
    rows = [(i, t) for i, t in rows if i in keep]
    removed = {r[0]: r for r in _repeats(rows)}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == keep and removed[41][2] > 0 and removed[40][2] == 0
    docs_now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs_now = stage(spark, docs_now, str(tmp_path))
        assert docs_now.columns == d.columns, name
    left = {r["doc_id"]: r["text"] for r in docs_now.collect()}
    for r in removed.values():
        assert hashlib.sha256(left[r[0]].encode()).hexdigest() == r[4] or item in dict(rows)[r[0]]
    assert item not in left[43]
    from tidelark.llm.piece_codec import PieceCodec, default_path

    codec = PieceCodec(default_path())
    assert all(got[i]["n_tokens"] == len(codec.library.encode(t, add_eos=True)) for i, t in left.items())
