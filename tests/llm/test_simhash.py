from __future__ import annotations

import random
from collections import Counter

import numpy as np
import xxhash

from ridemill.llm import near_dedup, simhash as op
from ridemill.llm.components import components

from . import cases


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {n: find(n) for n in nodes}


def fingerprint(text, words_each):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + words_each]) for i in range(len(words) - words_each + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_components_of_documents(spark):
    base = cases.prose(1, 300)
    texts = cases.odd_texts()[:-2] + [(50 + i, base.replace("the", f"the{i}", 1)) for i in range(12)]
    texts = [(d, t) for d, t in texts if d is not None]
    codes = {d: fingerprint(t, 3) for d, t in texts}
    ids = sorted(codes)
    wanted = roots(ids, [(a, b) for a in ids for b in ids if a < b and (codes[a] ^ codes[b]).bit_count() <= 2])
    found = op.simhash_components(cases.table(spark, texts)).collect()
    assert len(found) == len(texts)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {(d, f"{codes[d]:016x}", wanted[d]) for d in ids}


def test_anchors_lose_no_close_pair(spark):
    rnd = random.Random(2)
    codes = {0, (1 << 64) - 1}
    for _ in range(60):
        code = rnd.getrandbits(64)
        codes.add(code)
        for bits in (1, 2, 3, 3, 4):
            codes.add(code ^ sum(1 << b for b in rnd.sample(range(64), bits)))
    frame = spark.createDataFrame([(signed(c),) for c in codes], "fingerprint long")
    for bits in (2, 3):
        wanted = {tuple(sorted((signed(a), signed(b)))) for a in codes for b in codes if a < b and (a ^ b).bit_count() <= bits}
        assert {(r.a, r.b) for r in op.close_pairs(frame, bits).collect()} == wanted


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, -3), (5, 5), (160, 100), (None, 4)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {7: -3, -3: -3} | dict.fromkeys(range(100, 161), 100)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_dedup_equals_brute_force(spark):
    rnd = random.Random(9)
    texts = []
    for i in range(30):
        words = cases.prose(i, rnd.randint(60, 300), 2000).split()
        for copy in range(rnd.randint(1, 6)):
            own = list(words)
            for place in rnd.sample(range(len(own)), len(own) // rnd.choice((15, 30, 60, 120))):
                own[place] = f"new{rnd.random()}"
            texts.append((10 * i + copy, " ".join(own)))
    texts += [(2000, None), (2001, ""), (None, texts[0][1]), (2002, "short text"), (2003, "short text")]
    sets = {d: set(op.shingle_hashes(t.encode(), 5).tolist()) for d, t in texts if d is not None and t}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    wanted = roots(list(sets), links)
    gone = {d for d, root in wanted.items() if d != root}
    assert len(gone) > 10
    docs = cases.table(spark, texts)
    left = near_dedup.near_dedup(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted((d for d, _ in texts if d not in gone), key=repr)


def test_empty_table(spark):
    assert op.simhash_components(cases.table(spark, [])).collect() == []
    assert near_dedup.near_dedup(cases.table(spark, [])).collect() == []


def near_brute(texts):
    sets = {d: set(op.shingle_hashes(t.encode(), 5).tolist()) for d, t in texts}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    return sorted(d for d, root in roots(list(sets), links).items() if d == root)


def test_near_dedup_settles_hot_buckets(spark):
    """Similar documents whose equal groups of shingles all lie in a passage that others have too."""
    passage = [f"hot{i}" for i in range(24)]

    def parts(text):
        return set(near_dedup.part_fingerprints(np.unique(op.shingle_hashes(text.encode(), 5)), near_dedup.SIMILARITY).tolist())

    pairs = []
    for i in range(2500):
        own = [f"own{i}x{k}" for k in range(10)]
        pairs.append((" ".join(passage + own), " ".join([*passage, *own[:-3], *(f"end{i}x{k}" for k in range(3))])))
    seen = Counter(p for one, _ in pairs for p in parts(one))
    alone = [(one, other) for one, other in pairs if all(seen[p] > 50 for p in parts(one) & parts(other))][:40]
    texts = list(enumerate(text for pair in alone for text in pair))
    left = near_dedup.near_dedup(cases.table(spark, texts)).collect()
    wanted = near_brute(texts)
    assert len(wanted) == 40
    assert sorted(r.doc_id for r in left) == wanted


def test_near_dedup_of_short_documents(spark):
    """One or two words changed at the end: often no group of shingles stays equal."""
    texts = []
    for i in range(60):
        for k, (words, changed) in enumerate(((13, 1), (22, 2), (23, 2))):
            own = [f"s{i}x{k}x{w}" for w in range(words)]
            texts.append((10 * i + 2 * k, " ".join(own)))
            texts.append((10 * i + 2 * k + 1, " ".join([*own[:-changed], *(f"end{w}" for w in range(changed))])))
    left = near_dedup.near_dedup(cases.table(spark, texts)).collect()
    wanted = near_brute(texts)
    assert len(wanted) == 180
    assert sorted(r.doc_id for r in left) == wanted


def test_fingerprints_of_parts_are_simhashes_of_groups():
    for size in (0, 1, 2, 3, 7, 40, 300, 3000):
        hashes = np.unique(np.random.default_rng(size).integers(0, 1 << 64, size, np.uint64))
        wanted = []
        level = max(0.0, np.log2(max(1, len(hashes)) / near_dedup.GROUP_SHINGLES))
        for power in {int(level), int(level - np.log2(near_dedup.SIMILARITY))}:
            for number in range(near_dedup.PARTS):
                own = hashes[hashes & np.uint64((1 << power) - 1) == number]
                if len(own):
                    wanted.append((op.simhash(own) ^ (power * near_dedup.PARTS + number + 1) * near_dedup.MIX_PART) & 0xFFFFFFFFFFFFFFFF)
        found = near_dedup.part_fingerprints(hashes, near_dedup.SIMILARITY).view(np.uint64)
        assert sorted(found.tolist()) == sorted(wanted)


def test_marks_never_part_similar_sets_and_part_most_others():
    rnd = np.random.default_rng(4)
    parted = others = 0
    for size in (1, 5, 12, 63, 64, 65, 130, 700, 5000):
        for share in (0.0, 0.3, 0.6, 0.75, 0.8, 0.82, 0.9, 1.0):
            for _ in range(20):
                hashes = np.unique(rnd.integers(0, 1 << 64, 2 * size, np.uint64))
                rnd.shuffle(hashes)
                both, rest = hashes[: round(share * size)], hashes[round(share * size) : size]
                cut = int(rnd.integers(0, len(rest) + 1))
                one, other = np.concatenate([both, rest[:cut]]), np.concatenate([both, rest[cut:]])
                found = near_dedup.may_be_similar(len(one), near_dedup.mark(one), len(other), near_dedup.mark(other))
                if len(both) >= near_dedup.SIMILARITY * size:
                    assert found
                elif share <= 0.6 and size >= 12:
                    others, parted = others + 1, parted + (not found)
    assert parted > 0.95 * others > 0


def test_near_dedup_gathers_texts_only_of_pairs_that_may_be_similar(spark, monkeypatch):
    """Documents that share a long passage are candidates of each other, and none is similar."""
    passage = [f"hot{i}" for i in range(60)]
    texts = [(i, " ".join(passage + [f"own{i}x{k}" for k in range(80)])) for i in range(60)]
    texts += [(100 + i, f"{text} end") for i, text in texts[:5]]
    compared, confirmed = [], near_dedup.confirmed
    monkeypatch.setattr(near_dedup, "confirmed", lambda t, p: compared.extend(map(tuple, p.collect())) or confirmed(t, p))
    left = near_dedup.near_dedup(cases.table(spark, texts)).collect()
    assert sorted(r.doc_id for r in left) == near_brute(texts) == list(range(60))
    assert sorted(compared) == [(i, 100 + i) for i in range(5)]


def test_near_dedup_with_clashing_names_and_repeated_ids(spark):
    base = cases.prose(7, 200)
    rows = [(1, base, 1, "x"), (2, base + " more", 2, "x"), (2, base + " more", 2, "x"), (3, None, 3, None), (None, base, 4, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone_id int, row string")
    assert sorted(r.gone_id for r in near_dedup.near_dedup(docs).collect()) == [1, 3, 4]
