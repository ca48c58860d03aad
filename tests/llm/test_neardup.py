"""The pipeline's near-dedup against all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from cellstrata.llm import neardup, simhash


def near_texts(seed=9, groups=25):
    """Bases with copies in which a few single words are changed, at similarities around 0.8 and above."""
    r = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{r.randrange(3000)}" for _ in range(r.randrange(60, 260))]
        out.append(base)
        for _ in range(4):
            own = list(base)
            for _ in range(r.randrange(1, 2 + len(own) // 30)):
                own[r.randrange(len(own))] = f"x{r.randrange(10**6)}"
            out.append(own)
    r.shuffle(out)
    return [" ".join(w) for w in out]


def plain_shingles(t):
    w = t.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_groups(texts):
    sets, root = [plain_shingles(t or "") for t in texts], list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = [low if x == high else x for x in root]
    return root


def test_near_copies_are_found_at_similarity_0_8(spark):
    texts = near_texts()
    root = plain_groups(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert kept == sorted(set(root)) and len(kept) < 0.6 * len(texts)
    assert simhash.keep_one(docs).count() > len(kept) + 20  # the op6 contract's 4 bits leave most copies in


def test_rows_of_one_doc_id_with_other_texts_stay(spark):
    rows = [(1, "one text of its own"), (1, "quite another thing altogether here"), (1, "one text of its own"), (None, "a null id stands for a document"), (None, "a second null id"), (2, None), (3, " \n"), (4, "One  text of its OWN")]
    kept = neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted((a or 0, b or "") for a, b in [rows[0], rows[1], rows[3], rows[4], rows[5]])


def test_linked_reaches_through_others():
    texts = near_texts(3, 6)
    assert neardup.linked([neardup.shingles(t) for t in texts]).tolist() == plain_groups(texts)


def test_large_groups_are_split_and_searched_alike(spark, monkeypatch):
    texts = near_texts(5, 6) + near_texts(6, 1) * 3
    monkeypatch.setattr(neardup, "GROUP_SETS", 3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert kept == sorted(set(plain_groups(texts)))


def test_a_key_that_all_sets_share_is_searched_in_blocks(spark, monkeypatch):
    texts = near_texts(7, 8)
    monkeypatch.setattr(neardup, "GROUP_SETS", 7)
    for rounds in (0, 2):  # with none, all pairs are left to the blocks
        monkeypatch.setattr(neardup, "ROUNDS", rounds)
        rows = spark.createDataFrame(list(enumerate(texts)), "node long, __text string")
        keys = rows.selectExpr("node", "explode(array(1L, 2L, 100 + node % 2)) band")
        found = {r["__node"]: r["__group"] for r in neardup.split_groups(rows, keys).collect()}
        assert [found.get(k, k) for k in range(len(texts))] == plain_groups(texts)


def test_blocks_are_bounded_and_every_pair_of_classes_meets(spark, monkeypatch):
    monkeypatch.setattr(neardup, "GROUP_SETS", 10)
    met = spark.range(60).selectExpr("id node", "1L band", "if(id < 40, 0L, id) label")
    texts = spark.range(60).selectExpr("id node", "'' __text")
    tasks = {}
    for r in neardup.block_pairs(met, texts).collect():
        tasks.setdefault((r.low, r.high), set()).add(r.node)
    meet = {(a, b) for t in tasks.values() for a in t for b in t}
    assert all((a, b) in meet for a in range(60) for b in range(40, 60))
    assert max(map(len, tasks.values())) <= 30


def test_fingerprints_are_majorities_of_mixed_hashes():
    r = np.random.default_rng(1)
    for size in (1, 2, 7, 300, 5000):
        own = np.unique(r.integers(0, 2**64, size, np.uint64))
        h = own[:, None] * neardup._FACTORS
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        want = [sum(1 << b for b in range(64) if 2 * int((h[:, k] >> np.uint64(b) & np.uint64(1)).sum()) > len(own)) for k in range(neardup.PRINTS)]
        assert [p % 2**64 for p in neardup.fingerprints(own)] == want
    assert neardup.fingerprints(own[:0]) == []


@pytest.mark.parametrize("sets, clusters, noise", [(2, 1, 0.02), (400, 130, 0.1), (400, 3, 0.08), (500, 25, 0.14), (900, 1, 0.12)])
def test_balls_meet_all_fingerprints_within_the_radius(sets, clusters, noise, monkeypatch):
    r = np.random.default_rng(sets + clusters)
    flips = np.packbits(r.random((sets, 2, 64)) < noise, axis=2).view(np.uint64)[:, :, 0]
    both = r.integers(0, 2**64, (clusters, 2), np.uint64)[r.integers(0, clusters, sets)] ^ flips
    prints, following = both[:, 0] & np.uint64(2**60 - 1) | np.uint64(5 << 60), both[:, 1].copy()
    root = list(range(sets))
    for a, b in combinations(range(sets), 2):
        own, far = int(prints[a] ^ prints[b]), int(following[a] ^ following[b])
        if (own >> 32).bit_count() <= 4 and own.bit_count() + far.bit_count() <= 34:
            low, high = sorted((root[a], root[b]))
            root = [low if x == high else x for x in root] if low != high else root
    for few, at_once in ((neardup.FEW, neardup.VARIANTS_AT_ONCE), (2, 5_000)):
        monkeypatch.setattr(neardup, "FEW", few)
        monkeypatch.setattr(neardup, "VARIANTS_AT_ONCE", at_once)
        assert neardup.ball_classes(prints, following).tolist() == root


def test_the_stage_takes_candidates_by_ball_hashing(spark):
    texts = near_texts(11, 40)
    keys = neardup.ball_keys(neardup.prints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text"))
    met = {}
    for r in keys.collect():
        met.setdefault(r.band, set()).add(r.node)
    node = {r.key: r.node for r in neardup.prints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text").collect()}
    together = {pair for nodes in met.values() for pair in combinations(sorted(nodes), 2)}
    sets = [plain_shingles(t) for t in texts]
    near = [(a, b) for a, b in combinations(range(len(texts)), 2) if sets[a] != sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    far = [(a, b) for a, b in combinations(range(len(texts)), 2) if not sets[a] & sets[b]]
    assert len(near) > 100 and all(tuple(sorted((node[a], node[b]))) in together for a, b in near)
    assert not any(tuple(sorted((node[a], node[b]))) in together for a, b in far)


def test_pairs_far_below_the_least_similarity_are_not_linked(spark):
    r = random.Random(4)
    words = [f"w{k}" for k in range(200)]
    texts = []
    for _ in range(150):  # at similarities of 0.25 to 0.45 with one another
        own = list(words)
        for at in range(12):
            own[16 * at + r.randrange(16)] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(own))
    near = near_texts(13, 20)
    rows = [(k, t) for k, t in enumerate(texts + near)]
    found = neardup.prints(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    key_of = {x.node: x.key for x in found.collect()}
    met = {}
    for x in neardup.ball_keys(found).collect():
        met.setdefault(x.band, []).append(key_of[x.node])
    sets = [plain_shingles(t) for t in texts + near]
    together = {pair for nodes in met.values() for pair in combinations(sorted(nodes), 2)}
    alike = {(a, b) for a, b in combinations(range(len(sets)), 2) if sets[a] != sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert len(alike) > 50 and alike <= together
    assert not [(a, b) for a, b in together if a < 150]


def test_overlapping_keys_of_a_group_are_dealt_once(spark, monkeypatch):
    monkeypatch.setattr(neardup, "GROUP_SETS", 10)
    r = random.Random(2)
    rows = [(k, 7, band, 0 if k < 40 else k) for band in range(30) for k in range(60) if r.random() < 0.6]
    rows += [(k, 8, 100 + k // 3, k) for k in range(100, 160)]  # small keys, which are dealt one by one
    met = spark.createDataFrame(rows, "node long, root long, band long, label long")
    texts = spark.range(200).selectExpr("id node", "'' __text")
    dealt = neardup.block_pairs(met, texts).collect()
    tasks = {}
    for x in dealt:
        tasks.setdefault((x.band, x.low, x.high), set()).add(x.node)
    meet = {pair for t in tasks.values() for pair in combinations(sorted(t), 2)}
    bands = {}
    for node, _, band, label in rows:
        bands.setdefault(band, {})[node] = label
    want = {(a, b) for b_ in bands.values() for a, b in combinations(sorted(b_), 2) if b_[a] != b_[b]}
    assert want <= meet
    assert len(dealt) <= 40 * 4 + 20 * 12 + 60  # 30 keys one by one make ten times as many
