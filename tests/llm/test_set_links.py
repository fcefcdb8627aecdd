"""Pairs inside the Jaccard join's buckets: sketches lose no link, blocks change no result."""

from __future__ import annotations

import random

import numpy as np
import pytest

from lakegate.llm import jaccard_join, set_links


def _runs(words: list[bytes], n: int) -> set:
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(n)), strict=False))


def _texts(rng: random.Random, count: int, changes: int) -> list[list[bytes]]:
    base = [b"w%d" % rng.randrange(400) for _ in range(120)]
    out = []
    for _ in range(count):
        text = list(base)
        for _ in range(rng.randint(0, changes)):
            text[rng.randrange(len(text))] = b"x%d" % rng.randrange(10_000)
        out.append(text)
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_similar_equals_brute_force(n):
    rng = random.Random(n)
    for _ in range(300):
        a = [bytes([rng.randrange(97, 105)]) for _ in range(rng.randint(0, 60))]
        b = list(a)
        for _ in range(rng.randint(0, 4) if b else 0):
            b[rng.randrange(len(b))] = b"z"
        x, y = _runs(a, n), _runs(b, n)
        assert set_links.similar(a, b, n, 80) == (bool(x & y) and 100 * len(x & y) >= 80 * len(x | y))


def test_no_link_is_lost_by_sketches():
    """Also between sketches of different lengths and beyond the longest sketch."""
    rng = np.random.default_rng(5)
    for size in (3, 60, 64, 65, 130, 1000, 40_000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for share in (0.0, 0.05, 0.1, 0.2):
            b = np.unique(np.concatenate([a, rng.integers(0, 2**63, int(share * size)).astype(np.uint64)]))
            marks = set_links.folded([set_links.sketch(a), set_links.sketch(b)])
            bits = set_links.differing_bits(marks[:1], marks[1:])
            assert bits[0, 0] <= len(b) - len(a)
            if 100 * len(a) >= 80 * len(b):
                sizes = np.array([len(a)]), np.array([len(b)])
                assert set_links.possible(*sizes, bits, 80).all()


def test_a_dense_group_proposes_one_pair_per_member():
    rng = random.Random(3)
    tokens = [jaccard_join.shingles(jaccard_join.word_hashes([b" ".join(t)])[0], 2) for t in _texts(rng, 200, 2)]
    pairs = set_links.forest(list(range(200)), [len(t) for t in tokens], [set_links.sketch(t) for t in tokens], 80)
    assert len(pairs) == len(set(pairs)) == 199 and all(a < b for a, b in pairs)


@pytest.mark.parametrize("block", [3, 512])
def test_blocks_lose_no_link(spark, monkeypatch, block):
    """Copies of one text with up to 14 changes: a few are linked through others only."""
    monkeypatch.setattr(set_links, "BLOCK", block)
    rng = random.Random(11)
    texts = [t for changes in (3, 14, 30) for t in _texts(rng, 25, changes)]
    rows = [(i, b" ".join(t).decode()) for i, t in enumerate(texts)]
    got = jaccard_join.near_components(
        spark.createDataFrame(rows, "doc_id bigint, text string"), jaccard_join.Join(2, 80)
    )
    sets = [_runs(t, 2) for t in texts]
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert len(set(label)) > 5
    assert {(r["doc_id"], r["component_id"]) for r in got.collect()} == set(enumerate(label))


def _near(rng, tokens, join):
    """A set that differs from ``tokens`` in as many tokens as a link allows."""
    drop = (100 - join.percent) * len(tokens) // 100
    swap = (100 - join.percent) * len(tokens) // (100 + join.percent)
    kept = rng.permutation(tokens)
    if rng.random() < 0.5:
        return np.unique(kept[drop:])
    return np.unique(np.concatenate([kept[swap:], rng.integers(0, 2**63, swap).astype(np.uint64)]))


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linked_sets_share_a_key_in_every_scheme(percent):
    """Also where many segments are empty, and where empty keys are left out."""
    rng = np.random.default_rng(percent)
    for _ in range(400):
        join = jaccard_join.Join(5, percent, int(rng.choice(jaccard_join.BAND_STEPS)))
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(2, 90))).astype(np.uint64))
        b = _near(rng, a, join)
        schemes = {}
        for band in range(1, join.band(max(len(a), len(b))) + 1):
            spare = int(rng.integers(0, 12))
            units = join.differing(join.begin(band + 1) - 1) + 1 + spare
            doubled = int(rng.integers(0, units // 2 + 1)) if rng.random() < 0.5 else 0
            schemes[band] = jaccard_join.Scheme(units - doubled, doubled, spare)
        shared = len(np.intersect1d(a, b))
        if not join.band(len(a)) or 100 * shared < percent * (len(a) + len(b) - shared):
            continue
        if not join.band(len(b)):
            assert not np.array_equal(a, b)
            continue
        assert len(np.intersect1d(jaccard_join.keys(a, join, schemes), jaccard_join.keys(b, join, schemes)))


@pytest.mark.parametrize("documents", [1_000, 1_000_000])
def test_the_index_has_fewer_keys_than_tokens_however_many_sets(documents):
    rng = np.random.default_rng(8)
    found = {band: (documents, 1.1 * jaccard_join.Join(5, 80).begin(band)) for band in range(8, 28)}
    cost, schemes = jaccard_join._schemes(found, jaccard_join.Join(5, 80, 3))
    join = jaccard_join.Join(5, 80, 3)
    sets = [np.unique(rng.integers(0, 2**63, int(n)).astype(np.uint64)) for n in rng.uniform(40, 1200, 300)]
    rows = sum(len(jaccard_join.keys(t, join, schemes)) for t in sets)
    assert rows < 0.6 * sum(map(len, sets))
    every = np.concatenate([jaccard_join.keys(t, join, schemes) for t in sets])
    assert len(np.unique(every)) > 0.99 * len(every)


def test_buckets_that_overlap_are_compared_as_one(spark):
    """Near copies (label 0) and others (a label each) in 20 buckets that differ by a member; and two
    buckets of another label that share no other member, which stay apart."""
    rows = [(b, n, 0 if n < 60 else n) for b in range(20) for n in range(90) if n != b]
    rows += [(b, n, 100 if n < 110 else n) for b in (50, 51) for n in [*range(100, 110), b + 100]]
    labelled = spark.createDataFrame(rows, "bucket bigint, node bigint, label bigint")
    opened = [(b, 89, 59, 0) for b in range(20)] + [(b, 11, 10, 100) for b in (50, 51)]
    opened = spark.createDataFrame(opened, "bucket bigint, members bigint, largest bigint, top bigint")
    found: dict[tuple, list[int]] = {}
    for r in set_links.gathered(labelled, opened).collect():
        found.setdefault((r["bucket"], r["members"], r["outside"]), []).append(r["node"])
    apart = {(b, 11, 1): [*range(100, 110), b + 100] for b in (50, 51)}
    assert {k: sorted(v) for k, v in found.items()} == {(0, 90, 30): list(range(90)), **apart}
