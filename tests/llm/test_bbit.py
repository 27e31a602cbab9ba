"""Near duplicates by b-bit MinHash against all pairs."""

import random
import re

import numpy as np
import pytest
from llm_rows import hard_rows, words
from pyspark.sql import functions as F

from basketry.llm import bbit
from basketry.llm.parity import Sets


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def expected(texts, percent=85):
    """The component's smallest index for every text, by all pairs."""
    sets = [shingles(t) for t in texts]
    label = list(range(len(sets)))

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    for b in range(len(sets)):
        for a in range(b):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((top(a), top(b)))
                label[y] = x
    return [(len(s), top(k)) for k, s in enumerate(sets)]


def edited(text, changes, seed):
    draw, w = random.Random(seed), text.split()
    for k in draw.sample(range(len(w)), changes):
        w[k] = f"e{seed}q{k}"
    return " ".join(w)


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in bbit.near_duplicates(docs).collect()}


def test_equals_all_pairs(spark):
    """Edits around the threshold, chains, copies, texts of one to seven words, and many texts of one template."""
    texts = ["", " \n", "a", "a b", "A B", "a b c d e", "a b c d e f", "a b c d e f g"]
    for k in range(25):
        base = words(k, 60 + 9 * k)
        texts += [base] + [edited(base, n, 100 * k + n) for n in (1, 1, 2, 3, 4)]
    template = words(400, 220)
    texts += [edited(template, n, 5000 + k) for k, n in enumerate([2, 3, 4, 6, 8] * 12)]
    texts += [words(9, 20000), edited(words(9, 20000), 200, 1)]
    random.Random(3).shuffle(texts)
    want = {k: (n, c, c == k) for k, (n, c) in enumerate(expected(texts))}
    assert found(spark, texts) == want


def test_apart_members_of_one_key(spark, monkeypatch):
    """With one key for all, pairs that do not link with the first are still found."""
    monkeypatch.setattr(bbit, "band_keys", lambda least: np.ones((len(least), bbit.BANDS), np.uint64))
    texts = [edited(words(k // 6, 80), k % 6 - k % 2, k) for k in range(96)]
    texts += [edited(edited(words(50, 150), 5, k % 3), k % 5, 900 + k) for k in range(40)]  # pairs away from the centre
    want = {k: (n, c, c == k) for k, (n, c) in enumerate(expected(texts))}
    assert found(spark, texts) == want
    assert len({c for _, c, _ in want.values()}) > 10


@pytest.mark.parametrize("changes", [0, 3, 6, 15, 40])
def test_estimates_are_near_the_similarity(changes):
    """Counted as in the columns: slots that differ, without those that agree by chance."""
    errors = []
    for seed in range(40):
        a = words(seed, 400)
        b = edited(a, changes, seed)
        x, y = bbit.packed(bbit.minima(Sets([a.encode(), b.encode()])))
        differ = sum(((int(u) ^ int(v)) >> (bbit.BITS * k)) % 2**bbit.BITS != 0 for u, v in zip(x, y) for k in range(64 // bbit.BITS))
        given = (1 - differ / bbit.HASHES - 1 / 16) / (1 - 1 / 16)
        s, t = shingles(a), shingles(b)
        errors.append(given - len(s & t) / len(s | t))
    assert abs(np.mean(errors)) < 0.02
    assert max(map(abs, errors)) < 0.2


def test_estimate_column_counts_slots(spark):
    draw = np.random.default_rng(0)
    rows = []
    for _ in range(30):
        x, y = (draw.integers(0, 16, bbit.HASHES) for _ in range(2))
        y = np.where(draw.random(bbit.HASHES) < 0.5, x, y)
        rows.append(([int(v) for v in bbit.packed(x[None].astype(np.uint64)).view(np.int64)[0]], [int(v) for v in bbit.packed(y[None].astype(np.uint64)).view(np.int64)[0]], float((x != y).sum())))
    got = spark.createDataFrame(rows, "sa array<long>, sb array<long>, differ double").withColumn("e", bbit.estimate()).collect()
    for r in got:
        assert r["e"] == pytest.approx((1 - r["differ"] / bbit.HASHES - 1 / 16) / (1 - 1 / 16))


def test_recall_of_the_bands():
    """Pairs just above the threshold share a key, all of them."""
    missed = 0
    for seed in range(150):
        a = words(seed, 300)
        b = edited(a, 4, seed)  # 0.87 or a little more
        x, y = bbit.band_keys(bbit.minima(Sets([a.encode(), b.encode()])))
        missed += not (x == y).any()
    assert missed == 0


def test_hard_rows(spark, hard, empty):
    clash = hard.withColumns({c: F.lit("own") for c in ("n", "name", "keys", "t1", "run", "lead", "component_id", "kept", "place")})
    got = sorted(map(str, bbit.near_duplicates(clash).collect()))
    assert got == sorted(map(str, bbit.near_duplicates(hard).collect()))
    by_id = {r["doc_id"]: r for r in bbit.near_duplicates(hard).collect()}
    assert by_id[1]["kept"] and not by_id[2]["kept"] and by_id[3]["component_id"] == 1
    assert by_id[4]["n_shingles"] == by_id[5]["n_shingles"] == by_id[6]["n_shingles"] == 0
    assert by_id[5]["kept"] and by_id[6]["kept"] and not by_id[8]["kept"]
    assert len(got) == len(hard_rows())
    assert bbit.near_duplicates(empty).count() == 0
