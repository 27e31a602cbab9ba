"""The Merkle manifest against a tree built in Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from llm_rows import hard_rows, words
from pyspark.sql import functions as F

from basketry.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    shown = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in shown))


def tree(leaves):
    """All levels, from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[k : k + 2])) for k in range(0, len(low), 2)])
    return levels


def siblings(levels, at):
    for level in levels[:-1]:
        other = at ^ 1
        yield (level[other] if other < len(level) else ""), other < at
        at //= 2


def expected(rows):
    """The rows that the query must give."""
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    order = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in order:
        held = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        trees[lang] = held, tree([leaf_of(*r) for r in held])
    top = tree([trees[lang][1][-1][0] for lang in order])
    out = Counter()
    for g, lang in enumerate(order):
        held, levels = trees[lang]
        for at, row in enumerate(held):
            doc_id, n_chars = row[0], row[4]
            steps = [*siblings(levels, at), *siblings(top, g)]
            changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
            node = leaf_of(*row[:4], n_chars + 1) if changed else leaf_of(*row)
            for other, is_left in steps:
                node = sha(other + node if is_left else node + other)
            assert changed or node == top[-1][0]
            out[doc_id, leaf_of(*row), levels[-1][0], top[-1][0], sha("".join(s for s, _ in steps)), node, node == top[-1][0]] += 1
    return out


def found(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return Counter(tuple(r) for r in merkle.op11_merkle_manifest(spark, str(tmp_path)).collect())


@pytest.mark.parametrize("levels", [1, 3, 8])
def test_equals_a_tree_in_python(spark, hard, tmp_path, monkeypatch, levels):
    """Blocks of two leaves need many tiers; the rows hold nulls in every column, repeated rows and a long text."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 1 << levels)
    more = [(k % 41, words(k % 37, 6), ["en", "de", None, "é"][k % 4 if k % 3 else 0], "s", k % 5) for k in range(150)]
    rows = hard_rows() + more
    got = found(spark, spark.createDataFrame(rows, hard.schema), tmp_path)
    assert got == expected(rows)
    assert {key[6] for key in got} == {True, False}


def test_one_row_and_none(spark, hard, empty, tmp_path):
    row = (5, "text", "en", "s", 4)
    assert found(spark, spark.createDataFrame([row], hard.schema), tmp_path / "one") == expected([row])
    assert merkle.manifest(empty).count() == 0


def test_other_columns_play_no_part(spark, hard):
    clash = hard.withColumns({c: F.lit("own") for c in ("place", "tree", "_part", "node", "steps", "size", "root", "_row", "block")})
    plain = merkle.manifest(hard)
    assert Counter(map(str, merkle.manifest(clash).collect())) == Counter(map(str, plain.collect()))


def test_proofs_alone_give_the_root(spark, hard):
    rows = merkle.manifest(hard).collect()
    assert len({r["root"] for r in rows}) == 1
    for r in rows:
        node = r["leaf"]
        for step in r["steps"]:
            assert not (step["left"] and step["right"])
            node = sha(step["left"] + node + step["right"])
        assert node == r["root"]


def test_places_of_a_group_over_many_ranges(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.sha2(F.col("id").cast("string"), 256).alias("node"))
    placed = merkle.numbered(merkle.materialize(docs), ["lang"], ["doc_id"])
    assert placed.where((F.col("place") == F.col("doc_id")) & (F.col("size") == 20000)).count() == 20000
