"""The text operators on rows with nulls, blanks, copies and long texts, against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from llm_rows import hard_rows, words
from tokenizers import Tokenizer

from basketry.llm import bpe, context_tree, licenses, lines, packing, paragraphs, parity, toxicity
from basketry.llm.components import settled
from basketry.llm.tokens import WordTokenizer
from basketry.session import materialize, path_exists

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BLANK = rb"[^\x20\x09-\x0D]+"


def lower(text):
    return (text or "").encode().translate(bpe_fold())


def bpe_fold():
    return bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def tokens(text):
    return re.findall(BLANK, lower(text))


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_bpe_equals_the_library(hard):
    coder = bpe.encoder(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    got = Counter(rows_of(bpe.digests(hard, RANKS)))
    want = Counter()
    for doc_id, text, *_ in hard_rows():
        ids = library.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        want[doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert got == want


def test_bpe_long_match_and_round_trip(spark, hard):
    coder = bpe.encoder(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    for text in ("ab" * 3000, "a" * 2000, "é" * 700, "the" * 50):
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)
    back = bpe.decode_documents(bpe.encode_documents(hard, RANKS), RANKS)
    assert Counter(bytes(r["bytes"]) for r in back.collect()) == Counter((t or "").encode() for _, t, *_ in hard_rows())


def test_empty_tables(empty):
    for result in (
        bpe.digests(empty, RANKS),
        licenses.scan(empty),
        lines.dedup_lines(empty),
        paragraphs.repeated_spans(empty),
        paragraphs.dedup_paragraphs(empty),
        parity.join_documents(empty),
        packing.pack(packing.cut_documents(empty, WORD_BPE)),
        context_tree.score(empty.selectExpr("doc_id", "text", "false AS held_out")),
    ):
        assert result.count() == 0


def test_packing(hard):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    tokenizer.encode_special_tokens = True
    found = packing.pack(packing.cut_documents(hard, WORD_BPE)).toPandas()
    want = Counter()
    for doc_id, text, *_ in hard_rows():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], "<u4").tobytes()
            want[doc_id, k // 2048, k, len(part) // 4, zlib.crc32(part)] += 1
    got = Counter((None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found.itertuples())
    assert got == want
    placed = found.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id").length.sum() <= 2048).all()
    assert (placed.offset == placed.groupby("sequence_id").length.cumsum() - placed.length).all()
    assert found.sequence_id.nunique() <= math.ceil(found.length.sum() / 2048) + 1


@pytest.mark.parametrize("seed", range(4))
def test_packing_plan_is_near_the_bound(seed):
    draw = np.random.default_rng(seed)
    lengths = Counter(np.minimum(2047, draw.lognormal(6.2, 1.0, 5000).astype(int) + 1).tolist())
    start, each, sizes, demand = packing.groups_of({k: n for k, n in lengths.items() if k >= 256}, 256)
    patterns = packing.best_patterns(sizes, demand, 2048)
    used = Counter()
    for pattern, times in patterns:
        assert sum(sizes[g] * n for g, n in pattern.items()) <= 2048
        for g, n in pattern.items():
            used[g] += n * times
    assert [used[g] for g in range(len(sizes))] == demand
    small = {k: n for k, n in lengths.items() if k < 256}
    moves, opened = packing.best_fit(small, {40: 3, 300: 5, 2048: 1}, 2048)
    assert sum(m[2] for m in moves) == sum(small.values())
    left = defaultdict(int)
    for length, _, n, origin, first in moves:
        for k in range(first, first + n):
            left[origin, k] += length
    assert all(v <= origin for (origin, _), v in left.items())


def test_parity_join_equals_brute_force(hard):
    sets = []
    for doc_id, text, *_ in hard_rows():
        w = tokens(text)
        sets.append((doc_id, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for k, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[root(k)] = min(doc_id, least.get(root(k), doc_id))
    want = Counter((d, len(s), least.get(root(k))) for k, (d, s) in enumerate(sets))
    assert Counter(rows_of(parity.join_documents(hard).select("doc_id", "n_shingles", "component_id"))) == want


def test_parity_join_on_a_group_of_near_copies(spark):
    """A chain of edits: most pairs of the group do not link, all links count."""
    draw = np.random.default_rng(5)
    base = words(1, 80).split()
    texts = []
    for k in range(60):
        w = list(base)
        for at in draw.choice(80, draw.integers(0, 12), replace=False):
            w[at] = f"e{k}q{at}"
        texts.append((k, " ".join(w)))
    sets = {k: {tuple(t.split()[i : i + 5]) for i in range(76)} for k, t in texts}
    parent = dict.fromkeys(sets)
    label = {k: k for k in sets}
    for a in sets:
        for b in sets:
            if a < b and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    assert parent
    got = {r.doc_id: r.component_id for r in parity.join_documents(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == label


def test_parity_join_does_not_shuffle_texts_it_does_not_want(spark, hard, monkeypatch):
    plans = []

    def noted(df, label="table", *args, **kwargs):
        if label == "parity-texts":
            plans.append(df._jdf.queryExecution().toString())
        return materialize(df, label, *args, **kwargs)

    monkeypatch.setattr(parity, "materialize", noted)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        parity.join_documents(hard).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # Texts are read in buckets by row, so that only names and rows are shuffled to them.
    assert plans and all("Bucketed: true" in p for p in plans)


def test_sketch_distance_is_a_lower_bound():
    draw = np.random.default_rng(1)
    for _ in range(20):
        pool = [f"t{k}" for k in draw.integers(0, 400, 300)]
        sets = parity.Sets([" ".join(pool[:200]).encode(), " ".join(pool[40:]).encode()])
        sketch = sets.sketches()
        assert int(np.bitwise_count(sketch[0] ^ sketch[1]).sum()) <= len(np.setxor1d(sets.of(0), sets.of(1)))


def test_line_dedup(hard):
    got = lines.dedup_lines(hard)
    assert got.columns == [*hard.columns, "n_lines", "n_dropped"]
    by_id = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    assert got.count() == len(hard_rows())
    assert by_id[1].n_dropped == 0 and by_id[3].text == "" and by_id[2].n_dropped == 1  # a copy and a near copy of document 1
    assert by_id[4].text is None and by_id[5].text == "" and by_id[6].text == " \t\n "
    assert by_id[7].text == by_id[8].text == "one two"  # too short
    assert by_id[12].n_dropped == 0 and by_id[13].text == words(18, 20) + "\n" + words(19, 9)


def test_line_dedup_links(spark):
    base = words(3, 40).split()
    one, far = list(base), list(base)
    one[5] = "edit"
    for k in range(0, 40, 3):
        far[k] = f"other{k}"
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(base).upper()), (3, " ".join(far))], "doc_id long, text string")
    assert {r.doc_id: r.n_dropped for r in lines.dedup_lines(docs).collect()} == {1: 0, 2: 1, 3: 0}


def edited_lines(n, count, seed):
    """Pairs of lines of ``n`` words, of which ``floor(0.15 * n)`` are replaced by others of the same length."""
    draw = np.random.default_rng(seed)
    word = lambda k: "".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), k))
    for _ in range(count):
        one = [word(int(k)) for k in draw.integers(3, 10, n)]
        two = list(one)
        for at in draw.choice(n, int(0.15 * n), replace=False):
            two[at] = word(len(one[at]))
        yield " ".join(one), " ".join(two)


def test_line_dedup_recall_by_length(spark):
    rows, length = [], {}
    for n in (7, 10, 13, 20, 27, 40):
        for pair in edited_lines(n, 60, n):
            rows += [(len(rows) + k, text) for k, text in enumerate(pair)]
            length[len(rows) - 1] = n
    found = Counter(length[r.doc_id] for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.n_dropped)
    assert all(found[n] >= 57 for n in set(length.values())), found


def test_line_dedup_inside_one_template(spark):
    """Pairs of lines that share a passage with many others and only with their own partner enough to link."""
    rows, common = [], next(edited_lines(30, 1, 70))[0]
    for pair, (line, _) in enumerate(edited_lines(40, 40, 71)):
        own = line.split()
        edit = list(own)
        edit[20] = "edit"
        rows += [(2 * pair, f"{common} {' '.join(own)}"), (2 * pair + 1, f"{common} {' '.join(edit)}")]
    # Lines of mostly one word, and of the same words in another order.
    rows += [(200, "12 34 56 78 90 11 label one of them"), (201, "12 34 56 78 90 11 label one of thym"), (202, "them of one label 11 90 78 56 34 12")]
    got = {r.doc_id: r.n_dropped for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: int(k < 200 and k % 2 or k == 201) for k, _ in rows}


def test_line_dedup_counts_characters(spark):
    docs = spark.createDataFrame([(1, "sorting paper letters before monday morning"), (2, "sorting paper lettars before monday morning")], "doc_id long, text string")
    assert {r.doc_id: r.n_dropped for r in lines.dedup_lines(docs, unit="characters").collect()} == {1: 0, 2: 1}


def test_line_dedup_of_short_lines(spark):
    wide = "山川草木鳥獣虫魚日月星辰春夏秋冬東西南北上下左右前後"
    texts = ["Les.\n---\n\nalpha", "les\n***\n\nbeta", "Les.\n---\n\ngamma", wide, wide.replace("春", "夕")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs, unit="characters", short_copies=True).collect()}
    assert got == {0: texts[0], 1: "***\n\nbeta", 2: "\ngamma", 3: wide, 4: ""}


def test_passages(hard):
    spans = paragraphs.repeated_spans(hard).toPandas()
    text = {d: t for d, t, *_ in hard_rows()}
    cut = {r.doc_id: text[r.doc_id].encode()[r.start : r.end].decode() for r in spans.itertuples()}
    assert set(cut) == {2, 3, 10}
    assert cut[3] == text[1] and cut[10] in words(50, 60) and len(cut[10].split()) >= 40
    assert dict(zip(spans.doc_id, spans.kept_doc_id)) == {2: 1, 3: 1, 10: 9}
    left = {r.doc_id: r.text for r in paragraphs.dedup_paragraphs(hard).collect() if r.doc_id is not None}
    assert left[3].strip() == "" and left[1] == text[1] and left[9] == text[9] and left[4] is None
    assert left[10] == text[10].replace(cut[10], "")


def test_spans_look_at_a_portion_of_the_texts_at_once(monkeypatch):
    """A batch may hold 10,000 rows: their texts are not hashed in one piece, and those without places not at all."""
    text = words(5, 60)
    many = 3 * paragraphs.PORTION // len(text)
    found = paragraphs.Paragraphs([text.encode()])
    at = np.arange(len(found.start))
    places = [at if k % 2 else None for k in range(2 * many)]
    rows = pd.DataFrame({"text": [text if k % 2 else "no places" for k in range(2 * many)], "at": places, "groups": places, "keepers": places})
    seen = []
    monkeypatch.setattr(paragraphs, "Paragraphs", lambda texts, kind=paragraphs.Paragraphs: seen.append(texts) or kind(texts))
    spans = list(paragraphs.spans(rows, paragraphs.MIN_WORDS))
    assert [s[:4] for s in spans] == [(k, 0, len(text), 60) for k in range(1, 2 * many, 2)]
    assert max(sum(map(len, texts)) for texts in seen) < paragraphs.PORTION + len(text)
    assert all(t != b"no places" for texts in seen for t in texts)
    assert paragraphs.without("aß bc dß e", [(0, 3), (7, 10)]) == " bc  e"


def test_paragraphs_depend_on_nearby_words_alone():
    passage = words(4, 200)
    alone = paragraphs.Paragraphs([passage.encode()])
    inside = paragraphs.Paragraphs([(words(5, 77) + " " + passage + " " + words(6, 31)).encode(), b"x"])
    common = set(alone.names.tolist()) & set(inside.names.tolist())
    assert len(common) >= len(alone.names) - 4


def test_runs_are_settled_beyond_their_first_member(spark):
    """Member 1 links with none; 2 and 3, 4 and 5 link with each other alone."""
    linked = {(2, 3), (4, 5)}
    runs = spark.createDataFrame([(9, k) for k in (2, 3, 4, 5)], "run long, name long")
    pairs = lambda df: spark.createDataFrame([p for p in map(tuple, df.collect()) if p in linked], "a long, b long")
    rest = lambda df: df.alias("x").join(df.alias("y"), parity.F.expr("x.run = y.run AND x.name < y.name AND x.component <> y.component")).selectExpr("x.name AS a", "y.name AS b")
    assert set(rows_of(settled(runs, spark.createDataFrame([], "a long, b long"), pairs, rest))) == {(2, 2), (3, 2), (4, 4), (5, 4)}


def test_license_scan(hard, spark):
    texts = [
        "Under  the MIT-license, under the mit license. apache license, version 2",
        "underthe mit license under the mit",
        licenses.TEMPLATES["mit"].upper() + " and more words",
        "first line\n" + " ".join(sorted(licenses.TEMPLATES["gpl"].split())) + "\nlast",
        "cc by nc",
        "",
        None,
    ]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, score string").drop("score")
    for table, rows in ((docs, list(enumerate(texts))), (hard, [(d, t) for d, t, *_ in hard_rows()])):
        want = Counter()
        for doc_id, text in rows:
            word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode().translate(bpe_fold()).decode())
            every, places, base = word(text or ""), [], set()
            for phrase, label in licenses.PHRASES.items():
                p = phrase.split()
                hits = [k for k in range(len(every)) if every[k : k + len(p)] == p]
                places += hits
                base |= {label} if hits else set()
            more, best = set(base), 0.0
            for line in (text or "").split("\n"):
                for label, template in licenses.TEMPLATES.items():
                    t = set(template.split())
                    share = len(t & set(word(line))) / len(t)
                    if share >= licenses.CONTAINMENT - 1e-9:
                        more.add(label.removesuffix("-short"))
                        best = max(best, share)
            want[doc_id, len(every), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(more)), 1.0 if places else best] += 1
        got = licenses.scan(table).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
        assert Counter(rows_of(got)) == want


def brute_ctw(train, text, depth):
    """Log10 probability of a text by the recursive definition."""
    count = defaultdict(lambda: [0, 0])
    children = defaultdict(set)

    def steps(raw):
        padded = bytes([255]) * depth + raw + bytes([255])
        for k in range(depth, len(padded)):
            for s in range(8):
                yield padded[k - depth : k], (1 << s) | padded[k] >> 8 - s, padded[k] >> 7 - s & 1

    for t in train:
        for context, node, bit in steps(t):
            for d in range(depth + 1):
                count[context[depth - d :], node][bit] += 1
                if d < depth:
                    children[context[depth - d :], node].add(context[depth - d - 1 :])
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
    memo = {}

    def weighted(context, node):
        if (context, node) not in memo:
            own = kt(*count[context, node])
            if len(context) < depth:
                longer = sum(weighted(c, node) for c in children[context, node])
                own, longer = max(own, longer), min(own, longer)
                own = own + math.log1p(math.exp(longer - own)) - math.log(2)
            memo[context, node] = own
        return memo[context, node]

    def one(context, node, d):
        at = context[depth - d :]
        if sum(count[at, node]) == 0:
            return 0.5
        a, b = count[at, node]
        own = (b + 0.5) / (a + b + 1)
        if d == depth:
            return own
        longer = sum(weighted(c, node) for c in children[at, node])
        share = 1 / (1 + math.exp(min(700, longer - kt(a, b))))
        return share * own + (1 - share) * one(context, node, d + 1)

    return sum(math.log10(p if bit else 1 - p) for context, node, bit in steps(text) for p in [one(context, node, 0)])


def test_context_tree_equals_the_definition(spark):
    texts = [(1, "the cat sat on the mat", False), (2, "The dog sat on a mat\n", False), (3, "", False), (4, "the cow SAT", True), (5, "zzz é", True), (None, "the end", False)]
    got = context_tree.score(spark.createDataFrame(texts, "doc_id long, text string, held_out boolean"), depth=3, batch_chars=30)
    got = {r.doc_id: r for r in got.collect()}
    train = [lower(t) for _, t, h in texts if not h]
    counts = Counter(w for t in train for w in [*re.findall(BLANK, t), None])
    n, v = sum(counts.values()), len(counts)
    for doc_id, text, held in texts:
        w, r = [*tokens(text), None], got[doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), sum(counts[x] > 0 for x in w), n, held)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), abs=1e-9)
        assert r.score == pytest.approx(brute_ctw(train, lower(text), 3), rel=1e-5)


def test_context_tree_sums_to_one(spark):
    """Over all next bytes the probabilities after a context add up to one."""
    keys = np.sort(np.array([97 << 24 | 98 << 16 | 99 << 8 | x for x in range(256)], np.int64))
    tree = context_tree.Subtrees(keys, np.where(keys % 7 == 0, 3.0, 0.0), 3)
    top = tree.top()
    above = top[["context", "node"]].assign(known=0.2, open=0.6)
    assert 10 ** tree.log_probabilities(above) @ np.ones(256) == pytest.approx(1.0)


def test_toxicity(spark, data, hard):
    docs = [(k, " ".join([*words(k, 30).split(), *(["vile"] * (k % 3 == 0))]), "x", 0.5) for k in range(400)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, label string, score double")
    labels = spark.createDataFrame([(k, 0, int(k % 3 == 0)) for k in range(0, 400, 2)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    found = toxicity.score(docs, model).toPandas()
    assert ((found.score >= 0.3) == (found.doc_id % 3 == 0)).all()
    assert toxicity.score(hard, model).where("score IS NULL OR score < 0 OR score > 1").count() == 0
    every = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(400)], "doc_id long, toxic int")
    found = toxicity.score(docs, toxicity.fit(docs, every)).toPandas()
    assert ((found.score >= 0.3) == (found.doc_id % 3 == 0)).all()
    none = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {round(r.score, 6) for r in toxicity.score(hard, none).collect()} == {0.0}


def test_runs_of_letters_are_words_without_a_split():
    """Letters alone are looked up as they stand; ids are those of the tokenizer."""
    tokenizer = WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    split, seen = tokenizer.split, []
    tokenizer.split = lambda run: seen.append(run) or split(run)
    texts = ["Plain words, éa ßtraße ŉn ªb Ⱥx don't x9 naïve 12 ǅ", "I'LL i'll we've ºc ʼn ABC"]
    assert tokenizer.encode(texts) == tokenizer._tokenized(texts)
    assert "plain" not in seen and "naïve" not in seen and "don't" in seen and "x9" in seen


def test_pairs_are_verified_in_passes(spark, monkeypatch):
    """With many more copies than texts, passes look at a part of the groups each, and find the links that one pass finds."""
    rng = np.random.default_rng(12)
    base = [f"w{k}" for k in range(60)]
    texts = [(k, " ".join(f"x{k}" if at in rng.choice(60, k % 5, replace=False) else w for at, w in enumerate(base))) for k in range(30)]
    df = spark.createDataFrame(texts, "name long, text string")
    pairs = spark.createDataFrame([(a, b) for a in range(30) for b in range(a)], "a long, b long")
    found, written = {}, []
    for name, chars in (("one", 1 << 30), ("several", 2_000)):
        monkeypatch.setattr(parity, "VERIFY_CHARS", 2_000)
        monkeypatch.setattr(parity, "PASS_CHARS", chars)
        monkeypatch.setattr(parity, "materialize", lambda df, label="table", *a, **k: written.append((name, label)) or materialize(df, label, *a, **k))
        found[name] = sorted(map(tuple, parity.verified(pairs, df).collect()))
    assert found["one"] == found["several"] and 0 < len(found["one"]) < 435
    assert written.count(("one", "parity-found")) == 1 < written.count(("several", "parity-found"))


def test_line_dedup_leaves_nothing_it_does_not_need(spark, hard, monkeypatch, tmp_path):
    """Keys of one line are not written, and of what was written on the way only the groups stay."""
    paths = {}

    def noted(df, label="table", *args, **kwargs):
        out = materialize(df, label, *args, **kwargs)
        paths.setdefault(label, []).append(out.scratch)
        if label == "line-runs":
            assert out.where("n < 2").isEmpty() and not out.isEmpty()
        return out

    monkeypatch.setattr(lines, "materialize", noted)
    got = lines.dedup_lines(hard)
    assert got.count() == hard.count() and "line-keys" not in paths
    assert {label for label, all_of in paths.items() for p in all_of if path_exists(spark, p)} == {"line-groups"}
