"""Hard negatives, spelling variants and best-fit packing against brute force."""

import random
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from matchlab.llm import gnat, grouping, spelling
from matchlab.llm.tokens import WordEncoder, crc

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _mined(rows):
    """anchor, positive, rank, negative, scores by plain loops over distinct rows."""
    take = {}
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        y = (y + 1) % 10 if i % 7 == 0 else y
        take[i, y, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)] = None
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, y, v in take:
        if a % 100:
            continue
        by = sorted(((-dot(v, w), b, z) for b, z, w in take), key=lambda x: x[:2])
        for p, b, _ in [x for x in by if x[2] == y and x[1] != a][:5]:
            hits = [x for x in by if x[2] != y and 80 * -p <= 100 * -x[0] <= 100 * -p][:5]
            out += [(a, b, k, x[1], -p, -x[0]) for k, x in enumerate(hits, 1)]
    return sorted(out)


def _vectors(n, dim=6, seed=1, copies=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, dim))
    rows = [(i, (centres[i % 5] + r.normal(0, 0.4, dim)).astype(np.float32).tolist(), int(r.integers(0, 10))) for i in range(n)]
    return rows + [(n + i, rows[3][1], int(r.integers(0, 3))) for i in range(copies)]


EMBEDDINGS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("block_rows", [40, 5000])
def test_hard_negatives(spark, block_rows):
    rows = _vectors(700, copies=400)
    rows += [(None, [1.0] * 6, 1), (1200, None, 1), (1300, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (1400, [float("nan")] * 6, 1), (1500, [float("inf")] * 6, 1), (1600, [1.0] * 6, None)]
    rows += [rows[5], rows[100], (1700, [0.5, 0.25], 2), (1800, [], 3), (1900, [-1.0, -2.0, -1.0, -1.0, -1.0, -1.0], 4)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], EMBEDDINGS + ", th string, leaf int")  # columns that the operator uses itself
    got = sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in gnat.mine(df, block_rows=block_rows, fan=4, batch=3).collect())
    want = _mined(rows)
    assert got == want and len(want) > 100


def test_hard_negatives_are_searched_within_bounds(spark, monkeypatch):
    """The windows of the positives, too, get a bound from a few leaves, so that fewer rows are handed on."""
    real, handed = gnat.Index.find, []

    def find(self, *args):
        out = real(self, *args)
        handed.append((args[1:3], out.count(), real(self, handed[2][3], *args[1:]).count() if len(handed) == 3 else 0, args[0]))  # the last one also without its bounds
        return out

    monkeypatch.setattr(gnat.Index, "find", find)
    rows = [(i, v, y) for i, v, y in _vectors(4000, dim=4, seed=7)]
    got = sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in gnat.mine(spark.createDataFrame(rows, EMBEDDINGS), block_rows=40, fan=4).collect())
    assert got == _mined(rows)
    assert [x[0] for x in handed] == [(True, True), (True, False), (False, True), (False, False)]
    assert 2 * handed[3][1] < handed[3][2]


def test_hard_negatives_of_few_and_huge_rows(spark):
    empty = spark.createDataFrame([], EMBEDDINGS)
    assert gnat.mine(empty).count() == 0
    assert gnat.mine(spark.createDataFrame([(0, [1.0], 1)], EMBEDDINGS)).count() == 0
    rows = [(100, [3e5, 1.0], 1), (101, [2.9e5, 2.0], 1), (102, [2.5e5, 9.0], 2), (103, [2.4e5, -9.0], 2), (104, [1.0, 1.0], 2), (200, [1e6, 1e6], 2)]
    got = sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in gnat.mine(spark.createDataFrame(rows, EMBEDDINGS)).collect())
    assert got == _mined(rows) and len(got) >= 2


def test_tree_skips_siblings_and_loses_nothing():
    r = np.random.default_rng(4)
    x = np.concatenate([c + r.normal(0, 0.2, (200, 8)) for c in r.normal(0, 4, (12, 8))])
    tree, leaves = gnat.fit_tree(x[::4], 30, 5)
    leaf = gnat.route(tree, x)
    for k in range(leaves):
        for node, child in gnat._path(tree, k):
            if (leaf == k).any():
                d = gnat._distances(x[leaf == k], node.points)
                node.note(child, d.min(0), d.max(0))
    q = x[::37]
    d = gnat._distances(q, x)
    inner, outer = np.full((len(q), 1), 0.3), np.full((len(q), 1), 1.0)
    hit, visits = gnat.leaves_reached(tree, q, inner, outer, 1e-6), 0
    for k in range(leaves):
        needed = ((d >= 0.3) & (d <= 1.0) & (leaf == k)).any(1)
        assert set(np.flatnonzero(needed)) <= set(hit.get(k, []))
        visits += len(hit.get(k, []))
    assert leaves > 12 and visits < 0.5 * leaves * len(q)


def test_scan_finds_all_pairs_one_edit_apart():
    r = random.Random(3)
    words = sorted({bytes(r.choice(b"abc\xe9") for _ in range(r.randint(1, 7))) for _ in range(1200)} | {b"abcde" * 6 + bytes([r.choice(b"abcd")]) * r.randint(0, 3) for _ in range(30)} | {b"z" * 5000, b"z" * 5001})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    short = [i for i, w in enumerate(words) if len(w) < 100]
    want = {(i, j) for i in short for j in short if abs(len(words[i]) - len(words[j])) < 2 and distance(words[i], words[j]) == 1}
    want |= {(i, j) for i in range(len(words)) for j in range(len(words)) if {len(words[i]), len(words[j])} == {5000, 5001}}
    for few in (0, 2000):
        a, k = spelling.scan(spelling.WordList(words), spelling.Batch(words), few=few)
        assert len(a) == len(set(zip(a.tolist(), k.tolist()))) and set(zip(a.tolist(), k.tolist())) == want


def _variants(docs):
    n = Counter()
    for doc, t in docs:
        for w in "".join(c if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ" else " " for c in t or "").split(" "):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            if w:
                h = crc32(f"{'' if doc is None else doc}:{w}".encode())
                n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 97 == 0 else w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    cut = lambda w: [(i, w[:i] + w[i + 1 :]) for i in range(len(w))]
    near = {w: {x for x in n if x != w and (len(x) == len(w) and set(cut(x)) & set(cut(w)) or len(x) == len(w) + 1 and w in {y for _, y in cut(x)} or len(x) + 1 == len(w) and x in {y for _, y in cut(w)})} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def test_spelling_variants(spark):
    r = random.Random(8)
    base = ["kleine", "Straße", "écologie", "analysis", "window", "windows", "widow", "x" * 3000]
    docs = [(0, None), (1, ""), (None, "window Window WINDOW straße écologie"), (1, "x×x÷x123 über_uns ÜBER"), (400, "harbour " * 40 + "harbours " * 15 + "harboursx " * 5)]
    for i in range(2, 160):
        words = []
        for _ in range(r.randint(1, 60)):
            w = r.choice(base[:7] if i % 40 else base)
            if r.random() < 0.4:
                k = r.randrange(len(w))
                w = r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice("abé") + w[k:], w[:k] + r.choice("xyzß") + w[k + 1 :]])
            words.append(r.choice([w, w.upper() if w.isascii() else w]))
        docs.append((i, r.choice([" ", ", ", "中", "-"]).join(words)))
    df = spark.createDataFrame([(*d, "s", 1) for d in docs], "doc_id long, text string, word string, n int")
    want = _variants(docs)
    assert len(want) > 60 and any(w[1] and w[2] != w[1] for w in want)
    assert sorted(tuple(x) for x in spelling.variants(df).collect()) == want
    assert spelling.variants(df.limit(0)).count() == 0
    vocabulary = spelling.count_words(df).filter("n >= 3")
    pairs = {(x["word"], x["near"]) for x in spelling.near_pairs(vocabulary, shard=7, batch=5).collect()}  # many shards, many batches
    assert Counter(w for w, _ in pairs) == Counter({w[0]: w[4] for w in want if w[4]})


def test_roots_follow_long_chains(spark):
    forms = [(f"w{i}", f"w{i + 1}" if i < 40 else None) for i in range(41)] + [("lone", None)]
    got = dict(map(tuple, spelling.with_roots(spark.createDataFrame(forms, "word string, form string")).collect()))
    assert got == {f"w{i}": "w40" for i in range(41)} | {"lone": "lone"}


def test_word_encoder_equals_the_library():
    r = random.Random(1)
    letters = "abcABC 'stdmll  \n\t.,!?;:0129̱́HéÉßİΣ  ×ﬁ中\U0001f600\x1c\x85-_\"()<|>"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(6000)] + ["x <|endoftext|> y", "<|startoftext|>", "", "   "]
    own, lib = WordEncoder(WORD_TOKENIZER), Tokenizer.from_file(WORD_TOKENIZER)
    for i in range(0, len(texts), 500):
        ids, n = own.encode([t.encode() for t in texts[i : i + 500]])
        want = [e.ids for e in lib.encode_batch(texts[i : i + 500], add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want


def _used(runs):
    held = Counter()
    for number, content in runs:
        assert content and sum(x * k for x, k in content) <= runs.capacity
        for x, k in content:
            held[x] += k * number
    return dict(held)


def test_grouping_plan():
    r = np.random.default_rng(5)
    for capacity, lengths in ((4096, np.clip(r.lognormal(6.5, 1, 5000).astype(int), 1, 4096)), (4096, r.integers(1300, 2800, 900)), (64, r.integers(1, 65, 400)), (16, [16] * 3), (4096, [1])):
        demand = dict(Counter(int(x) for x in lengths))
        for k in grouping.SMALL:
            assert _used(grouping.plan_beyond(capacity // k, demand, capacity)) == demand
        runs, bound = grouping.plan(demand, capacity), -(-sum(lengths) // capacity)
        assert _used(runs) == demand and runs.total() <= 1.05 * bound + 2
    plain = grouping.Runs(4096)  # lengths for which best fit alone is far off
    hard = {2090: 600, 1060: 600, 1030: 600, 1000: 1200}
    for x in sorted(hard, reverse=True):
        plain.best_fit(x, hard[x])
    runs = grouping.plan(hard, 4096)
    assert _used(runs) == hard and runs.total() < 0.96 * plain.total()
    assert grouping.plan({}, 4096).total() == 0
    big = grouping.plan({x: 10**9 for x in range(1, 4097)}, 4096)
    assert _used(big) == {x: 10**9 for x in range(1, 4097)}


def test_best_fit_packing(spark):
    r = random.Random(2)
    words = ["alpha", "Beta", "gamma's", "δέλτα", "12", "e.g.", "<|endoftext|>"]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.choice([0, 3, 40, 400, 900, 2500, 5000])))) for i in range(160)] + [(200, None), (201, ""), (3, "again"), (3, "again"), (None, "none")]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, length int, part string")
    packed = grouping.pack(df, WORD_TOKENIZER, ids=True)
    rows = packed.collect()
    lib = Tokenizer.from_file(WORD_TOKENIZER)
    want = Counter()
    for doc, t in docs:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        want.update((doc, i // 4096, i, len(ids[i : i + 4096]), crc(np.array(ids[i : i + 4096]))) for i in range(0, len(ids), 4096))
    assert Counter((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in rows) == want
    by: dict = {}
    for x in rows:
        by.setdefault(x["sequence_id"], []).append((x["offset"], x["length"], x["ids"]))
    for s in by.values():
        at = 0
        for offset, length, ids in sorted(s):
            assert offset == at and len(ids) == length
            at += length
        assert at <= 4096
    assert len(by) <= 1.1 * -(-sum(x["length"] for x in rows) // 4096) + 1
    whole = {x["sequence_id"]: x["ids"] for x in grouping.sequences(packed).collect()}
    assert whole == {s: [i for _, _, ids in sorted(v) for i in ids] for s, v in by.items()}
    assert grouping.pack(df.limit(0), WORD_TOKENIZER).count() == 0


def test_scores_are_the_same_in_every_run(spark, tmp_path, monkeypatch):
    from matchlab.llm import lm

    r = random.Random(12)
    words = [f"{a}{b}" for a in ("win", "ha", "lo", "mer", "ti") for b in ("dow", "ven", "ter", "gan", "ros", "lin")]
    docs = spark.createDataFrame([(i, " ".join(r.choice(words) for _ in range(r.randint(5, 300)))) for i in range(300)], "doc_id long, text string")
    docs.repartitionByRange(5, "doc_id").write.parquet(f"{tmp_path}/docs")
    monkeypatch.setattr(lm, "BLOCK_BYTES", 60_000)  # several blocks
    once, again = ({x["doc_id"]: x["score"] for x in lm.score(spark.read.parquet(f"{tmp_path}/docs"), public_tokenizers.path("byte_bpe_50k.json")).collect()} for _ in range(2))
    assert len(once) == 300 and once == again


def test_the_model_fitted_is_the_one_that_scores():
    """Also where attention is sharp: a step's loss is the mean of the scored places, and its gradient fits it."""
    from matchlab.llm import lm

    R = np.random.default_rng(3)
    classes = lm.Classes(R.integers(0, 50, 20).astype(float), np.arange(20) % 2 == 0, 19, single=4, pools=3)
    model = lm.Attention(20, classes.number, dim=4, hidden=5, size=classes.size)
    for k in "BCcKVP":
        model.p[k] = R.normal(0, 0.5, model.p[k].shape).astype(np.float32)
    counts = np.array([1, 15, 16, 17, 70])
    ids = R.integers(0, 20, counts.sum()).astype(np.uint16)
    x, pad, target = lm.windows(ids, counts, 19)
    target = np.where(target >= 0, classes.of[ids[target]], -1)
    for sharp in (1, 300):
        model.p["Q"] = R.normal(0, sharp, (4, 4)).astype(np.float32)
        scored = lm.log_prob(model, classes, ids, counts, 19) - classes.log_within[ids]
        assert abs(model.loss(x, pad, target)[0] + scored.mean()) < 1e-4
    model.p["Q"] = R.normal(0, 0.5, (4, 4)).astype(np.float32)
    _, g, dx = model.loss(x, pad, target)
    g["E"] = np.zeros((20, 4))
    u, sums = lm._sums(x.ravel(), dx.reshape(-1, 4))
    g["E"][u] = sums
    assert u.tolist() == np.unique(x).tolist() and np.allclose(sums, [dx.reshape(-1, 4)[x.ravel() == i].sum(0) for i in u], atol=1e-5)
    for k, at in (("Q", (1, 2)), ("K", (0, 3)), ("V", (2, 2)), ("A", (7 % 4, 2)), ("a", (3,)), ("b", (0,)), ("E", (19, 1)), ("E", (int(ids[0]), 0)), ("P", (3, 1)), ("P", (20, 2))):
        model.p[k][at] += 1e-2
        up = model.loss(x, pad, target)[0]
        model.p[k][at] -= 2e-2
        down = model.loss(x, pad, target)[0]
        model.p[k][at] += 1e-2
        assert abs((up - down) / 2e-2 - g[k][at]) < 2e-3, k


def test_words_by_arrow_and_their_ids():
    from matchlab.llm import lm
    from matchlab.llm.common import word_codes

    r = random.Random(4)
    odd = "aB z\t\n\x0b\x0c\r  .,É 　 '7\0\1"
    texts = ["".join(r.choice(odd) for _ in range(r.randint(0, 40))) for _ in range(300)] + ["", " ", "<|endoftext|> a", "x<|endoftext|>"]
    for some in (texts, ["", " "], [], ["one"]):
        data = [t.encode() for t in some]
        codes, counts, words = word_codes(data, lower=True)
        found, lens, uniq = lm._numbered(data)
        assert lens.tolist() == counts.tolist() and len(set(uniq.to_pylist())) == len(uniq)
        assert [uniq[i].as_py() for i in found.tolist()] == [words[i] for i in codes.tolist()]
    enc = lm.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for words in (lm._numbered([t.encode() for t in texts])[2].to_pylist(), [b"plain", b"words.", b"don't"], []):
        ids, lens = enc.words(words)
        want = [enc.tok.encode(" " + w.decode(), add_special_tokens=False).ids for w in words]
        assert lens.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
