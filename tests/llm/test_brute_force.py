"""Packing, encoder, decontamination and the quality classifier against plain loops or the library."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from matchlab.llm import decontaminate, packing, quality
from matchlab.llm.tokens import Encoder, crc

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_encoder_equals_the_library():
    r = random.Random(21)
    letters = "abcXYZ  \n\t.,!'0129éßÀ中\U0001f600 \x85­́_-"
    parts = ["<|endoftext|>", "hello", " world", "don't", "\r\n", "\0", "\1", "A.B.C.", "...", " ."]
    texts = ["".join(r.choice(letters) if r.random() < 0.8 else r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(6000)] + ["", " ", "\n", "<|endoftext|>"]
    own, lib = Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for i in range(0, len(texts), 500):
        ids, n = own.encode([t.encode() for t in texts[i : i + 500]])
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [e.ids for e in lib.encode_batch(texts[i : i + 500], add_special_tokens=False)]


def test_packing_holds_every_id_once(spark):
    r = random.Random(2)
    words = ["alpha", "Beta", "gamma's", "δέλτα", "12", "e.g.", "<|endoftext|>", "\n", "  x"]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.choice([0, 3, 40, 400, 900, 2500])))) for i in range(120)] + [(200, None), (201, ""), (3, "again"), (3, "again"), (None, "none")]
    rows = packing.pack(spark.createDataFrame([(*d, "c", 1) for d in docs], "doc_id long, text string, cls string, row int"), TOKENIZER).collect()
    lib, want = Tokenizer.from_file(TOKENIZER), Counter()
    for doc, t in docs:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        want.update((doc, i, len(ids[i : i + 2048]), crc(np.array(ids[i : i + 2048])), len(ids)) for i in range(0, len(ids), 2048))
    assert Counter((x["doc_id"], x["start"], x["length"], x["ids_crc32"], x["doc_tokens"]) for x in rows) == want
    by: dict = {}
    for x in rows:
        by.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for s in by.values():
        assert [o for o, _ in sorted(s)] == [0, *np.cumsum([n for _, n in sorted(s)])[:-1]] and sum(n for _, n in s) <= 2048


def _plain_contaminated(docs, items, size, threshold, overlap):
    items = [(i, t) for i, t in dict.fromkeys(items) if t is not None and decontaminate.words(t.encode())]
    tokens = [decontaminate.words(t.encode()) for _, t in items]
    df = Counter(x for w in tokens for x in set(w))
    mean = sum(map(len, tokens)) / len(tokens)
    impact, span = [], []
    for (_, t), w in zip(items, tokens):
        part = {x: math.log(1 + (len(items) - df[x] + 0.5) / (df[x] + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(w) / mean)) for x, c in Counter(w).items()}
        impact.append({x: v / sum(part.values()) for x, v in part.items()})
        k = size
        while 2 * len(t.split()) > k:
            k *= 2
        span.append(k)
    longest = {k: max(len(t.split()) for (_, t), s in zip(items, span) if s == k) for k in span}
    found: dict = {}
    for doc, text in docs:
        raw = (text or "").lower().encode().split()
        for (item, t), part, k in zip(items, impact, span):
            for lo in range(0, max(1, len(raw) - k + k // 2), k // 2) if raw else []:
                passage = {w.strip(b".,;:!?\"'()[]") for w in raw[lo : lo + k]}
                score = sum(v for x, v in part.items() if x in passage)
                if score < threshold - 1e-6:
                    continue
                own = [x for x in (w.strip(b".,;:!?\"'()[]") for w in raw[max(0, lo - longest[k]) : min(lo + k, len(raw)) + longest[k]]) if x]
                near = {tuple(own[i : i + n]) for n in (1, 2, 3) for i in range(len(own) - n + 1)}
                q, a = (len(p & near) / len(p) if p else 1.0 for p in (decontaminate.shingles(decontaminate.words(x.encode())) for x in decontaminate.question_answer(t)))
                if q >= overlap and a >= overlap:
                    found[doc, item] = max(found.get((doc, item), (0.0, 0.0, 0.0)), (score, q, a))
    return {k: tuple(round(x, 6) for x in v) for k, v in found.items()}


def test_decontamination_equals_plain_search(spark):
    r = random.Random(31)
    vocabulary = [f"{a}{b}" for a in ("win", "ha", "lo", "mer", "ti", "ro") for b in ("dow", "ven", "ter", "gan", "ros", "lin", "tu")]
    text = lambda n: " ".join(r.choice(vocabulary) + r.choice(["", "", ",", "."]) for _ in range(n))
    items = [(i, text(r.choice([1, 2, 5, 9, 20, 45])) + r.choice(["", "? Answer: " + text(2), "? " + text(4)])) for i in range(40)] + [(50, None), (51, ""), (52, "..."), (None, text(12)), (3, text(9))]
    items.append(items[0])
    docs = [(100, None), (101, ""), (None, items[5][1])]
    for i in range(90):
        part = (r.choice(items)[1] or "").split()
        if r.random() < 0.6 and part:
            for _ in range(len(part) // 8):
                part[r.randrange(len(part))] = r.choice(vocabulary)
        docs.append((i, " ".join([text(r.randint(0, 60)), *part, text(r.randint(0, 60))])))
    frame = lambda rows, name: spark.createDataFrame([(*x, 1, "b") for x in rows], f"{name} long, text string, block int, word string")
    want = _plain_contaminated(docs, items, 16, 0.6, 0.5)
    for block_items in (20_000, 11):
        got = decontaminate.contaminated(frame(docs, "doc_id"), frame(items, "item_id"), threshold=0.6, size=16, block_items=block_items).collect()
        assert len(got) == len({(x["doc_id"], x["item_id"]) for x in got})
        found = {(x["doc_id"], x["item_id"]): tuple(round(x[c], 6) for c in ("score", "question_overlap", "answer_overlap")) for x in got}
        if block_items > 1000:
            assert found == want
        else:  # the surroundings reach as far as a block's longest item
            assert {k: v[0] for k, v in found.items() if k in want}.items() <= {k: v[0] for k, v in want.items()}.items() and len(found) > 0.9 * len(want)
    assert len(want) > 40


def test_quality_fit_is_at_its_optimum_and_its_chances_add_up():
    r = np.random.default_rng(6)
    n, words = 240, 14
    grade = r.integers(0, 3, n)
    x = r.random((n, words)) < 0.2 + 0.5 * (np.arange(words)[None, :] % 3 == grade[:, None])
    h = np.concatenate([np.flatnonzero(d).astype(np.uint64) * np.uint64(977) + np.uint64(5) for d in x])
    counts = x.sum(1).astype(np.int64)
    l1, l2 = 0.5, 1e-3
    model = quality.fit(h, counts, grade, rounds=4000, rate=0.03, l1=l1, l2=l2)
    score = np.array([sum(float(w) for k, w in zip(model.hashes, model.weights) if k in set(np.flatnonzero(d).astype(np.uint64) * np.uint64(977) + np.uint64(5))) for d in x])
    assert np.allclose(model.scores(h, counts), score, atol=1e-5)
    chance = model.at_least(score)
    each = np.c_[1 - chance[:, 0], chance[:, 0] - chance[:, 1], chance[:, 1]]
    assert np.allclose(each.sum(1), 1) and (each > 0).all() and model.thresholds[0] < model.thresholds[1]
    plain = [1 / (1 + math.exp(-(s - t))) for s in score[:5] for t in model.thresholds]
    assert np.allclose(chance[:5].ravel(), plain)

    def loss(w, t):
        s = x[:, ::1] @ w
        p = 1 / (1 + np.exp(-(s[:, None] - t[None, :])))
        p = np.c_[np.ones(n), p, np.zeros(n)]
        return -np.log(p[np.arange(n), grade] - p[np.arange(n), grade + 1]).mean() + l2 / 2 * (w * w).sum()

    w = np.zeros(words)
    for k, v in zip(model.hashes.tolist(), model.weights):
        w[(k - 5) // 977] = v
    share = x.mean(0)
    size = 0.5 * l1 * np.sqrt(share * (1 - share) / n)
    step = 1e-5
    for j in range(words):
        e = np.eye(words)[j] * step
        g = (loss(w + e, model.thresholds) - loss(w - e, model.thresholds)) / (2 * step)
        assert abs(g + np.sign(w[j]) * size[j]) < 2e-3 if w[j] else abs(g) <= size[j] + 2e-3
    for k in range(2):
        e = np.eye(2)[k] * step
        assert abs(loss(w, model.thresholds + e) - loss(w, model.thresholds - e)) / (2 * step) < 2e-3
    assert (np.abs(w) > 0).sum() >= 6
