import hashlib
import io
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from matchlab.llm import decontaminate, jaccard, lm, packing, pii, quality, rules, sstable, substring, warc
from matchlab.llm.fmindex import FMIndex
from matchlab.llm.queries import TOKENIZER

SCHEMA = "doc_id long, text string, th string, n_chars long"
R = np.random.default_rng(1)
WORDS = [f"w{i}" for i in range(400)]
PASSAGE = " ".join(R.choice(WORDS, 60))


def _text(n):
    return " ".join(R.choice(WORDS, n))


BASE = _text(120)
ROWS = [
    (1, BASE), (2, BASE), (3, BASE.replace("w1 ", "x ", 1) + " tail"), (4, None), (5, ""), (6, "one two"), (7, "one TWO"), (8, _text(30) + " " + PASSAGE + " " + _text(30)), (9, _text(10) + " " + PASSAGE),
    (10, "mail a.b@c.example.org and 10.0.0.1, card 4111111111111111, call +1 (487) 555-7209"), (10, "mail a.b@c.example.org and 10.0.0.1, card 4111111111111111, call +1 (487) 555-7209"), (11, _text(9000)), (None, _text(70)), (12, BASE),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "clash", 0) for i, t in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substring(docs, empty):
    first = {}
    for d, t in ROWS:
        w = (t or "").split()
        for i in range(len(w) - 49):
            k, d0 = tuple(w[i : i + 50]), 1 << 62 if d is None else d
            first[k] = min(first.get(k, d0), d0)
    want = Counter()
    for d, t in ROWS:
        w, gone = (t or "").split(), set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < (1 << 62 if d is None else d):
                gone |= set(range(i, i + 50))
        want[d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()] += 1
    for hot in (50_000, 1):
        got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring.deduplicate(docs, hot=hot).collect())
        assert got == want
    assert substring.deduplicate(empty).count() == 0


def test_fm_index_finds_all_windows():
    """Patterns that are indexed, that differ from what is, and with symbols that the index has not."""
    for symbols, length in ((2, 5), (3, 5), (4, 3), (3, 50)):
        seqs = [R.integers(1, symbols + 1, 90) for _ in range(9)]
        seqs[7] = np.r_[seqs[0][20:80], symbols + 1, seqs[1][:29]]
        seqs[8] = np.r_[seqs[2][:30], seqs[3][30:]]
        text = np.concatenate([np.append(s, 0) for s in seqs[:5]])
        value = np.repeat([5, 1, 4, 2, 3], 91)
        index, seen = FMIndex(text, value, length, symbols + 2), {}
        for act, pos, least in index.matching(np.concatenate(seqs), np.arange(9) * 90, np.full(9, 90)):
            seen |= {(a, p): v for a, p, v in zip(act.tolist(), pos.tolist(), least.tolist())}
        held: dict = {}
        for s, v in zip(seqs[:5], (5, 1, 4, 2, 3)):
            for i in range(90 - length + 1):
                held[tuple(s[i : i + length])] = min(v, held.get(tuple(s[i : i + length]), 9))
        want = {(a, p): held[w] for a, s in enumerate(seqs) for p in range(90 - length + 1) if (w := tuple(s[p : p + length])) in held}
        assert seen == want and (7, 0) in want and len(want) < 9 * (90 - length + 1)


def test_jaccard(docs, empty):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(docs).collect()}
    sets = {}
    for i, (d, t) in enumerate(ROWS):
        w = (t or "").lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    group = {i: {i} for i in sets}
    for i in sets:
        for j in sets:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and group[i] is not group[j]:
                group[i] |= group[j]
                for k in group[j]:
                    group[k] = group[i]
    ids = [d for d, _ in ROWS]
    assert got == {(ids[i], len(sets[i]), min((ids[k] for k in group[i] if ids[k] is not None), default=None) if sets[i] else ids[i]) for i in sets}
    assert jaccard.join(empty).count() == 0


def test_jaccard_moves_texts_in_turns(spark, docs, monkeypatch):
    """With more partitions, texts are moved in turns, opened groups are asked for fitting tokens alone, and no plan from the tokens to the links is left whole."""
    want, labels, real = {tuple(r) for r in jaccard.join(docs).collect()}, {}, jaccard.staged_all

    def counted(parts, label, *by):
        parts = list(parts)
        labels[label] = len(parts)
        return real(parts, label, *by)

    seen, stage = {}, jaccard.staged
    monkeypatch.setattr(jaccard, "staged_all", counted)
    monkeypatch.setattr(jaccard, "staged", lambda df, label: seen.setdefault(label, stage(df, label)))
    monkeypatch.setattr(jaccard, "discard", lambda *tables: None)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        got = {tuple(r) for r in jaccard.join(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == want
    assert labels == {"op7-texts": 2, "op7-half": 2, "op7-links": 2, "op7-more": 2}
    tokens = {(r["token"], r["s1"]) for r in seen["op7-matrix"].collect()}
    assert all((r["token"], r["q"]) in tokens for r in seen["op7-opened"].collect()) and "op7-cross" in seen


def _one_of_each_group(rows):
    """Brute force: doc_id and text of the rows that stay."""
    sets = [{tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set() for w in ((t or "").lower().split() for _, t in rows)]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    best, alone = {}, set()
    for i, (d, t) in enumerate(rows):
        if sets[i]:
            best.setdefault(group[i], []).append(d)
        else:
            alone.add((i if d is None else -1, d, t))
    return sorted([min((d for d in ids if d is not None), default=None) for ids in best.values()] + [d for _, d, _ in alone], key=repr)


COPIES = [(1, BASE), (1, BASE), (1, PASSAGE), (1, PASSAGE), (None, BASE), (None, BASE), (2, BASE), (None, BASE + " tail"), (None, _text(80)), (None, ROWS[8][1]), (None, ROWS[8][1]), (9, None), (9, None), (9, ""), (None, ""), (None, ""), (7, ROWS[7][1])]


def test_pipeline_keeps_one_of_each_group(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    rows = spark.createDataFrame([(i, t, "clash", 0) for i, t in COPIES], SCHEMA).repartition(3).cache()
    out = corpus_pipeline.drop_near_duplicates(spark, rows, "")
    assert out.columns == rows.columns
    assert sorted((r["doc_id"] for r in out.collect()), key=repr) == _one_of_each_group(COPIES)
    assert corpus_pipeline.drop_near_duplicates(spark, rows.limit(0), "").count() == 0
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[1:])  # without the classifier, which has no labels here
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = Counter(d for d in _one_of_each_group(COPIES))
    assert Counter(r["doc_id"] for r in pieces if r["offset"] is not None) - want == Counter() and {r["doc_id"] for r in pieces} == set(want)


def test_token_shards(docs, empty):
    from tokenizers import Tokenizer

    tok, at = Tokenizer.from_file(TOKENIZER), 0
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in sstable.token_shards(docs, TOKENIZER).collect()))
    for (start, d, n, crc), want in zip(got, sorted((d for d, _ in ROWS), key=lambda d: (d is not None, d or 0))):
        assert (start, d) == (at, want)
        ids = tok.encode(dict(ROWS)[d] or "", add_special_tokens=False).ids + [2]
        assert (n, crc) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += n
    assert len(got) == len(ROWS) and sstable.token_shards(empty, TOKENIZER).count() == 0


def test_shard_lookup():
    out = io.BytesIO()
    w = sstable.Writer(out)
    for i in [None, -5, *range(0, 40_000, 2)]:
        w.add(i, np.array([i or 0, 7]) % 50_000)
    w.close()
    r = sstable.Reader(out)
    assert r.get(20_000)[0].tolist() == [20_000, 7] and r.get(None) and r.get(-5) and not r.get(20_001)
    assert len(r.at) > 1 and sum(1 for _ in r.scan()) == 20_002


def test_packing(docs, empty):
    rows = packing.pack(docs, TOKENIZER).collect()
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    assert sum(r["length"] for r in rows) == sum({(r["doc_id"], r["doc_tokens"]): r["doc_tokens"] for r in rows}.values()) + next(r["doc_tokens"] for r in rows if r["doc_id"] == 10)
    assert packing.pack(empty, TOKENIZER).count() == 0


def test_plan_covers_demand():
    widths, demand = np.array([3, 5, 7, 11]), np.array([40, 33, 21, 18])
    parts = packing.plan(widths, demand, 16)
    assert (sum(a * t for a, t in parts) == demand).all() and all(a @ widths <= 16 for a, _ in parts)
    assert sum(t for _, t in parts) <= -(-int(widths @ demand) // 16) + 4


def test_warc(spark):
    pages = spark.createDataFrame([(1, "http://a", "x"), (2, "http://b", "x"), (3, None, None), (4, "u", ""), (None, "n", "x"), (5, "v", "é" * 9)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive(pages).collect()}
    assert got == {1: (1, "revisit", 2), 2: (1, "response", None), 3: (0, "revisit", 4), 4: (0, "response", None), None: (1, "revisit", 2), 5: (18, "response", None)}
    assert warc.archive(pages.limit(0)).count() == 0


def test_pii(docs, empty):
    s = ROWS[9][1]
    assert [s[a:e] for a, _, e in pii.base_spans(s)] == ["a.b@c.example.org", "10.0.0.1", "4111111111111111", "+1 (487) 555-7209"]
    assert pii.base_spans("1.2.3.4.5.6.7.8 300.1.1.1 a@b a@b.c_d@e.f 4111111111111112") == [(0, 1, 7), (8, 1, 15), (30, 0, 35), (35, 0, 41)]
    model = pii.train(docs)
    rows = pii.find(docs, model).collect()
    assert len(rows) == len(ROWS) and all((r["n_email"], r["n_card"]) == ((1, 1) if r["doc_id"] == 10 else (0, 0)) for r in rows)
    assert next(r["base_sha256"] for r in rows if r["doc_id"] == 4) == hashlib.sha256(b"").hexdigest()
    assert "<EMAIL>" in next(r["text"] for r in pii.redact(docs, model).collect() if r["doc_id"] == 10)
    assert pii.find(empty, model).count() == 0
    held = pii.made_up(400, seed=99)
    found = pii.model_spans(model, [t for t, _ in held])
    beyond = [f == w for f, (t, w) in zip(found, held) if w and not pii.base_spans(t)]
    assert len(beyond) > 90 and sum(beyond) >= 0.75 * len(beyond)  # spellings that the patterns miss
    assert sum(bool(f) for f, (_, w) in zip(found, held) if not w) <= 0.03 * len(held)  # lookalikes


def _contract_spans(s):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", s)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", s) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", s):
        d = [int(c) for c in m.group() if c not in " -"]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", s) if 10 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return sorted(out)


def test_pii_base_spans_are_the_contract_s(spark):
    r = random.Random(5)
    odd = "01234567890123456789@.+- ()%_ab\n\u00b2\u2460\u0663"
    texts = ["".join(r.choice(odd) for _ in range(r.randint(0, 60))) for _ in range(4000)]
    texts += [f"x {r.choice(['4111 1111 1111 1111', '4111-1111-1111-1111', '378282246310005', '1.2.3.4.5', '256.1.1.1', '+49 30 1234567', 'a.b@c.de.f_', '@a.b', '415\u2460-555-1234'])}{r.choice(odd)}" for _ in range(600)]
    assert all(pii.base_spans(t) == _contract_spans(t) for t in texts)
    model = pii.Tagger()
    model.fit(*pii.labelled(texts[0] + " 10.0.0.1", pii.base_spans(texts[0] + " 10.0.0.1"), [0]), epochs=1)
    pii.model_spans(model, texts[:400])  # odd digits are no digits
    for r_, t in zip(pii.find(spark.createDataFrame(list(enumerate(texts[:300])), "doc_id long, text string"), model).orderBy("doc_id").collect(), texts):
        want = _contract_spans(t)
        assert [r_[f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == i for x in want) for i in range(4)]
        assert r_["base_sha256"] == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{e}" for a, k, e in want).encode()).hexdigest()


def test_pii_samples_windows_of_long_texts(spark):
    rows = [(0, "word " * 9000 + "call +1 (487) 555-7209 now"), (1, "a1 " * 40)] + [(i, rows_text) for i, rows_text in enumerate(["mail x@y.example.org"] * 50, 2)]
    x, y = pii.sample(spark.createDataFrame(rows, "doc_id long, text string"), 40)
    assert len(x) == len(np.unique(x, axis=0)) <= 40 and {int(t) for t in y.ravel()} >= {1, 7}


def _plain_chance(m, classes, ids, end_id):
    """Log probability of each id of one text, place by place, without batches."""
    out, soft = [], lambda z: z - np.log(np.exp(z - z.max()).sum()) - z.max()
    seq = [end_id, *ids[:-1]]
    for i, target in enumerate(ids):
        own = i // lm.HALF * lm.HALF  # where the id's half window starts
        seen = range(max(0, own - lm.HALF), i + 1)
        x = np.array([m.p["E"][seq[j]] + m.p["P"][j - own + lm.HALF] for j in seen], float)
        w = np.exp(soft(x @ m.p["K"] @ (x[-1] @ m.p["Q"]) / np.sqrt(m.dim)))
        u = np.maximum((x[-1] + w @ (x @ m.p["V"])) @ m.p["A"] + m.p["a"], 0)
        group, k = divmod(int(classes.of[target]), m.width)
        out.append(soft(u @ m.p["B"] + m.p["b"])[group] + soft(u @ m.p["C"][group] + m.p["c"][group])[k] + classes.log_within[target])
    return np.array(out)


def test_lm_blocks_hold_the_ids_of_their_texts(spark):
    """Also where two partitions hold the same rows, and in blocks that share words."""
    rows = [(1, "Alpha beta, beta\u00e9 gamma"), (2, "x" * 700 + " beta"), (3, ""), (4, None), (5, "\u00ff zeta alpha")]
    more = [(i, "beta zeta") for i in range(6, 11)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows + rows + more, 3), "doc_id long, text string")
    encoded, _, (n, v, ends) = lm.prepare(docs, TOKENIZER, 50256)
    enc, texts, found, train = lm.encoder(TOKENIZER), dict(rows + more), Counter(), Counter()
    for d, _ in rows + rows + more:
        if not lm.held_out(d):
            train.update((texts[d] or "").lower().split())
    for b in encoded.toArrow().to_batches():
        for blk in lm._one_by_one([b]):
            counts = blk.c[blk.codes]
            for i, d in enumerate(blk.docs):
                words = (texts[d] or "").lower().split()
                found[d] += 1
                assert blk.ids(i, i + 1, 50256)[2].tolist() == [k for w in words for k in enc.encode([b" " + w.encode()])[0].tolist()] + [50256]
                assert counts[blk.first[i] : blk.first[i + 1]].tolist() == [train[w] for w in words]
    assert found == Counter(d for d, _ in rows + rows + more) and n == sum(train.values()) + ends and v == len(train) + 1


def test_lm_gradient_and_base(docs, empty, monkeypatch):
    model = lm.Attention(20, 6, dim=4, hidden=5)
    for k in "BbCc":
        model.p[k] = R.normal(0, 0.3, model.p[k].shape).astype(np.float32)
    ids = R.integers(0, 20, (3, lm.CONTEXT))
    pad, target = np.zeros(ids.shape, bool), R.integers(0, 6, (3, lm.HALF))
    target[1, 5] = -1
    _, g, _ = model.loss(ids, pad, target)
    for k, at in (("Q", (1, 2)), ("V", (1, 2)), ("A", (1, 2)), ("B", (1, 1)), ("C", (1, 2, 1)), ("c", (0, 1)), ("P", (20, 1))):
        model.p[k][at] += 1e-2
        up = model.loss(ids, pad, target)[0]
        model.p[k][at] -= 2e-2
        down = model.loss(ids, pad, target)[0]
        model.p[k][at] += 1e-2
        assert abs((up - down) / 2e-2 - g[k][at]) < 2e-3
    classes = lm.Classes(R.integers(0, 50, 20).astype(float), np.arange(20) % 2 == 0, 19, single=2, pools=2)
    model = lm.Attention(20, classes.number, dim=4, hidden=5, size=classes.size)
    for k in "BCQKVP":
        model.p[k] = R.normal(0, 0.5, model.p[k].shape).astype(np.float32)
    counts = np.array([1, 15, 16, 17, 70])
    flat = R.integers(0, 20, counts.sum())
    want = np.concatenate([_plain_chance(model, classes, t.tolist(), 19) for t in np.split(flat, np.cumsum(counts)[:-1])])
    for batch in (2, 1024):
        assert np.allclose(lm.log_prob(model, classes, flat, counts, 19, batch=batch), want, atol=1e-4)
    models, fit = [], lm.train
    monkeypatch.setattr(lm, "train", lambda *a, **k: models.append((fit(*a, **k), a[1])) or models[-1][0])
    rows = lm.score(docs, TOKENIZER).collect()
    train = Counter()
    for d, t in ROWS:
        if not lm.held_out(d):
            train.update((t or "").lower().split())
            train["\n"] += 1
    n, v = sum(train.values()), len(train)
    texts = dict(ROWS)
    log = lambda x: np.log10((train[x] + 0.5) / (n + 0.5 * (v + 1)))
    enc = lm.encoder(TOKENIZER)
    for r in rows:
        toks = [*(texts[r["doc_id"]] or "").lower().split(), "\n"]
        assert r["train_tokens"] == n and r["n_tokens"] == len(toks)
        assert abs(r["base_score"] - sum(map(log, toks))) < 1e-6 * len(toks)
        if len(toks) < 200:
            parts = [*(enc.encode([b" " + x.encode()])[0].tolist() for x in toks[:-1]), [50256]]
            each = _plain_chance(*models[0], [i for p in parts for i in p], 50256)
            ends = np.cumsum([len(p) for p in parts])
            word = [10 ** log(x) / 2 + np.exp(each[e - len(p) : e].sum()) / 2 for x, e, p in zip(toks, ends, parts)]
            assert abs(r["score"] - np.log10(word).sum()) < 1e-3 * len(toks)
    assert len(rows) == len(ROWS) and lm.score(empty, TOKENIZER).count() == 0


def test_lm_windows_of_a_share_cover_every_text():
    counts = np.array([1, 40, 16, 500, 3])
    ids, taken = R.integers(0, 9, counts.sum()), []
    for offset in range(4):
        x, pad, target = lm.windows(ids, counts, 9, 4, offset)
        taken.append(target[target >= 0])
        assert len(x) == len(range(offset, int((-(-counts // lm.HALF)).sum()), 4))
    assert sorted(np.concatenate(taken).tolist()) == list(range(counts.sum()))


def test_lm_trains_on_texts_of_any_length(spark):
    rows = [(i, _text(30)) for i in range(320)] + [(i, _text(12_000)) for i in range(320, 330) if not lm.held_out(i)]
    assert len(rows[-1][1]) > 20_000
    encoded, classes, _ = lm.prepare(spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER, 50256)
    vocab = lm.encoder(TOKENIZER).tok.get_vocab_size()
    start = lm.Attention(vocab, classes.number)
    ids = np.unique(lm.encoder(TOKENIZER).encode(["".join(" " + t for d, t in rows if not lm.held_out(d)).encode()])[0])
    for share, least in ((1, 1.0), (16, 0.9)):
        model = lm.train(encoded, classes, 50256, vocab, share=share)
        assert (model.p["E"] != start.p["E"]).any(1)[ids].mean() >= least
        unseen = np.setdiff1d(np.arange(vocab), np.append(ids, 50256))
        assert np.ptp(model.p["E"][unseen], axis=0).max() == 0


def test_lm_trains_on_every_window(spark):
    docs = [d for d in range(40) if not lm.held_out(d)][:6]
    rows = [(d, " ".join(str(1000 * (i + 1) + 7 * j) for j in range(900))) for i, d in enumerate(docs)]  # ids that few windows hold
    encoded, classes, _ = lm.prepare(spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER, 50256)
    vocab = lm.encoder(TOKENIZER).tok.get_vocab_size()
    ids = np.unique(lm.encoder(TOKENIZER).encode(["".join(" " + w for w in t.split()).encode() for _, t in rows])[0])
    start = lm.Attention(vocab, classes.number)
    moved = (lm.train(encoded, classes, 50256, vocab).p["E"] != start.p["E"]).any(1)
    others = np.setdiff1d(np.arange(vocab), np.append(ids, 50256))
    rest = lm.train(encoded, classes, 50256, vocab).p["E"]
    assert moved[ids].all() and len(np.unique(rest[ids], axis=0)) == len(ids)  # each has its own embedding, none the others' mean
    assert np.ptp(rest[others], axis=0).max() == 0


def test_rules(docs, empty):
    got = {r["doc_id"]: r for r in rules.apply_policy(rules.ledger(docs), "clean-1").collect()}
    assert got[1]["kept"] and not got[4]["kept"] and got[4]["n_words"] == 0
    m = rules._measure([b"a b c a b c\nx\nx\n\n| |"])
    assert (m["n_repeat_words"][0], m["n_dup_lines"][0], m["n_symbols"][0], m["n_lone_symbols"][0]) == (6, 1, 2, 2)
    rows = rules.ledger(docs)
    bits = [r["failed"] for r in rows.collect()]
    for policy, mask in rules.POLICIES.items():
        want = {n: (sum(b & rules.BIT[n] != 0 for b in bits), sum(b & mask == rules.BIT[n] for b in bits), len(bits)) for n in rules.BIT if rules.BIT[n] & mask}
        assert {r["rule"]: (r["failed"], r["only"], r["docs"]) for r in rules.ablation(rows, policy).collect()} == want
        for r in rules.with_ablation(rows, policy).collect():
            hit = [n for n in want if r["failed"] & rules.BIT[n]]
            assert r["kept"] == (not hit) and (r["sole_rule"], r["sole_rule_docs"]) == ((hit[0], want[hit[0]][1]) if len(hit) == 1 else (None, None))
    assert rules.POLICIES["base-1"] == 3 and rules.POLICIES["clean-1"] == 127
    assert rules.with_ablation(rules.ledger(empty), "clean-1").count() == 0


def test_decontamination(spark, docs, empty):
    bench = spark.createDataFrame([(1, PASSAGE), (2, _text(40)), (3, None), (4, "")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()} == {(8, 1), (9, 1)}
    assert decontaminate.contaminated(empty, bench).count() == 0 and decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    items = [(i, " ".join(R.choice(WORDS[:60], 12))) for i in range(200)]
    index = decontaminate.Index(items)
    for _ in range(20):
        terms = np.unique([index.term[x] for x in decontaminate.words(" ".join(R.choice(WORDS[:60], 30)).encode()) if x in index.term])
        score = np.zeros(200)
        for t in terms:
            score[index.items[t]] += index.impacts[t]
        assert {i for i, _ in index.retrieve(terms, 0.6)} == set(np.flatnonzero(score >= 0.6 - 1e-6).tolist())


def test_decontamination_long_items(spark):
    r = np.random.default_rng(7)
    text = lambda n: " ".join(r.choice(WORDS, n))
    items = [(1, text(400)), (2, text(1500)), (3, text(20)), (4, text(65)), (5, text(129)), (6, text(400))]
    edited = " ".join(w if i % 12 else "changed" for i, w in enumerate(items[5][1].split()))
    rows = [(10 + i, text(97 + 50 * i) + " " + t + " " + text(110)) for i, t in items[:5]] + [(16, text(333) + " " + edited + " " + text(90)), (17, text(2000))]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(x["doc_id"], x["item_id"]) for x in decontaminate.contaminated(docs, bench).collect()} == {(10 + i, i) for i, _ in items}


def test_decontamination_blocks_change_nothing(spark):
    r = np.random.default_rng(8)
    items = [(i, " ".join(r.choice(WORDS[: 20 + 10 * (i % 30)], 12 + i % 40))) for i in range(60)]
    rows = [(i, " ".join(r.choice(WORDS, 40)) + " " + " ".join(t.split()[: 3 * len(t.split()) // 5]) + " " + t[-30:]) for i, t in items]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one, four = ({(x["doc_id"], x["item_id"], round(x["score"], 9)) for x in decontaminate.contaminated(docs, bench, block_items=n).collect()} for n in (20_000, 15))
    assert len(one) > 20 and one == four


def test_quality(spark, docs, empty):
    rows = [(i, _text(60) + (" rude" if i % 3 == 0 else "") + (" ### $$$" * 20 if i % 3 == 1 else "")) for i in range(690)]
    rated = spark.createDataFrame([(i, int(i % 3 != 1), int(i % 3 == 0)) for i in range(600)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    text = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["selected"] for r in quality.score(text, quality.train(text, rated)).collect()}
    assert sum(got[i] == (i % 3 == 2) for i in range(600, 690)) >= 81
    none = quality.train(docs, rated.limit(0))
    assert quality.score(docs, none).count() == len(ROWS) and quality.score(empty, none).count() == 0
