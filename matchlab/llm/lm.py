"""Language-model scoring: a causal self-attention model trained in numpy on subword ids.

Texts are lowered (A-Z) and read as words; a word's subword ids are those of a space and the word. The model predicts
the class of the next id from the last 32 ids (one attention head, a hidden layer, a softmax in two levels over about
256 classes; the most frequent ids are classes of their own) and an id within its class from counts over all training
texts: P(id | context) = P(class | context) * P(id | class). A word's chance is half that of its ids and half its share
of all training words, the unigram model that the base score uses alone. Context windows overlap by half, each id is
scored once, in the half that has context, and batches of windows go through one masked attention.

1. Blocks of documents keep their words as numbers into the block's word list, which is sorted by hash.
2. Each block sends its words as one row per range of hashes. There counts over all training documents are summed, and
   every distinct word is encoded once, which also gives the subword counts.
3. Counts and subword ids go back to the blocks, again as one row per range, and the blocks are written with them.
4. The network starts from the classes' shares of all training ids and is fitted on every window of every training text:
   each place is a target once. Each of `rounds` passes takes its part of the texts: Adam reads the blocks of a task one
   after another, from the same start again after every `length` windows, and the outcomes are averaged (an id's embedding
   over those that hold it, by its places there). The scores are then one more pass over the blocks.

Blocks are numbered by their documents and sums are made in the order of these numbers, so two runs over the same files
give the same scores; other files or task sizes make other blocks, and scores that differ a little.

Edge cases: a null or empty text is the end token alone; rows that repeat a doc_id are scored each; a null doc_id hashes
as an empty text; without training documents all counts are 0 and the network stays at its start; an empty table gives
no rows; other columns are ignored. Texts of any length are scored whole.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, discard, hash_words, keyed, slices, staged, text_chunks
from .tokens import encoder

HALF = 16
CONTEXT = 2 * HALF
FOLDS, HELD = 5, 1
BLOCK_BYTES = 8_000_000


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD


class Classes:
    """The most frequent ids stand alone; the others are pooled by frequency, ids that begin a word apart from others."""

    def __init__(self, counts: np.ndarray, begins: np.ndarray, end_id: int, single: int = 207, pools: int = 24):
        order = np.argsort(-counts, kind="stable")
        order = np.r_[end_id, order[order != end_id]]
        self.of = np.empty(len(counts), np.int64)
        self.of[order[: single + 1]] = np.arange(min(single + 1, len(order)))
        rest, self.number = order[single + 1 :], single + 1
        for kind in (True, False):
            ids = rest[begins[rest] == kind]
            if len(ids):
                mass = np.cumsum(counts[ids] + 0.5)
                self.of[ids] = self.number + np.minimum((mass * pools / mass[-1]).astype(int), pools - 1)
                self.number += pools
        self.size = np.bincount(self.of, weights=counts + 0.5, minlength=self.number)
        self.log_within = np.log((counts + 0.5) / self.size[self.of])


class Attention:
    """Weights: E ids, P places, Q, K, V attention, A, a hidden layer; a class is number `own` of its group: B, b give
    the groups' scores, C, c those within each group."""

    def __init__(self, vocab: int, classes: int, dim: int = 24, hidden: int = 48, seed: int = 5, size: np.ndarray | None = None):
        """size: the classes' counts, from which the scores start."""
        r = np.random.default_rng(seed)
        g = lambda a, b: (r.normal(0, 1 / math.sqrt(a), (a, b))).astype(np.float32)
        self.dim, self.width = dim, max(1, math.isqrt(max(0, classes - 1)) + 1)
        groups = -(-classes // self.width)
        share = np.zeros(groups * self.width)
        share[:classes] = 1 if size is None else size
        share = share.reshape(groups, self.width)
        with np.errstate(divide="ignore"):
            b, c = np.log(share.sum(1) / share.sum()), np.maximum(np.log(share / share.sum(1, keepdims=True)), -30)
        self.p = {
            "E": r.normal(0, 0.3, (vocab, dim)).astype(np.float32), "P": r.normal(0, 0.3, (CONTEXT, dim)).astype(np.float32), "Q": g(dim, dim), "K": g(dim, dim), "V": g(dim, dim), "A": g(dim, hidden), "a": np.zeros(hidden, np.float32),
            "B": np.zeros((hidden, groups), np.float32), "b": b.astype(np.float32), "C": np.zeros((groups, hidden, self.width), np.float32), "c": c.astype(np.float32),
        }
        self.seen = np.tri(HALF, CONTEXT, HALF, dtype=np.float32)  # query i stands at HALF+i; it sees places up to its own

    def head(self, u: np.ndarray, target: np.ndarray):
        """Log probability of each row's class, and what the way back needs: rows by group, both levels' shares."""
        p, at = self.p, np.arange(len(u))
        group = (target // self.width).astype(np.uint8 if len(p["b"]) < 256 else np.int64)
        own = target - self.width * group.astype(target.dtype)
        order = np.argsort(group, kind="stable")
        ends = np.r_[0, np.cumsum(np.bincount(group, minlength=len(p["b"])))]
        sorted_u, z2 = u.take(order, 0, mode="clip"), np.empty((len(u), self.width), np.float32)
        for k, (a, e) in enumerate(zip(ends, ends[1:])):
            if e > a:
                np.matmul(sorted_u[a:e], p["C"][k], out=z2[a:e])
                z2[a:e] += p["c"][k]
        z1 = u @ p["B"]
        z1 += p["b"]
        out, parts = np.zeros(len(u), np.float32), []
        for z, pick, back in ((z1, group, None), (z2, own[order], order)):
            np.clip(z, -60, 60, out=z)
            chosen = z[at, pick]
            np.exp(z, out=z)
            total = z @ np.ones(z.shape[1], np.float32)
            chosen -= np.log(total)
            if back is None:
                out += chosen
            else:
                out[back] += chosen
            parts.append((z, total))
        return out, (group, own, order, ends, sorted_u, parts)

    def layer(self, x: np.ndarray, first: np.ndarray):
        """x (windows, CONTEXT, dim): embeddings at their places. The hidden layer at each of the last HALF places, and what
        the way back needs. A place sees the window up to itself, or its own half alone where the window is a `first` one.
        A query meets embeddings (Q and K as one matrix), and their weighted sums meet V and A as one matrix, so keys and
        values of single ids are never made."""
        p, n, d = self.p, len(x), self.dim
        own = np.empty((n * HALF, 2 * d), np.float32)  # a place's embedding, its weighted sum
        own[:, :d].reshape(n, HALF, d)[...] = x[:, HALF:]
        q = (own[:, :d] @ (p["Q"] @ p["K"].T / np.float32(math.sqrt(d)))).reshape(n, HALF, d)
        s = q @ x.transpose(0, 2, 1)
        np.clip(s, -60, 60, out=s)
        np.exp(s, out=s)
        s *= self.seen
        s[first, :, :HALF] = 0
        weight = s.reshape(-1, CONTEXT) @ np.ones(CONTEXT, np.float32)
        np.divide((s @ x).reshape(-1, d), weight[:, None], out=own[:, d:])
        u = own @ np.concatenate([p["A"], p["V"] @ p["A"]])
        u += p["a"]
        return np.clip(u, 0, np.float32(np.inf), out=u), (own, q, s, weight)

    def blocks(self, ids: np.ndarray, first: np.ndarray):
        """The hidden layer at every place of blocks (ids: blocks, HALF) of texts; a block sees itself up to each place and
        the block before it, unless it is its text's first."""
        p, n, d = self.p, len(ids), self.dim
        z = p["E"].take(ids.ravel(), 0, mode="clip").reshape(n, HALF, d)
        x = np.empty((n, CONTEXT, d), np.float32)  # the block before, the block
        np.add(z[:-1], p["P"][:HALF], out=x[1:, :HALF])
        x[0, :HALF] = 0
        np.add(z, p["P"][HALF:], out=x[:, HALF:])
        alone = first.copy()
        alone[:1] = True
        return self.layer(x, np.flatnonzero(alone))[0]

    def loss(self, ids, pad, target):
        """Mean negative log likelihood over the places with a target (-1: none), and gradients. pad: whether a window's
        first half is there, as in `windows`."""
        p, d = self.p, self.dim
        x = p["E"].take(ids.ravel(), 0, mode="clip").reshape(*ids.shape, d)
        x += p["P"]
        u, (own, q, s, weight) = self.layer(x, np.flatnonzero(pad[:, 0]))
        there = (target >= 0).ravel()
        n = max(1, int(there.sum()))
        chance, (group, pick, order, ends, sorted_u, ((dz1, total1), (dz2, total2))) = self.head(u, np.maximum(target, 0).ravel())
        share, at, ones = there / np.float32(n), np.arange(len(u)), np.ones(len(u), np.float32)
        dz1 *= (share / total1)[:, None]
        dz1[at, group] -= share
        share = share[order]
        dz2 *= (share / total2)[:, None]
        dz2[at, pick[order]] -= share
        g = {"B": u.T @ dz1, "b": ones @ dz1, "C": np.zeros_like(p["C"]), "c": np.zeros_like(p["c"])}
        du, sorted_du = dz1 @ p["B"].T, np.empty_like(sorted_u)
        for j, (a, e) in enumerate(zip(ends, ends[1:])):
            if e > a:
                np.matmul(sorted_u[a:e].T, dz2[a:e], out=g["C"][j])
                np.matmul(ones[a:e], dz2[a:e], out=g["c"][j])
                np.matmul(dz2[a:e], p["C"][j].T, out=sorted_du[a:e])
        back = np.empty_like(order)
        back[order] = at
        du += sorted_du.take(back, 0, mode="clip")
        du *= (u > 0).astype(np.float32)
        to = own.T @ du  # of A, and of V and A as one
        g["A"], g["V"], g["a"] = to[:d] + p["V"].T @ to[d:], to[d:] @ p["A"].T, ones @ du
        down = du @ np.concatenate([p["A"], p["V"] @ p["A"]]).T
        dh = down[:, d:] / weight[:, None]
        shift = np.einsum("ij,ij->i", dh, own[:, d:]).reshape(-1, HALF, 1)
        dh = dh.reshape(q.shape)
        ds = dh @ x.transpose(0, 2, 1)
        ds -= shift
        ds *= s
        dq = (ds @ x).reshape(-1, d)
        to = own[:, :d].T @ dq / np.float32(math.sqrt(d))
        g["Q"], g["K"] = to @ p["K"], to.T @ p["Q"]
        dx = ds.transpose(0, 2, 1) @ q
        dx += s.transpose(0, 2, 1) @ dh
        dq = dq @ (p["K"] @ p["Q"].T / np.float32(math.sqrt(d)))
        dq += down[:, :d]
        dx[:, HALF:] += dq.reshape(q.shape)
        g["P"] = (np.ones(len(dx), np.float32) @ dx.reshape(len(dx), -1)).reshape(CONTEXT, d)
        return -float(chance[there].sum()) / n, g, dx

    def step(self, state: dict, ids, pad, target, rate: float) -> None:
        """One step of Adam; embeddings get sparse Adagrad steps. Weights and state are changed in place."""
        _, g, dx = self.loss(ids, pad, target)
        state["step"] += 1
        t, m, v, d = float(state["step"][0]), state["m"], state["v"], self.joined(g)
        m *= np.float32(0.9)
        m += np.float32(0.1) * d
        v *= np.float32(0.99)
        d *= d
        v += np.float32(0.01) * d
        np.sqrt(v, out=d)
        d *= np.float32(1 / math.sqrt(1 - 0.99**t))
        d += np.float32(1e-8)
        np.divide(m, d, out=d)
        d *= np.float32(rate / (1 - 0.9**t))
        state["flat"] -= d
        u, ge = _sums(ids.ravel(), dx.reshape(-1, self.dim))
        seen = state["seen"][u] + np.einsum("ij,ij->i", ge, ge) / np.float32(self.dim)
        state["seen"][u] = seen
        ge *= (np.float32(5 * rate) / np.sqrt(seen))[:, None]
        self.p["E"][u] = self.p["E"].take(u, 0, mode="clip") - ge

    def joined(self, values: dict) -> np.ndarray:
        """All values but those of single ids, as one vector."""
        return np.concatenate([values[k].ravel() for k in sorted(self.p) if k != "E"])

    def open(self, state: dict) -> None:
        """Make the weights parts of the state's vector `flat`, so that a step changes them at once."""
        state["flat"], at = self.joined(self.p), 0
        for k in sorted(self.p):
            if k != "E":
                self.p[k] = state["flat"][at : at + self.p[k].size].reshape(self.p[k].shape)
                at += self.p[k].size

    def start(self) -> dict:
        """The state before the first step."""
        state = {"step": np.zeros(1), "seen": np.full(len(self.p["E"]), 1e-6, np.float32)}
        self.open(state)
        return state | {k: np.zeros_like(state["flat"]) for k in ("m", "v")}

    def copy(self, state: dict) -> tuple[Attention, dict]:
        m = Attention.__new__(Attention)
        m.__dict__.update(self.__dict__, p={k: x.copy() for k, x in self.p.items()})
        state = {k: x.copy() for k, x in state.items()}
        m.open(state)
        return m, state

    def dense(self, state: dict) -> np.ndarray:
        """All weights and state but those of single ids, as one vector."""
        return np.concatenate([state[k] for k in ("step", "flat", "m", "v")]).astype(np.float64)

    def take(self, state: dict, flat: np.ndarray) -> None:
        state["step"] = flat[:1].copy()
        state["flat"][:], state["m"], state["v"] = np.split(flat[1:].astype(np.float32), 3)


def _sums(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ids, the sum of each one's rows). Ids with one or two rows, most of them, need no loop over runs."""
    order = np.argsort(ids, kind="stable")
    s = ids[order]
    first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    n = np.diff(np.r_[first, len(s)])
    out = rows.take(order[first], 0, mode="clip")
    two = np.flatnonzero(n == 2)
    out[two] += rows.take(order[first[two] + 1], 0, mode="clip")
    more = np.flatnonzero(n > 2)
    if len(more):
        k = n[more]
        runs = rows.take(order[slices(first[more], k)], 0, mode="clip").T
        out[more] = np.add.reduceat(np.ascontiguousarray(runs), np.cumsum(k) - k, axis=1).T
    return s[first], out


def windows(ids: np.ndarray, counts: np.ndarray, end_id: int, share: int = 1, offset: int = 0):
    """(ids, pad, targets' places) of one in `share` windows: each text, after a start mark, in windows that move by
    HALF. Row r's last HALF places predict the ids that follow them; place -1 is none. `ids` holds every text's ids, its
    end included."""
    x, at, first = _halves(ids, counts, end_id)
    target = np.full(x.size, -1)
    target[at] = np.arange(len(ids))
    number = np.arange(offset, len(x), share)
    before = x[number - 1]  # row 0 is a first one
    before[first[number]] = end_id
    pad = np.zeros((len(number), CONTEXT), bool)
    pad[:, :HALF] = first[number, None]
    return np.concatenate([before, x[number]], axis=1), pad, target.reshape(-1, HALF)[number]


def _halves(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text, after a start mark, in blocks of HALF: (the id before each place, each id's place, whether a block is its
    text's first)."""
    rows = -(-counts // HALF)
    base, start = np.cumsum(rows) - rows, np.cumsum(counts) - counts
    at = np.arange(len(ids)) + np.repeat(base * HALF - start, counts)
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[start] = end_id
    n = int(rows.sum())
    x, first = np.full(n * HALF, end_id, ids.dtype), np.zeros(n, bool)
    x[at], first[base] = before, True
    return x.reshape(n, HALF), at, first


def log_prob(model: Attention, classes: Classes, ids: np.ndarray, counts: np.ndarray, end_id: int, batch: int = 256) -> np.ndarray:
    """Natural log probability of each id given those before it in its text; bounded batches of blocks of HALF ids."""
    if not len(ids):
        return np.empty(0)
    x, at, first = _halves(ids, counts, end_id)
    n = len(x)
    target, found = np.zeros(n * HALF, classes.of.dtype), np.empty(n * HALF, np.float32)
    target[at] = classes.of[ids]
    for a in range(0, n, batch):
        e, lead = min(n, a + batch), int(a > 0)
        u = model.blocks(x[a - lead : e], first[a - lead : e])[lead * HALF :]
        found[a * HALF : e * HALF] = model.head(u, target[a * HALF : e * HALF])[0]
    return found[at] + classes.log_within[ids]


def mixed(each: np.ndarray, lens: np.ndarray, unigram: np.ndarray) -> np.ndarray:
    """Natural log probability of each word: half the network's chance of its ids, half its share of all words."""
    return np.logaddexp(np.add.reduceat(each, np.cumsum(lens) - lens), unigram) + math.log(0.5)


#: Lowers A-Z and makes each kind of white space a space.
_PLAIN = bytes(32 if 9 <= i <= 13 else i + 32 if 65 <= i <= 90 else i for i in range(256))


def _numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """As word_codes of lowered texts, by Arrow: no Python object for each word."""
    found = pc.split_pattern(pa.array([t.translate(_PLAIN) for t in texts], pa.binary()), b" ")
    coded = found.flatten().dictionary_encode()
    codes, words, ends = coded.indices.to_numpy(), coded.dictionary, found.offsets.to_numpy()
    empty = pc.index(words, pa.scalar(b"", words.type)).as_py()
    if empty >= 0:
        keep = codes != empty
        ends, codes = np.r_[0, np.cumsum(keep)][ends], codes[keep]
        codes = codes - (codes > empty)
        words = pa.concat_arrays([words[:empty], words[empty + 1 :]])
    return codes, np.diff(ends), words


def _blocks(docs: DataFrame) -> DataFrame:
    """One row per block: its documents, the words' numbers, the distinct words in the order of their hashes, and their
    counts in training texts. Numbers and lengths are packed, so a block is a few large values."""

    def run(batches):
        texts, docs, ths, size = [], [], [], 0

        def close():
            codes, lens, words = _numbered(texts)
            sizes, words = pc.binary_length(words).to_numpy(), words.to_numpy(zero_copy_only=False)
            order = np.argsort(hash_words(words), kind="stable")
            place = np.empty(len(words), np.int32)
            place[order] = np.arange(len(words), dtype=np.int32)
            codes = place[codes]
            train = np.bincount(codes[np.repeat([not held_out(i) for i in docs], lens)], minlength=len(words))
            # numbered by its documents: the same in every run and attempt
            block = xxhash.xxh3_64_intdigest(repr((docs, ths)).encode()) >> 1
            packed = [codes.astype("<i4").tobytes(), b"".join(words[order]), sizes[order].astype("<u4").tobytes(), train.astype("<u4").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([block]), *(pa.array([x], pa.list_(pa.int64())) for x in (docs, ths, lens)), *(pa.array([x], pa.binary()) for x in packed)], names=["block", "docs", "ths", "lens", "codes", "words", "sizes", "train"])

        for b, some in text_chunks(batches, limit=2_000_000):
            texts += some
            docs += column(b, "doc_id").to_pylist()
            ths += column(b, "th").to_pylist()
            size += sum(map(len, some))
            if size >= BLOCK_BYTES:
                yield close()
                texts, docs, ths, size = [], [], [], 0
        if docs:
            yield close()

    return staged(keyed(docs).mapInArrow(run, "block long, docs array<long>, ths array<long>, lens array<long>, codes binary, words binary, sizes binary, train binary"), "op5-blocks")


def _packed_words(words: bytes, sizes: bytes) -> list[bytes]:
    ends = np.cumsum(np.frombuffer(sizes, "<u4"), dtype=np.int64).tolist()
    return [words[a:e] for a, e in zip([0, *ends], ends)]


def _compact(x: np.ndarray) -> bytes:
    return x.astype("<u4" if not len(x) or x.max() < 1 << 32 else "<u8").tobytes()


REPLY = "bucket long, block long, c binary, sub binary, flat binary, id array<long>, n array<long>, total long, known long"


def _replies(blocks: DataFrame, tokenizer: str, buckets: int) -> DataFrame:
    """For each block and range of word hashes the words' counts over all training texts and their subword ids, in the
    block's order; and per range, as block -1, the counts of subword ids, of words and of distinct ones. A block sends its
    words of a range as one row, so what moves is the words themselves, and each word is encoded once."""

    def ask(batches):
        for b in batches:
            for i in range(b.num_rows):
                block, words, sizes, train = (column(b, c)[i].as_py() for c in ("block", "words", "sizes", "train"))
                h = hash_words(_packed_words(words, sizes))
                bucket = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)  # rises with the hash
                at = np.searchsorted(bucket, np.arange(buckets + 1))
                ends = np.r_[0, np.cumsum(np.frombuffer(sizes, "<u4"), dtype=np.int64)]
                rows = [(k, block, words[ends[a] : ends[e]], sizes[4 * a : 4 * e], train[4 * a : 4 * e]) for k, (a, e) in enumerate(zip(at.tolist(), at[1:].tolist())) if e > a]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["bucket", "block", "words", "sizes", "train"])

    def answer(batches):
        enc, held, at = encoder(tokenizer), [], None
        small = "<u2" if enc.tok.get_vocab_size() <= 1 << 16 else "<u4"

        def close():
            number: dict[bytes, int] = {}
            places = [np.fromiter((number.setdefault(w, len(number)) for w in _packed_words(w, s)), np.int64, len(s) // 4) for _, w, s, _ in held]
            c = np.zeros(len(number), np.int64)
            for p, (_, _, _, t) in zip(places, held):
                c[p] += np.frombuffer(t, "<u4")  # no word comes twice in a block
            ids, lens = enc.words(list(number))
            ids = ids.astype(small)
            start = np.cumsum(lens) - lens
            for p, (block, *_) in zip(places, held):
                yield row(at, block, _compact(c[p]), lens[p].astype("<u4").tobytes(), ids[slices(start[p], lens[p])].tobytes(), [], [], 0, 0)
            sums = np.zeros(enc.tok.get_vocab_size(), np.int64)
            np.add.at(sums, ids, np.repeat(c, lens))
            of = np.flatnonzero(sums)
            yield row(at, -1, b"", b"", b"", of, sums[of], int(c.sum()), int((c > 0).sum()))

        for b in batches:
            for bucket, *chunk in zip(*(c.to_pylist() for c in b.columns)):
                if bucket != at and held:
                    yield from close()
                    held = []
                at = bucket
                held.append(chunk)
        if held:
            yield from close()

    def row(*values):
        types = [pa.int64(), pa.int64(), *[pa.binary()] * 3, *[pa.list_(pa.int64())] * 2, pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=[c.split()[0] for c in REPLY.split(", ")])

    asked = blocks.select("block", "words", "sizes", "train").mapInArrow(ask, "bucket long, block long, words binary, sizes binary, train binary")
    met = asked.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block")
    return staged(met.mapInArrow(answer, REPLY), "op5-words")


def _training(doc_id: str):
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) != HELD


def prepare(docs: DataFrame, tokenizer: str, end_id: int) -> tuple[DataFrame, Classes, tuple[int, int, int]]:
    """Blocks with their words' counts and subword ids, the classes of ids, and the number of training tokens, of
    distinct ones and of training texts."""
    blocks = _blocks(docs)
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks.count() // 2)  # a range holds what few blocks hold
    words = _replies(blocks, tokenizer, buckets)
    ends = blocks.select(F.explode("docs").alias("doc_id")).filter(_training("doc_id")).count()
    sums = words.filter("block < 0")
    total = sums.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n"), F.coalesce(F.sum("known"), F.lit(0)).alias("v")).first()
    vocab = encoder(tokenizer).tok.get_vocab_size()
    counts = np.zeros(vocab)
    for r in sums.select(F.inline(F.arrays_zip("id", "n"))).groupBy("id").agg(F.sum("n").alias("c")).collect():  # at most the tokenizer's ids
        counts[r["id"]] = r["c"]
    counts[end_id] += ends
    tok = encoder(tokenizer).tok
    begins = np.array([(tok.id_to_token(i) or "").startswith("Ġ") for i in range(vocab)])

    def run(block: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("bucket").drop_duplicates("bucket")  # blocks of the same rows ask, and are told, the same
        c = [np.frombuffer(x, "<u4" if len(x) == len(s) else "<u8") for x, s in zip(known["c"], known["sub"])]
        packed = _compact(np.concatenate(c)) if c else b""
        return block.assign(c=[packed] * len(block), sub=[b"".join(known["sub"])] * len(block), flat=[b"".join(known["flat"])] * len(block))

    schema = "block long, docs array<long>, ths array<long>, lens array<long>, codes binary, c binary, sub binary, flat binary"
    known = words.filter("block >= 0").select("block", "bucket", "c", "sub", "flat")
    encoded = blocks.select("block", "docs", "ths", "lens", "codes").groupBy("block").cogroup(known.groupBy("block")).applyInPandas(run, schema)
    encoded = staged(encoded, "op5-encoded")
    discard(blocks, words)
    return encoded, Classes(counts, begins, end_id), (total["n"] + ends, total["v"] + (ends > 0), ends)


class _Block:
    """An encoded block's arrays, and its texts' subword ids in parts of about 100,000 words."""

    def __init__(self, b: pa.RecordBatch, i: int):
        get = lambda name: column(b, name)[i].as_py()
        self.number, self.docs, self.ths, self.counts = get("block"), get("docs"), get("ths"), np.array(get("lens"), np.int64)
        c, sub, flat = get("c"), get("sub"), get("flat")
        self.codes, self.c = np.frombuffer(get("codes"), "<i4"), np.frombuffer(c, "<u4" if len(c) == len(sub) else "<u8").astype(np.int64)
        self.sub = np.frombuffer(sub, "<u4").astype(np.int64)
        self.flat = np.frombuffer(flat, "<u2" if len(flat) == 2 * self.sub.sum() else "<u4")
        self.start = np.cumsum(self.sub) - self.sub
        self.held = np.array([held_out(d) for d in self.docs], bool)
        self.first = np.r_[0, np.cumsum(self.counts)]
        at = np.r_[0, np.flatnonzero(np.diff(np.cumsum(self.counts) // 100_000)) + 1, len(self.counts)]
        self.parts = [(int(x), int(y)) for x, y in zip(at, at[1:]) if y > x]

    def ids(self, a: int, e: int, end_id: int):
        """Of texts a to e: words, subwords of each word, ids with the texts' ends, ids of each text."""
        w = self.codes[self.first[a] : self.first[e]]
        sub = self.sub[w]
        doc = np.repeat(np.arange(e - a), self.counts[a:e])
        k = np.bincount(doc, weights=sub, minlength=e - a).astype(np.int64)
        ids = self.flat[np.arange(int(sub.sum())) - np.repeat(np.cumsum(sub) - sub - self.start[w], sub)].astype(np.int64)
        return w, sub, np.insert(ids, np.cumsum(k), end_id), k + 1

    def ids_of(self, texts: np.ndarray, end_id: int):
        """As ids, without the words, of any texts."""
        lens = self.counts[texts]
        w = self.codes[slices(self.first[texts], lens)]
        sub = self.sub[w]
        k = np.bincount(np.repeat(np.arange(len(texts)), lens), weights=sub, minlength=len(texts)).astype(np.int64)
        return np.insert(self.flat[slices(self.start[w], sub)], np.cumsum(k), end_id), k + 1


def _one_by_one(batches):
    for b in batches:
        for i in range(b.num_rows):
            yield _Block(b, i)


BUCKETS, RANGES = 64, 32
LAST = (1 << 63) - 1


def train(encoded: DataFrame, classes: Classes, end_id: int, vocab: int, rounds: int = 2, share: int = 1, batch: int = 128, rate: float = 0.02, seed: int = 5, length: int = 12_000) -> Attention:
    """Fit on every window of every training text, of a part of the texts in each round; the rate falls to 0 over the
    rounds. batch: windows of a step, fewer where a part of a block has few. share: a caller may fit on one in so many windows instead; the query does not."""
    spark = encoded.sparkSession
    model = Attention(vocab, classes.number, size=classes.size)
    state, dim = model.start(), model.dim
    ever = np.zeros(vocab, bool)
    cuts = np.linspace(0, vocab, RANGES + 1).astype(int)  # ids are summed in ranges

    def run(batches, shared, done):
        total, bucket, lead = None, 0, LAST
        many = np.zeros((vocab, dim + 2))  # an id's embedding, state and places, summed
        model0, state0, classes = shared.value
        of = classes.of.astype(np.int16 if classes.number < 1 << 15 else np.int64)
        m = None

        def close():
            nonlocal total
            dense = np.r_[n, n * m.dense(s)]
            total = dense if total is None else total + dense
            at = np.flatnonzero(places)
            many[at] += places[at, None] * np.c_[m.p["E"][at], s["seen"][at], np.ones(len(at))]

        for blk in _one_by_one(batches):
            if m is None:
                m, s = model0.copy(state0)
                n, places = 0, np.zeros(vocab)
            r, bucket = np.random.default_rng([seed, done]), blk.number % BUCKETS
            lead = min(lead, blk.number)
            turn = np.array(blk.ths, np.int64) % rounds == done
            for j, part in enumerate(r.permutation(len(blk.parts))):
                a, e = blk.parts[part]
                mine = np.flatnonzero(~blk.held[a:e] & turn[a:e]) + a
                ids, k = blk.ids_of(mine, end_id)
                x, pad, target = windows(ids, k, end_id, share, int(r.integers(share)))
                target = np.where(target >= 0, of[ids[target]] if len(ids) else -1, -1).astype(of.dtype)
                order = r.permutation(len(x))
                step = max(min(32, batch), min(batch, len(x) // 16))  # few windows still make some steps
                for i in range(0, len(x), step):
                    now = rate * (1 - (done + (j + i / len(x)) / len(blk.parts)) / rounds)
                    at = order[i : i + step]
                    m.step(s, x[at], pad[at], target[at], now)
                n += len(x)
                places += np.bincount(x.ravel(), minlength=vocab)
            if n >= length:
                close()
                m = None
        if m is not None and n:
            close()
        if total is not None:
            yield packed([(-1, bucket, lead, total), *((i, bucket, lead, many[a:e].astype("<f4")) for i, (a, e) in enumerate(zip(cuts, cuts[1:])))])

    def packed(rows):
        part, bucket, lead, values = zip(*rows)
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (part, bucket, lead)), pa.array([v.tobytes() for v in values], pa.binary())], names=["part", "bucket", "lead", "sums"])

    def add(batches):
        """Rows of each (part, bucket), summed one after another in the order of their smallest block."""
        sums: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        for b in batches:
            for part, bucket, lead, x in zip(*(c.to_pylist() for c in b.columns)):
                x = np.frombuffer(x, "<f8" if part < 0 else "<f4").astype(float)
                first, held = sums.get((part, bucket), (lead, None))
                sums[part, bucket] = first, x if held is None else held + x
        if sums:
            yield packed([(*k, lead, x if k[0] < 0 else x.astype("<f4")) for k, (lead, x) in sums.items()])

    order, schema, number = ["part", "bucket", "lead"], "part long, bucket long, lead long, sums binary", int(spark.conf.get("spark.sql.shuffle.partitions"))
    for done in range(rounds):
        shared = spark.sparkContext.broadcast((model, state, classes))
        sums = encoded.mapInArrow(lambda it, shared=shared, done=done: run(it, shared, done), schema)
        sums = sums.repartition(number, "part", "bucket").sortWithinPartitions(*order).mapInArrow(add, schema).withColumn("bucket", F.lit(0).cast("long"))
        for r in sums.repartition(number, "part").sortWithinPartitions(*order).mapInArrow(add, schema).collect():  # the network, and ranges of the tokenizer's ids
            if r["part"] < 0:
                x = np.frombuffer(r["sums"], "<f8")
                model.take(state, x[1:] / x[0])
            else:
                x, a = np.frombuffer(r["sums"], "<f4").astype(float).reshape(-1, dim + 2), cuts[r["part"]]
                at = np.flatnonzero(x[:, -1])
                x = x[at] / x[at, -1:]
                model.p["E"][a + at], state["seen"][a + at], ever[a + at] = x[:, :dim], x[:, dim], True
        shared.unpersist()
    if ever.any():  # ids that no window held stand where the others' mean is
        model.p["E"][~ever] = model.p["E"][ever].mean(0)
    return model


def score(docs: DataFrame, tokenizer: str, end_id: int = 50256) -> DataFrame:
    """(doc_id, th, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document; log10."""
    encoded, classes, (n, v, ends) = prepare(docs, tokenizer, end_id)
    model = train(encoded, classes, end_id, encoder(tokenizer).tok.get_vocab_size())
    shared = docs.sparkSession.sparkContext.broadcast((model, classes))  # the tokenizer's ids times the model's width
    log = lambda c: np.log10((c + 0.5) / (n + 0.5 * (v + 1)))

    def run(batches):
        model, classes = shared.value
        for blk in _one_by_one(batches):
            counts, doc = blk.counts, np.repeat(np.arange(len(blk.counts)), blk.counts)
            logs = log(blk.c)
            base = np.bincount(doc, weights=logs[blk.codes], minlength=len(counts)) + log(ends)
            seen = np.bincount(doc, weights=blk.c[blk.codes] > 0, minlength=len(counts)).astype(np.int64) + (ends > 0)
            score = np.empty(len(counts))
            for a, e in blk.parts:
                w, sub, ids, k = blk.ids(a, e, end_id)
                ends_at = np.cumsum(counts[a:e])
                each = log_prob(model, classes, ids, k, end_id)
                words_log = mixed(each, np.insert(sub, ends_at, 1), math.log(10) * np.insert(logs[w], ends_at, log(ends)))
                score[a:e] = np.bincount(np.repeat(np.arange(e - a), counts[a:e] + 1), weights=words_log) / math.log(10)
            yield pa.RecordBatch.from_arrays([pa.array(blk.docs, pa.int64()), pa.array(blk.ths, pa.int64()), pa.array(blk.held), pa.array(counts + 1), pa.array(seen), pa.array(np.full(len(counts), n, np.int64)), pa.array(base), pa.array(score)], names=names)

    schema = "doc_id long, th long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    names = [x.split()[0] for x in schema.split(", ")]
    return encoded.mapInArrow(run, schema)
