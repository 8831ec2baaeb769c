"""Personal data: fixed patterns and a character-level bidirectional LSTM with CRF transitions.

The patterns give base spans. The model is trained in numpy on `sample_windows` windows of the documents: half
of them hold a base span and half none, those of smallest hash among the distinct windows of all documents, beside
made-up lines in spellings that the patterns can't read (domestic phone numbers, addresses with a bracketed "at" or
spaces, cards and network addresses with other separators) and lookalikes without a label (dates, codes, book numbers,
amounts). It reads overlapping windows around every digit, @ and bracketed "at"; a span of the four kinds holds one of
these, but for addresses spelled out in bare words, which stay unread. Windows are decoded by Viterbi, a character takes
the tag of the window in which it stands most central, and equal neighbours join over the whole text. Model spans that
touch no base span and have their kind's wider form are added.

Edge cases: a null or empty text has no spans; rows that repeat a doc_id are read each; texts of any length are read
whole; an empty table gives no rows; without labelled spans the model is trained on the made-up spellings alone; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, keyed, staged, text_chunks

KINDS = ["email", "ip", "card", "phone"]
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = frozenset("0123456789")
_AT = r"(?:\s?@\s?|\s?[\[({]\s?(?:at|AT)\s?[\])}]\s?)"
_DOT = r"(?:\s?\.\s?|\s?[\[({]\s?(?:dot|DOT)\s?[\])}]\s?)"
_TRIGGER = re.compile(r"[0-9@]|[\[({]\s?(?:at|AT)\s?[\])}]")
#: Forms of the model's spans, wider than the patterns.
_WIDE = [
    re.compile(rf"[A-Za-z0-9._%+-]+{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+"), re.compile(rf"[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}"),
    re.compile(r"[0-9](?:[ ./-]{0,2}[0-9])+"), re.compile(r"\+?\(?[0-9](?:[ ()./-]{0,2}[0-9])+"),
]

Span = tuple[int, int, int]  # start, kind, end


def _emails(s: str) -> list[Span]:
    """The leftmost match for an @ starts where the run of local characters before it starts, but not before the last match's end."""
    out, end, at = [], 0, s.find("@")
    while at >= 0:
        lo = at
        while lo > end and s[lo - 1] in _LOCAL:
            lo -= 1
        m = _DOMAIN.match(s, at + 1) if lo < at else None
        if m:
            end = m.end()
            out.append((lo, 0, end))
        at = s.find("@", max(at + 1, end))
    return out


def _ips(s: str) -> list[Span]:
    """In a run of digits and dots, matches take four neighbouring numbers each, from the left."""
    out = []
    for m in _DOTTED.finditer(s):
        run = m.group()
        if run.count(".") < 3:
            continue
        parts, at, group = run.split("."), m.start(), []
        for p in parts:
            group = [*group, (at, p)] if p else []
            if len(group) == 4:
                if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for _, x in group):
                    out.append((group[0][0], 1, at + len(p)))
                group = []
            at += len(p) + 1
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(s: str) -> list[Span]:
    """(start, kind, end) of every base span, by start, then kind."""
    out = _emails(s)
    if not _DIGITS.isdisjoint(s):
        out += _ips(s)
        for m in _CARD.finditer(s):
            d = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(s):
            if 10 <= sum(c in _DIGITS for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e in spans)


# ---------------------------------------------------------------- model

WINDOW, STRIDE = 64, 32
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
_ALPHABET = "0123456789@.+-_() /:=\"'#,|\n[]{}"
_CODE = {c: i + 4 for i, c in enumerate(_ALPHABET)}
SYMBOLS = len(_ALPHABET) + 4  # 0 padding, 1 lower, 2 upper, 3 other


def chars(s: str) -> np.ndarray:
    return np.fromiter((_CODE.get(c) or (1 if c.islower() else 2 if c.isupper() else 3) for c in s), np.int64, len(s))


def tags(n: int, spans: list[Span]) -> np.ndarray:
    y = np.zeros(n, np.int64)
    for a, k, e in spans:
        y[a:e] = 2 + 2 * k
        y[a] = 1 + 2 * k
    return y


#: A tag may follow another: inside only after begin or inside of its kind.
ALLOWED = np.array([[j % 2 == 1 or j == 0 or i in (j - 1, j) for j in range(TAGS)] for i in range(TAGS)])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Weights of the network; `scores` gives tag scores, `decode` the best allowed tag paths."""

    def __init__(self, hidden: int = 16, embed: int = 12, seed: int = 7):
        r = np.random.default_rng(seed)
        g = lambda *s: r.normal(0, 1 / np.sqrt(s[0]), s)
        self.h = hidden
        self.p = {"E": r.normal(0, 0.5, (SYMBOLS, embed)), "O": g(2 * hidden, TAGS), "c": np.zeros(TAGS), "T": np.zeros((TAGS, TAGS)), "S": np.zeros(TAGS)}
        for d in "fb":
            self.p |= {f"W{d}": g(embed, 4 * hidden), f"U{d}": g(hidden, 4 * hidden), f"a{d}": np.r_[np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]}

    def _run(self, e, d):
        """LSTM over e (steps, batch, embed); returns hidden states and what the way back needs."""
        n, b, _ = e.shape
        h = c = np.zeros((b, self.h))
        pre = e @ self.p[f"W{d}"] + self.p[f"a{d}"]
        hs, keep = np.empty((n, b, self.h)), []
        for t in range(n):
            z = pre[t] + h @ self.p[f"U{d}"]
            i, f, o = (_sigmoid(z[:, k * self.h : (k + 1) * self.h]) for k in range(3))
            g = np.tanh(z[:, 3 * self.h :])
            c0, h0 = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            hs[t] = h
            keep.append((i, f, o, g, c0, h0, tc))
        return hs, keep

    def scores(self, x, keep=False):
        e = self.p["E"][x.T]  # (steps, batch, embed)
        f, kf = self._run(e, "f")
        b, kb = self._run(e[::-1], "b")
        both = np.concatenate([f, b[::-1]], axis=2)
        s = both @ self.p["O"] + self.p["c"]
        return (s, e, both, kf, kb) if keep else s

    def decode(self, x) -> np.ndarray:
        s = self.scores(x)
        n, b, k = s.shape
        move = np.where(ALLOWED, self.p["T"], -1e9)
        v = s[0] + self.p["S"] + np.where(np.arange(k) % 2 == 0, np.where(np.arange(k) == 0, 0, -1e9), 0)
        back = np.empty((n, b, k), np.int64)
        for t in range(1, n):
            m = v[:, :, None] + move
            back[t] = m.argmax(1)
            v = m.max(1) + s[t]
        y = np.empty((n, b), np.int64)
        y[-1] = v.argmax(1)
        for t in range(n - 1, 0, -1):
            y[t - 1] = back[t][np.arange(b), y[t]]
        return y.T

    def loss(self, x, y):
        """Mean negative log likelihood of the tag paths under the CRF, and its gradients."""
        s, e, both, kf, kb = self.scores(x, keep=True)
        n, b, k = s.shape
        y, T, S = y.T, self.p["T"], self.p["S"]
        alpha, beta = np.empty_like(s), np.zeros_like(s)
        lse = lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
        alpha[0] = s[0] + S
        for t in range(1, n):
            alpha[t] = lse(alpha[t - 1][:, :, None] + T, 1) + s[t]
        for t in range(n - 2, -1, -1):
            beta[t] = lse(T + (s[t + 1] + beta[t + 1])[:, None, :], 2)
        z = lse(alpha[-1], 1)
        r = np.arange(b)
        gold = S[y[0]] + s[np.arange(n)[:, None], r, y].sum(0) + T[y[:-1], y[1:]].sum(0)
        ds = np.exp(alpha + beta - z[:, None])
        g = {"S": ds[0].sum(0) - np.bincount(y[0], minlength=k), "T": np.zeros_like(T)}
        for t in range(1, n):
            g["T"] += np.exp(alpha[t - 1][:, :, None] + T + (s[t] + beta[t])[:, None, :] - z[:, None, None]).sum(0)
        np.add.at(g["T"], (y[:-1], y[1:]), -1)
        ds[np.arange(n)[:, None], r, y] -= 1
        g["O"], g["c"] = np.einsum("tbh,tbk->hk", both, ds), ds.sum((0, 1))
        dboth = ds @ self.p["O"].T
        de = np.zeros_like(e)
        for d, kept, dh_all in (("f", kf, dboth[:, :, : self.h]), ("b", kb, dboth[::-1, :, self.h :])):
            U, dz_all = self.p[f"U{d}"], np.empty((n, b, 4 * self.h))
            dh = dc = np.zeros((b, self.h))
            gu = np.zeros_like(U)
            for t in range(n - 1, -1, -1):
                i, f, o, u, c0, h0, tc = kept[t]
                dh = dh + dh_all[t]
                dc = dc + dh * o * (1 - tc**2)
                dz = np.concatenate([dc * u * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - u**2)], axis=1)
                dz_all[t] = dz
                gu += h0.T @ dz
                dh, dc = dz @ U.T, dc * f
            src = e if d == "f" else e[::-1]
            g[f"U{d}"], g[f"W{d}"], g[f"a{d}"] = gu, np.einsum("tbe,tbz->ez", src, dz_all), dz_all.sum((0, 1))
            back = dz_all @ self.p[f"W{d}"].T
            de += back if d == "f" else back[::-1]
        g["E"] = np.zeros_like(self.p["E"])
        np.add.at(g["E"], x.T, de)
        return float((z - gold).mean()), {q: v / b for q, v in g.items()}

    def fit(self, x, y, epochs: int = 12, batch: int = 48, rate: float = 0.025, seed: int = 7) -> float:
        """Adam over shuffled batches; returns the last epoch's mean loss."""
        r, m, v, step, mean = np.random.default_rng(seed), {}, {}, 0, 0.0
        for k in range(epochs):
            order, losses = r.permutation(len(x)), []
            for i in range(0, len(x), batch):
                at = order[i : i + batch]
                value, g = self.loss(x[at], y[at])
                losses.append(value)
                step += 1
                for q, d in g.items():
                    d = np.clip(d, -5, 5)
                    m[q] = 0.9 * m.get(q, 0) + 0.1 * d
                    v[q] = 0.99 * v.get(q, 0) + 0.01 * d * d
                    self.p[q] = self.p[q] - rate * (1 - k / epochs) * (m[q] / (1 - 0.9**step)) / (np.sqrt(v[q] / (1 - 0.99**step)) + 1e-8)
            mean = float(np.mean(losses))
        return mean


def window_starts(s: str) -> list[int]:
    """Starts of the windows, on the stride's grid, that hold a digit or @."""
    grid = set()
    for m in _TRIGGER.finditer(s):
        hi = m.start() // STRIDE
        grid.update(range(max(0, hi - WINDOW // STRIDE + 1), hi + 1))
    return [g * STRIDE for g in sorted(grid)]


def _windows(s: str, starts: list[int]) -> np.ndarray:
    x = np.zeros((len(starts), WINDOW), np.int64)
    for i, a in enumerate(starts):
        c = chars(s[a : a + WINDOW])
        x[i, : len(c)] = c
    return x


def _card(r) -> str:
    d = "".join(map(str, r.integers(0, 10, 15)))
    return next(d + c for c in "0123456789" if luhn(d + c))


def made_up(n: int = 800, seed: int = 11) -> list[tuple[str, list[Span]]]:
    """Labelled lines in spellings within and beyond the base patterns, and lookalikes without a label, in equal parts."""
    r, out = np.random.default_rng(seed), []
    num = lambda k: "".join(map(str, r.integers(0, 10, k)))
    word = lambda: "".join(r.choice(list("abcdefghijklmnoprstuvw"), r.integers(2, 9)))
    pick = lambda *x: x[r.integers(len(x))]
    ip = lambda dot: dot.join(str(x) for x in r.integers(0, 256, 4))
    makers = [
        (0, lambda: f"{word()}@{word()}.example.com"), (0, lambda: f"{word()}{pick(' (at) ', ' [at] ', '(at)', ' @ ', ' {at} ')}{word()}{pick(' (dot) ', '.', ' [dot] ', ' . ')}{pick('org', 'com', 'net')}"),
        (1, lambda: ip(".")), (1, lambda: ip(pick("[.]", " . ", " [dot] ").replace("[.]", " . "))),
        (2, lambda: _card(r)), (2, lambda: pick(".", "/", " - ").join(re.findall("....", _card(r)))),
        (3, lambda: f"+{r.integers(1, 99)} ({num(3)}) 555-{num(4)}"), (3, lambda: f"({num(3)}) 555-{num(4)}"), (3, lambda: pick("-", ".").join([str(r.integers(2, 10)) + num(2), num(3), num(4)])),
        (None, lambda: f'token = "{"".join(r.choice(list("0123456789abcdef"), 40))}"'), (None, lambda: num(int(r.integers(1, 11)))), (None, lambda: f"{num(1)}.{num(2)}.{num(1)}"),
        (None, lambda: pick("{}-{:02d}-{:02d}", "{}/{:02d}/{:02d}", "{}{:02d}{:02d}").format(r.integers(1990, 2030), r.integers(1, 13), r.integers(1, 29))), (None, lambda: f"978-{num(1)}-{num(2)}-{num(6)}-{num(1)}"),
        (None, lambda: f"{num(3)},{num(3)},{num(3)}.{num(2)}"), (None, lambda: f"{r.integers(0, 24):02d}:{num(2)}:{num(2)}"), (None, lambda: f"{word().upper()}-{num(4)}-{num(3)}"), (None, lambda: f"({pick('at', 'AT', num(2))}) {word()}"),
        (None, lambda: f"{num(4)}-{num(4)}"), (None, lambda: " ".join(num(int(r.integers(1, 5))) for _ in range(r.integers(2, 5)))),
    ]
    for i in range(n):
        before, after = " ".join(word() for _ in range(r.integers(1, 7))) + " ", pick(" ", ", ", ". ") + " ".join(word() for _ in range(r.integers(1, 7)))
        k, make = makers[i % len(makers)]
        text = make()
        out.append((before + text + after, [] if k is None else [(len(before), k, len(before) + len(text))]))
    return out


def labelled(s: str, spans: list[Span], starts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The windows at `starts` and their tags."""
    y, out = tags(len(s), spans), np.zeros((len(starts), WINDOW), np.int64)
    for row, a in zip(out, starts):
        own = y[a : a + WINDOW]
        row[: len(own)] = own
        if row[0] and row[0] % 2 == 0:  # a span that began before the window
            row[0] -= 1
    return _windows(s, starts), out


def sample(docs: DataFrame, most: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Up to `most` distinct windows of all documents and their tags, half with a base span and half without, those of
    smallest hash. A task sends its own smallest only, and windows, never texts, reach the driver."""
    half = most // 2

    def run(batches):
        best: dict[bool, dict[int, tuple[bytes, bytes]]] = {True: {}, False: {}}
        limit = {True: 1 << 63, False: 1 << 63}
        for _, texts in text_chunks(batches):
            for t in texts:
                s = t.decode("utf-8")
                starts = window_starts(s)
                hashes = [xxhash.xxh3_64_intdigest(s[a : a + WINDOW].encode(), seed) >> 1 for a in starts]
                near = [(h, a) for h, a in zip(hashes, starts) if h < max(limit.values())]
                if near:
                    for (h, _), x, y in zip(near, *labelled(s, base_spans(s), [a for _, a in near])):
                        some = bool(y.any())
                        if h < limit[some]:
                            best[some][h] = x.astype(np.int8).tobytes(), y.astype(np.int8).tobytes()
            for some, own in best.items():
                if len(own) > 2 * half:
                    best[some] = {h: own[h] for h in sorted(own)[:half]}
                    limit[some] = max(best[some])
        rows = [(some, h, *own[h]) for some, own in best.items() for h in sorted(own)[:half]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.bool_(), pa.int64(), pa.binary(), pa.binary()))], names=["some", "h", "x", "y"])

    rows = keyed(docs).mapInArrow(run, "some boolean, h long, x binary, y binary").groupBy("some", "h").agg(F.min(F.struct("x", "y")).alias("r"))
    rows = staged(rows.select("some", "h", "r.*"), "op2-windows")
    got = [r for some in (True, False) for r in rows.filter(F.col("some") == some).orderBy("h").limit(half).collect()]
    table = lambda c: np.array([np.frombuffer(r[c], np.int8) for r in got], np.int64).reshape(len(got), WINDOW)
    return table("x"), table("y")


def train(docs: DataFrame, sample_windows: int = 1000, seed: int = 7) -> Tagger:
    """Fit on at most `sample_windows` windows of the documents and on the made-up lines."""
    parts = [sample(docs, sample_windows, seed), *(labelled(s, spans, window_starts(s)) for s, spans in made_up())]
    model = Tagger(seed=seed)
    model.fit(np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts]))
    return model


def _formed(kind: int, s: str) -> bool:
    """Has a model span its kind's wider form?"""
    digits = "".join(c for c in s if c in _DIGITS)
    if not _WIDE[kind].fullmatch(s):
        return False
    if kind == 1:
        return all(int(x) <= 255 for x in re.findall("[0-9]+", s))
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == 0 or 10 <= len(digits) <= 15 and not s.isdigit()


def model_spans(model: Tagger, texts: list[str], batch: int = 512) -> list[list[Span]]:
    """Spans of each text, from the tags of all its windows."""
    todo = [(i, a) for i, s in enumerate(texts) for a in window_starts(s)]
    best: list[dict[int, tuple[int, int]]] = [{} for _ in texts]  # position: (distance from the window's middle, tag)
    for j in range(0, len(todo), batch):
        part = todo[j : j + batch]
        x = np.concatenate([_windows(texts[i], [a]) for i, a in part])
        for (i, a), y in zip(part, model.decode(x)):
            n = min(WINDOW, len(texts[i]) - a)
            for t in range(n):
                d = abs(2 * t - WINDOW + 1)
                old = best[i].get(a + t)
                if old is None or d < old[0]:
                    best[i][a + t] = (d, int(y[t]))
    out = []
    for s, tagged in zip(texts, best):
        spans, run = [], None
        for p in sorted(tagged):
            t = tagged[p][1]
            kind = (t - 1) // 2 if t else None
            if run and kind == run[1] and p == run[2] and t % 2 == 0:
                run[2] = p + 1
                continue
            if run:
                spans.append(tuple(run))
            run = None if kind is None else [p, kind, p + 1]
        if run:
            spans.append(tuple(run))
        out.append([(a, k, e) for a, k, e in spans if _formed(k, s[a:e])])
    return out


def all_spans(model: Tagger, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, base and added spans) of each text."""
    out = []
    for s, found in zip(texts, model_spans(model, texts)):
        base = base_spans(s)
        more = [x for x in found if not any(x[0] < e and a < x[2] for a, _, e in base)]
        out.append((base, sorted([*base, *more])))
    return out


def find(docs: DataFrame, model: Tagger) -> DataFrame:
    """doc_id, th, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row for each document."""
    names = ["doc_id", "th", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches):
        for b, texts in text_chunks(batches):
            rows = all_spans(model, [t.decode("utf-8") for t in texts])
            n = [pa.array([sum(x[1] == k for x in base) for base, _ in rows], pa.int64()) for k in range(len(KINDS))]
            sha = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *n, sha, pa.array([joined(s) for _, s in rows], pa.string())], names=names)

    return keyed(docs).mapInArrow(run, "doc_id long, th long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, model: Tagger) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; n_chars follows, other columns stay."""
    at = docs.schema.names.index("text")

    def run(batches):
        for b, texts in text_chunks(batches):
            out = []
            for raw, t, (_, spans) in zip(column(b, "text").to_pylist(), texts, all_spans(model, [t.decode("utf-8") for t in texts])):
                s, end, parts = t.decode("utf-8"), 0, []
                for a, k, e in spans:
                    if a >= end:
                        parts += [s[end:a], f"<{KINDS[k].upper()}>"]
                    end = max(end, e)
                out.append(None if raw is None else "".join([*parts, s[end:]]))
            yield b.set_column(at, b.schema.field(at), pa.array(out, b.schema.field(at).type))

    rows = docs.mapInArrow(run, docs.schema)
    return rows.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else rows
