"""Token ids of whole texts by a tokenizer file, with each often-used piece of text encoded once per worker."""

from __future__ import annotations

import os
import re
import zlib
from itertools import repeat

import numpy as np
import pandas as pd

_TWO = re.compile(r"\s\s")
_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace()]
#: A piece stands for a space and itself, unless it begins with the start of a text or of a line.
TEXT_START, LINE_START = "\1", "\n\1"
_STOPS = (".", ",")
_STOP_PIECES = tuple(TEXT_START + x for x in _STOPS)
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])))

#: Distinct pieces that a worker remembers, and pieces given to the library at once.
CACHE = 600_000
JOINED = 100


class Encoder:
    """The ids of `Tokenizer.encode(text, add_special_tokens=False)`.

    Byte-level BPE never merges across its own pre-token borders. A text is cut only at borders that hold for certain:
    before a single space, around a single line feed, and between a letter and a full stop or comma that ends a piece.
    Each distinct piece is encoded by the tokenizers library, many new ones in one text where each starts with a space
    or line feed, and the ids are dealt back by the bytes that each id stands for. Texts with neighbouring
    white space or with an added token's string are encoded whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.bytes_of[i] = len(token)  # byte-level: a character for each byte
        self.marks = ["\0", "\1", *(t.content for t in self.tok.get_added_tokens_decoder().values())]
        self.unsure = [*self.marks, *(x + y for x in " \n" for y in " \n"), *(c for c in _SPACES if c not in " \n")]
        self.forget()

    def forget(self) -> None:
        """Forget all pieces."""
        self.known: dict[str, int] = {}
        self.flat = np.empty(0, np.uint32)
        self.start = np.zeros(1, np.int64)
        self.hits = np.empty(0, np.int32)

    def _trim(self) -> None:
        """Forget the pieces that came up in one call only."""
        keep = np.flatnonzero(self.hits > 1)
        if len(keep) > CACHE // 2:
            return self.forget()
        new = np.full(len(self.hits), -1)
        new[keep] = np.arange(len(keep))
        self.known = {p: j for p, i in self.known.items() if (j := int(new[i])) >= 0}
        lens = np.diff(self.start)[keep]
        at = _slices(self.start[keep], lens)
        self.flat, self.start, self.hits = self.flat[at], np.r_[0, np.cumsum(lens)], self.hits[keep]

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        ids = [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(ids) if ids else np.empty(0, np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As _library, of pieces that may follow each other."""
        ids, _ = self._library(["".join(pieces[i : i + JOINED]) for i in range(0, len(pieces), JOINED)])
        if not pieces:
            return ids, np.empty(0, np.int64)
        ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum([len(p.encode()) for p in pieces])) + 1
        return ids, np.diff(np.r_[0, ends])

    def _learn(self, pieces: list[str]) -> None:
        follow, alone = [], []  # pieces that start with a space or line feed and go on without white space; others
        for p in pieces:
            t = "\n" + p[2:] if p[:2] == LINE_START else p[1:] if p[:1] == TEXT_START else " " + p
            bare = t.strip()
            (follow if bare and t[1:] == bare and t[0] in " \n" else alone).append((p, t))
        for group, (ids, lens) in ((follow, self._joined([t for _, t in follow])), (alone, self._library([t for _, t in alone]))):
            n = len(self.known)
            self.known.update(zip((p for p, _ in group), range(n, n + len(group))))
            self.flat = np.concatenate([self.flat, ids])
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(lens)])
            self.hits = np.concatenate([self.hits, np.zeros(len(group), np.int32)])

    def _look(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of each piece's two parts among the known ones (second part -1: none); new ones are encoded."""
        known = self.known
        first = np.fromiter(map(known.get, pieces, repeat(-1)), np.int64, len(pieces))
        second = np.full(len(pieces), -1)
        at = np.flatnonzero(first < 0).tolist()
        if at:
            stems, tails = [], []
            for i in at:
                p = pieces[i]
                cut = p[-1:] in _STOPS and p[-2:-1] in _LETTERS
                stems.append(p[:-1] if cut else p)
                tails.append(TEXT_START + p[-1] if cut else "")
            fresh = [x for x in dict.fromkeys([*_STOP_PIECES, *stems]) if x not in known]
            if len(known) + len(fresh) > CACHE and known:
                self._trim()
                return self._look(pieces)
            self._learn(fresh)
            first[at] = np.fromiter(map(known.__getitem__, stems), np.int64, len(at))
            second[at] = np.fromiter((known[x] if x else -1 for x in tails), np.int64, len(at))
        self.hits[first] += 1
        self.hits[second[second >= 0]] += 1
        return first, second

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        pieces: list[str] = []
        number = np.zeros(len(texts), np.int64)
        whole: list[int] = []
        for i, t in enumerate(texts):
            s = t.decode("utf-8")
            if any(map(s.__contains__, self.unsure)) and (any(map(s.__contains__, self.marks)) or _TWO.search(s)):
                whole.append(i)
            elif s:
                p = (TEXT_START + s).replace("\n", " " + LINE_START).split(" ")
                number[i] = len(p)
                pieces += p
        codes, uniq = pd.factorize(np.array(pieces, object)) if pieces else (np.empty(0, np.int64), [])
        first, second = self._look(list(uniq))
        # the ids of the distinct pieces, one after another
        size = np.diff(self.start)
        la, lb = size[first], np.where(second < 0, 0, size[second])
        table = self.flat[_slices(np.ravel(np.c_[self.start[first], self.start[second]]), np.ravel(np.c_[la, lb]))]
        size = la + lb
        lens = size[codes]
        ids = table[_slices((np.cumsum(size) - size)[codes], lens)]
        each = np.diff(np.r_[0, np.cumsum(lens)][np.r_[0, np.cumsum(number)]])
        if not whole:
            return ids, each
        ids_w, lens_w = self._library([texts[i].decode("utf-8") for i in whole])
        at = np.repeat((np.cumsum(each) - each)[whole], lens_w)
        each[whole] = lens_w
        return np.insert(ids, at, ids_w), each

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As encode, of texts that are a space and a word each, a run without ASCII white space; nothing is remembered. For
        words that come once: what is looked for in every text there is looked for in all at once here."""
        texts = [" " + w.decode("utf-8", "replace") for w in words]
        joined = "".join(texts)
        unsure = [x for x in self.unsure if x in joined]
        alone = [i for i, t in enumerate(texts) if any(map(t.__contains__, unsure))] if unsure else []
        if not alone:
            return self._joined(texts)
        apart = set(alone)
        ids, some = self._joined([t for i, t in enumerate(texts) if i not in apart])
        lens = np.zeros(len(texts), np.int64)
        lens[np.setdiff1d(np.arange(len(texts)), alone)] = some
        ids_w, lens_w = self._library([texts[i] for i in alone])
        at = np.repeat((np.cumsum(lens) - lens)[alone], lens_w)
        lens[alone] = lens_w
        return np.insert(ids, at, ids_w), lens


def _slices(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths - starts, lengths)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


_STOP_RUN = r"([!-/:-@\[-`{-~]*)"
_ASCII_WORD = re.compile(b"([A-Za-z]+)" + _STOP_RUN.encode())
_LATIN_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)" + _STOP_RUN)


class WordEncoder(Encoder):
    """As Encoder, for BPE whose words end at white space and whose tokenizer drops it and lowers case.

    A text is cut at ASCII white space, and the ids of every piece are kept. A piece of Latin-1 letters and ASCII
    punctuation behind them is two words of their own in any text, and its lower case is letter by letter, so pieces
    that differ in case or punctuation need one encoding of the letters. Many words of letters are encoded in one text,
    without the steps that leave them as they are, and their ids dealt back by the ids that end a word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.marks = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.plain = Tokenizer(self.tok.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.forget()

    def _add(self, pieces: list[bytes], ids: np.ndarray, lens: np.ndarray) -> None:
        n = len(self.known)
        self.known.update(zip(pieces, range(n, n + len(pieces))))
        self.flat = np.concatenate([self.flat, ids])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(lens)])
        self.hits = np.concatenate([self.hits, np.zeros(len(pieces), np.int32)])

    def _learn(self, pieces: list[bytes]) -> None:
        known = self.known
        words: dict[bytes, None] = {}
        others: dict[bytes, None] = {}
        made: list[tuple[bytes, bytes, bytes]] = []  # piece, letters, what stands behind them
        for p in pieces:
            if m := _ASCII_WORD.fullmatch(p):
                stem, tail = m[1].lower(), m[2]
            elif m := None if p.isascii() else _LATIN_WORD.fullmatch(p.decode("utf-8")):
                stem, tail = m[1].lower().encode(), m[2].encode()
            else:
                others[p] = None
                continue
            if stem not in known:
                words[stem] = None
            if tail and tail not in known:
                others[tail] = None
            if p != stem:
                made.append((p, stem, tail))
        fresh = list(words)
        texts = [b" ".join(fresh[i : i + JOINED]).decode("utf-8") for i in range(0, len(fresh), JOINED)]
        ids = [np.array(e.ids, np.uint32) for e in self.plain.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate(ids) if ids else np.empty(0, np.uint32)
        self._add(fresh, ids, np.diff(np.r_[0, np.flatnonzero(self.ends[ids]) + 1]))
        self._add(list(others), *self._library([p.decode("utf-8") for p in others]))
        if made:
            first = np.fromiter((known[s] for _, s, _ in made), np.int64, len(made))
            second = np.fromiter((known[t] if t else -1 for _, _, t in made), np.int64, len(made))
            la, lb = np.diff(self.start)[first], np.where(second < 0, 0, np.diff(self.start)[second])
            self._add([p for p, _, _ in made], self.flat[_slices(np.ravel(np.c_[self.start[first], self.start[second]]), np.ravel(np.c_[la, lb]))], la + lb)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        whole = [i for i, t in enumerate(texts) if any(m in t for m in self.marks)]
        skip = set(whole)
        words: list[bytes] = []
        number = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if i not in skip:
                w = (t.lower() if t.isascii() else t).split()
                number[i] = len(w)
                words += w
        if len(self.known) > CACHE:
            self._trim()
        codes = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(codes < 0)
        if len(new):
            missing = [words[i] for i in new.tolist()]
            self._learn(list(dict.fromkeys(missing)))
            codes[new] = np.fromiter(map(self.known.__getitem__, missing), np.int64, len(missing))
        self.hits[np.bincount(codes, minlength=len(self.hits)) > 0] += 1
        size = np.diff(self.start)
        lens = size[codes]
        ids = self.flat[_slices(self.start[codes], lens)]
        each = np.diff(np.r_[0, np.cumsum(lens)][np.r_[0, np.cumsum(number)]])
        if not whole:
            return ids, each
        ids_w, lens_w = self._library([texts[i].decode("utf-8") for i in whole])
        at = np.repeat((np.cumsum(each) - each)[whole], lens_w)
        each[whole] = lens_w
        return np.insert(ids, at, ids_w), each


_word_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    if path not in _word_encoders:
        _word_encoders[path] = WordEncoder(path)
    return _word_encoders[path]
