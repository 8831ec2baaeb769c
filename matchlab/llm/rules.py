"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger, written to the shared folder, keeps its failure bits and the
measurements. Policies are versioned sets of bits applied to the stored mask, so that trying another policy or counting
an ablation reads no text. Ablations count, for each rule, what it alone rejects, by bitwise aggregation.

Edge cases: a null or empty text has no words and fails `few_words`; rows that repeat a doc_id are judged each; an
empty table gives an empty ledger; other columns are ignored. Texts are read whole, in chunks of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_words, keyed, mix, rolling, slices, staged, text_chunks, word_codes

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_lone_symbols"]
_SYMBOLS = b"#*$%&|<>"

#: (name, bit, condition of failure over the measurements). Bits are never used again for another rule.
RULES = [
    ("few_words", 0, "n_words < 50"),
    ("repeated_words", 1, "100 * n_repeat_words > 50 * n_words"),
    ("many_symbols", 2, "100 * n_symbols > 10 * word_chars"),
    ("short_words", 3, "word_chars < 2 * n_words"),
    ("long_words", 4, "word_chars > 20 * n_words"),
    ("repeated_lines", 5, "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    ("lone_symbols", 6, "100 * n_lone_symbols > 20 * n_words"),
]
BIT = {name: 1 << bit for name, bit, _ in RULES}

#: Versioned policies: which bits reject. An issued policy names its rules, so a new rule changes none.
POLICIES = {
    "base-1": BIT["few_words"] | BIT["repeated_words"],
    "clean-1": BIT["few_words"] | BIT["repeated_words"] | BIT["many_symbols"] | BIT["short_words"] | BIT["long_words"] | BIT["repeated_lines"] | BIT["lone_symbols"],
}


def _measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    codes, counts, uniq = word_codes(texts)
    n = len(texts)
    first = np.cumsum(counts) - counts
    out = {"n_words": counts}
    chars = np.fromiter((len(w.decode("utf-8")) for w in uniq), np.int64, len(uniq))
    lone = np.fromiter((not w.strip(_SYMBOLS) for w in uniq), np.int64, len(uniq))
    doc = np.repeat(np.arange(n), counts)
    total = lambda x: np.bincount(doc, weights=x, minlength=n).astype(np.int64)
    out["word_chars"] = total(chars[codes]) if len(codes) else np.zeros(n, np.int64)
    out["n_lone_symbols"] = total(lone[codes]) if len(codes) else np.zeros(n, np.int64)
    out["n_symbols"] = np.fromiter((len(t) - len(t.translate(None, _SYMBOLS)) for t in texts), np.int64, n)
    lines, dup = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, t in enumerate(texts):
        if b"\n" in t:
            own = [x for x in t.split(b"\n") if x.split(None, 1)]
            lines[i], dup[i] = len(own), len(own) - len(set(own))
        else:
            lines[i] = counts[i] > 0
    out["n_lines"], out["n_dup_lines"] = lines, dup
    # 3-word windows: equal hashes within a document mark their words
    k = np.maximum(counts - 2, 0)
    at = slices(first, k)
    repeat = np.zeros(len(codes), bool)
    if len(at):
        s, inv = rolling(hash_words(uniq)[codes])
        g = mix((s[at + 3] - s[at]) * inv[at])
        twice = np.zeros(len(at), bool)
        ends = np.cumsum(k)
        for a, e in zip((ends - k).tolist(), ends.tolist()):
            own = np.sort(g[a:e])
            same = own[1:] == own[:-1]
            if same.any():
                twice[a:e] = np.isin(g[a:e], own[1:][same])
        for j in range(3):
            repeat[at[twice] + j] = True
    out["n_repeat_words"] = total(repeat) if len(codes) else np.zeros(n, np.int64)
    return out


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and `failed`: one bit per rule. Stored, so texts are read once however often it is used."""

    def run(batches):
        for b, texts in text_chunks(batches):
            m = _measure(texts)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(m[c]) for c in MEASURES)], names=["doc_id", *MEASURES])

    rows = keyed(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in MEASURES))
    mask = F.lit(0).cast("long")
    for name, bit, cond in RULES:
        mask = mask.bitwiseOR(F.when(F.expr(cond), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return staged(rows.withColumn("failed", mask), "op6-ledger")


def apply_policy(rows: DataFrame, policy: str) -> DataFrame:
    """Adds kept: no bit of the policy is set."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(POLICIES[policy])) == 0)


def with_ablation(rows: DataFrame, policy: str) -> DataFrame:
    """Adds kept, and where one rule of the policy alone rejects a document, that rule as sole_rule and the number of
    such documents as sole_rule_docs (null elsewhere)."""
    bits, counts = POLICIES[policy], {r["rule"]: r["only"] for r in ablation(rows, policy).collect()}  # a row for each rule
    hit, rule, docs = F.col("failed").bitwiseAND(F.lit(bits)), F.lit(None).cast("string"), F.lit(None).cast("long")
    for name, n in counts.items():
        rule, docs = F.when(hit == BIT[name], F.lit(name)).otherwise(rule), F.when(hit == BIT[name], F.lit(n)).otherwise(docs)
    return apply_policy(rows, policy).withColumns({"sole_rule": rule, "sole_rule_docs": docs})


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of the policy: documents that fail it, and documents that only it rejects (kept without it)."""
    bits = POLICIES[policy]
    own = [(name, 1 << bit) for name, bit, _ in RULES if bits >> bit & 1]
    hit = F.col("failed").bitwiseAND(F.lit(bits))
    sums = rows.select(hit.alias("hit")).agg(*(F.count_if(F.col("hit").bitwiseAND(F.lit(b)) != 0).alias(f"f{b}") for _, b in own), *(F.count_if(F.col("hit") == b).alias(f"o{b}") for _, b in own), F.count("*").alias("docs"))
    pairs = F.array(*(F.struct(F.lit(n).alias("rule"), F.col(f"f{b}").alias("failed"), F.col(f"o{b}").alias("only"), F.col("docs").alias("docs")) for n, b in own))
    return sums.select(F.inline(pairs))
