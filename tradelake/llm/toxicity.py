"""Toxicity scores from a weighted lexicon.

The lexicon holds whole words and word beginnings with log-odds weights,
learned from labelled documents.  Texts are folded first: lower case,
look-alike letters and digit substitutions (``1d10t``) become plain letters,
everything that is no letter becomes a blank.  One Aho-Corasick pass finds all
entries; matches inside an exception phrase do not count.  The summed weight,
as it stands and per word, goes through a two-feature logistic calibration.

Defined results: a null or empty text scores like a text without any match; a
null document id is never held out; repeated rows score alike, one result per
row; other columns are ignored.  Without labelled rows of both kinds the seed
terms and a fixed calibration are used.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Look-alike letters of other scripts, digit and sign
# substitutions, seed insults and harmless phrases that contain one.
LOOKALIKES = {"а": "a", "в": "b", "е": "e", "ё": "e", "з": "3", "і": "i", "ї": "i", "ј": "j",
              "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
              "х": "x", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "һ": "h",
              "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v",
              "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
              "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ɑ": "a", "ɡ": "g"}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}
SEED_TERMS = ("idiot", "moron", "stupid", "scum", "loser", "worthless", "pathetic", "disgusting")
EXCEPTIONS = ("clown fish", "trash can", "trash bag", "sore loser")

SEED_WEIGHT = 4.0
BEGINNINGS = range(4, 9)  # lengths of word beginnings that may enter the lexicon
INNER_SIGN = re.compile(r"(?<=[^\W_])[@$!|](?=[^\W_])")


def folding_table() -> dict[int, str]:
    """Code point -> folded text: look-alikes and digits by the lists above,
    accented, full-width and styled letters by their compatibility
    decomposition, all other non-letters to a blank (unlisted letters stay)."""
    out = {}
    for cp in (*range(0x80), *range(0x80, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2C00),
               *range(0x3000, 0x3020), *range(0xFF00, 0xFFF0), *range(0x1D400, 0x1D800)):
        base = unicodedata.normalize("NFKD", chr(cp)).lower()
        base = "".join(c for c in base if not unicodedata.combining(c))
        base = "".join(LOOKALIKES.get(c, DIGITS.get(c, c)) for c in base)
        out[cp] = "".join(c if c.isalpha() else " " for c in base)
    # zero-width and soft characters vanish instead of cutting a word in two
    out |= dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x300, 0x370)], "")
    out |= {ord(k): DIGITS.get(v, v) for k, v in LOOKALIKES.items()}
    return out


FOLDING = folding_table()


def fold(text: str | None) -> str:
    """Folded text: words in plain letters, one blank around each."""
    if not text:
        return " "
    low = text.lower()
    if any(s in low for s in SIGNS):
        low = INNER_SIGN.sub(lambda m: SIGNS[m.group()], low)
    return f" {' '.join(low.translate(FOLDING).split())} "


@dataclass
class ToxicityModel:
    """``weights``: folded entry -> log-odds, `` word `` for whole words and
    `` begin`` (no blank after it) for beginnings."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    coef: tuple[float, float, float] = (-3.0, 0.8, 1.0)
    stats: dict = field(default_factory=dict)

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for term, w in self.weights.items():
            a.add_word(term, (len(term), w))
        for phrase in self.exceptions:
            if (p := fold(phrase)) not in self.weights and p.strip():
                a.add_word(p, (len(p), None))
        if len(a):
            a.make_automaton()
        return a

    def features(self, automaton, text: str | None) -> tuple[float, float]:
        """Log of the summed weight, and of the weight per hundred words."""
        t = fold(text)
        best: dict[int, float] = {}
        masked = []
        if len(automaton):
            for end, (n, w) in automaton.iter(t):
                start = end - n + 1
                if w is None:
                    masked.append((start, end))
                elif w > best.get(start, 0.0):  # one weight per word: its heaviest entry
                    best[start] = w
        total = sum(w for s, w in best.items()
                    if not any(a <= s < b for a, b in masked))
        words = max(1, t.count(" ") - 1)
        return math.log1p(total), math.log1p(100.0 * total / (words + 10.0))

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = self.coef[0] + features @ np.asarray(self.coef[1:])
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def held_out(id_col):
    """True for the fold whose labels are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def wilson_low(pos, n, z: float = 3.0):
    """Lower bound of a share at ``z`` standard errors."""
    p = pos / n
    return (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(text, toxic) of at most ``max_rows`` labelled documents outside the
    held-out fold, those with the smallest hashed id: a bounded sample, small
    enough to broadcast whatever the corpus size."""
    picked = (labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
              .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
              .orderBy(F.xxhash64("id"), "id", "toxic").limit(max_rows))
    return (docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(picked), "id").select("text", "toxic"))


def count_entries(batches):
    """Per task: in how many toxic and other documents each entry occurs."""
    from collections import Counter

    pos, neg, seen = Counter(), Counter(), [0, 0]
    for pdf in batches:
        for text, toxic in zip(pdf["text"], pdf["toxic"]):
            words = set(fold(text).split())
            entries = {f" {w} " for w in words}
            entries |= {f" {w[:k]}" for w in words for k in BEGINNINGS if len(w) > k}
            (pos if toxic else neg).update(entries)
            seen[int(toxic)] += 1
        if len(pos) + len(neg) > 400_000:  # bounded memory: hand over and go on
            yield as_frame(pos, neg, seen)
            pos, neg, seen = Counter(), Counter(), [0, 0]
    yield as_frame(pos, neg, seen)


def as_frame(pos, neg, seen) -> pd.DataFrame:
    keys = list(pos.keys() | neg.keys())
    return pd.DataFrame({"entry": [*keys, ""], "pos": [*(pos[k] for k in keys), seen[1]],
                         "neg": [*(neg[k] for k in keys), seen[0]]})


def learn_lexicon(train: DataFrame, max_entries: int, min_share: float) -> tuple[dict[str, float], int, int]:
    """Entries whose toxic share is reliably (Wilson bound) at least
    ``min_share`` over documents of balanced classes, heaviest first."""
    counts = (train.mapInPandas(count_entries, "entry string, pos long, neg long")
              .groupBy("entry").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    rows = counts.where((F.col("pos") >= 5) & (F.col("pos") * 4 >= F.col("neg")) | (F.col("entry") == ""))
    found = rows.orderBy(F.col("entry") != "", F.desc("pos"), "neg", "entry").limit(max_entries * 20 + 1).collect()
    n_pos, n_neg = next(((r.pos, r.neg) for r in found if r.entry == ""), (0, 0))
    if not n_pos or not n_neg:
        return {}, n_pos, n_neg
    weights = {}
    for r in found:
        if r.entry and wilson_low(r.pos, r.pos + r.neg) >= min_share:
            weights[r.entry] = (math.log((r.pos + 0.5) / (n_pos + 1)) - math.log((r.neg + 0.5) / (n_neg + 1)))
    top = sorted(weights.items(), key=lambda x: (-x[1], x[0]))[:max_entries]
    return {k: v for k, v in top if v > 0}, n_pos, n_neg


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Two-feature logistic regression by Newton steps."""
    a = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -40, 40)))
        h = a.T @ (a * (p * (1 - p))[:, None]) + ridge * np.eye(len(b))
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in b)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_entries: int = 2_000,
        min_share: float = 0.5, exceptions=EXCEPTIONS) -> ToxicityModel:
    """Learn weights and calibration from a sample of at most ``max_rows``
    labelled documents outside the held-out fold (the documented bound)."""
    train = training_rows(docs, labels, max_rows)
    weights, n_pos, n_neg = learn_lexicon(train, max_entries, min_share)
    for term in SEED_TERMS:
        weights.setdefault(f" {term} ", SEED_WEIGHT)
    model = ToxicityModel(weights, tuple(exceptions), stats={"toxic": n_pos, "other": n_neg})
    if n_pos and n_neg:
        def feats(batches, model=model):
            a = model.automaton()
            for pdf in batches:
                f = [model.features(a, t) for t in pdf["text"]]
                yield pd.DataFrame({"x1": [v[0] for v in f], "x2": [v[1] for v in f], "y": pdf["toxic"].astype(float)})
        pts = train.mapInPandas(feats, "x1 double, x2 double, y double").toPandas()
        model.coef = calibrate(pts[["x1", "x2"]].to_numpy(), pts["y"].to_numpy())
    return model


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """Every row's id, fold, score and verdict (``score >= threshold``)."""
    def run(batches, model=model):
        automaton = model.automaton()
        for batch in batches:
            scores = batch_scores(model, automaton, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores)],
                                             ["doc_id", "held_out", "score"])
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"),
                       held_out(F.col("doc_id")).alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def filter_clean(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score is under ``threshold``, columns as they were."""
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches, model=model):
        automaton = model.automaton()
        for batch in batches:
            keep = batch_scores(model, automaton, batch.column(at)) < threshold
            yield batch.filter(pa.array(keep))
    return docs.mapInArrow(run, docs.schema)


def batch_scores(model: ToxicityModel, automaton, texts) -> np.ndarray:
    x = np.array([model.features(automaton, t) for t in texts.to_pylist()], dtype=float).reshape(-1, 2)
    return model.scores(x)
