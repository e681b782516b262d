"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in NumPy.

A word's input is its own hashed embedding beside the mean of its hashed character n-grams. Two recurrent passes read a
window of words, attention weighs their states, a logistic unit scores the window. All overlapping windows of a
text are scored; a text has the score of its highest window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from meadow.llm.common import settle

PIECE = 16  # bytes; a longer word is read as several pieces
WINDOW, STRIDE = 32, 24
SLOTS = 8192  # rows of either embedding
DIM, HIDDEN, ATTEND = 8, 12, 8
GRAMS = (3, 4, 5)
_WORD = re.compile(rb"[^\x00-\x20]{1,%d}" % PIECE)


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def windows(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word indices (windows x WINDOW, -1 beyond the end), the text of each window, and the distinct words.

    Windows overlap and cover every word of the lower-cased text; a text without words has one empty window.
    """
    ids, rows, owner = _Ids(), [], []
    for k, text in enumerate(texts):
        w = np.fromiter(map(ids.__getitem__, _WORD.findall((text or "").lower().encode("utf-8", "replace"))), np.int32)
        n = 1 + max(0, -(-(len(w) - WINDOW) // STRIDE))
        full = np.full((n - 1) * STRIDE + WINDOW, -1, np.int32)
        full[:len(w)] = w
        rows.append(np.lib.stride_tricks.sliding_window_view(full, WINDOW)[::STRIDE])
        owner.append(np.full(n, k, np.int32))
    if not rows:
        return np.empty((0, WINDOW), np.int32), np.empty(0, np.int32), []
    return np.concatenate(rows), np.concatenate(owner), list(ids)


def slots(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: slot of the whole word, slots of its character n-grams (with both ends marked), and which are real."""
    c = np.zeros((len(words), PIECE + 2), np.uint32)
    c[:, 0] = ord("<")
    c[:, 1:-1] = np.array(words, f"S{PIECE}").view(np.uint8).reshape(len(words), PIECE)
    grams, real = [], []
    for k in GRAMS:
        for at in range(PIECE + 3 - k):
            h = np.full(len(words), k, np.uint32)
            for j in range(k):
                h = h * np.uint32(16777619) + c[:, at + j]
            grams.append((h * np.uint32(2654435761)) >> np.uint32(19))
            real.append(c[:, at + k - 2] > 0)
    h = np.full(len(words), 7, np.uint32)
    for j in range(PIECE + 1):
        h = h * np.uint32(16777619) + c[:, j]
    return (h * np.uint32(2654435761)) >> np.uint32(19), np.stack(grams, 1), np.stack(real, 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class BiGru:
    """The network's arrays, its forward pass and its gradients."""

    p: dict[str, np.ndarray] = field(default_factory=dict)
    scale: tuple[float, float] = (1.0, 0.0)

    @classmethod
    def start(cls, seed: int) -> BiGru:
        r = np.random.default_rng(seed)
        w = lambda *s, by: r.normal(0, by, s).astype(np.float32)
        p = {"word": w(SLOTS, DIM, by=0.1), "char": w(SLOTS, DIM, by=0.3), "att": w(2 * HIDDEN, ATTEND, by=0.3), "att_b": np.zeros(ATTEND, np.float32),
             "att_v": w(ATTEND, by=0.3), "out": w(2 * HIDDEN, by=0.3), "out_b": np.zeros(1, np.float32)}
        for d in "fb":
            p |= {f"x{d}": w(2 * DIM, 3 * HIDDEN, by=0.3), f"b{d}": np.zeros(3 * HIDDEN, np.float32), f"u{d}": w(HIDDEN, 3 * HIDDEN, by=0.3)}
        return cls(p)

    def inputs(self, word: np.ndarray, grams: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Vectors of distinct words; a last row of zeros stands for the places beyond the end."""
        total = np.zeros((len(word), DIM), np.float32)
        for j in range(grams.shape[1]):
            k = np.flatnonzero(real[:, j])
            total[k] += self.p["char"][grams[k, j]]
        x = np.concatenate([self.p["word"][word], total / np.maximum(1, real.sum(1))[:, None].astype(np.float32)], 1)
        return np.concatenate([x, np.zeros((1, 2 * DIM), np.float32)])

    def states(self, proj: dict, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States of both directions (time x windows x 2 HIDDEN); `keep` gets what the gradients need."""
        n, H = len(ids), HIDDEN
        out = np.empty((WINDOW, n, 2 * H), np.float32)
        for d, order in (("f", range(WINDOW)), ("b", range(WINDOW - 1, -1, -1))):
            h, u = np.zeros((n, H), np.float32), self.p[f"u{d}"]
            at = slice(0, H) if d == "f" else slice(H, 2 * H)
            for t in order:
                a, g = proj[d][ids[:, t]], h @ u
                zr = _sigmoid(a[:, :2 * H] + g[:, :2 * H])
                z, r, gn = zr[:, :H], zr[:, H:], g[:, 2 * H:]
                c = np.tanh(a[:, 2 * H:] + r * gn)
                live = (ids[:, t] >= 0)[:, None]
                new = np.where(live, c + z * (h - c), h)
                if keep is not None:
                    keep.append((d, t, h, z, r, gn, c, live))
                out[t, :, at] = h = new
        return out

    def project(self, x: np.ndarray) -> dict:
        return {d: x @ self.p[f"x{d}"] + self.p[f"b{d}"] for d in "fb"}

    def pool(self, s: np.ndarray, ids: np.ndarray) -> tuple:
        """Attention over time: tanh layer, weights, pooled state, log odds."""
        e = np.tanh(s @ self.p["att"] + self.p["att_b"])
        score = np.where(ids.T >= 0, e @ self.p["att_v"], np.float32(-30))
        a = np.exp(score - score.max(0))
        a /= a.sum(0)
        m = np.einsum("tn,tnh->nh", a, s)
        return e, a, m, m @ self.p["out"] + self.p["out_b"]

    def odds(self, ids: np.ndarray, words: list[bytes], batch: int = 2048) -> np.ndarray:
        """Log odds of each window."""
        proj = self.project(self.inputs(*slots(words)) if words else np.zeros((1, 2 * DIM), np.float32))
        parts = [ids[at:at + batch] for at in range(0, len(ids), batch)]
        return np.concatenate([np.empty(0), *[self.pool(self.states(proj, part), part)[3].astype(float) for part in parts]])

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Calibrated probability of each text, from its highest window."""
        ids, owner, words = windows(texts)
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, owner, self.odds(ids, words))
        slope, shift = self.scale
        return _sigmoid(np.clip(slope * best + shift, -40, 40))

    def gradients(self, word: np.ndarray, grams: np.ndarray, real: np.ndarray, ids: np.ndarray, y: np.ndarray) -> dict:
        """Gradients of the mean log loss of a batch of windows; words are those of the batch."""
        H, p, n = HIDDEN, self.p, len(ids)
        x = self.inputs(word, grams, real)
        proj, keep = self.project(x), []
        s = self.states(proj, ids, keep)
        e, a, m, odds = self.pool(s, ids)
        prob = _sigmoid(odds)
        g: dict = {}
        d_logit = ((prob - y) / n).astype(np.float32)
        g["out"], g["out_b"] = m.T @ d_logit, d_logit.sum(keepdims=True)
        dm = d_logit[:, None] * p["out"]
        ds = a[:, :, None] * dm
        da = np.einsum("nh,tnh->tn", dm, s)
        d_score = a * (da - (a * da).sum(0))
        d_score[ids.T < 0] = 0
        g["att_v"] = np.einsum("tn,tnk->k", d_score, e)
        de = d_score[:, :, None] * p["att_v"] * (1 - e * e)
        g["att"], g["att_b"] = np.einsum("tnh,tnk->hk", s, de), de.sum((0, 1))
        ds += de @ p["att"].T
        dx = np.zeros_like(x)
        flat = ids.T.ravel()
        sort = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.diff(flat[sort], prepend=-2))
        for d in "fb":
            u, dh = p[f"u{d}"], np.zeros((n, H), np.float32)
            at = slice(0, H) if d == "f" else slice(H, 2 * H)
            du, da_t, dproj = np.zeros_like(u), np.zeros((WINDOW, n, 3 * H), np.float32), np.zeros((len(x), 3 * H), np.float32)
            for _, t, h, z, r, gn, c, live in (k for k in reversed(keep) if k[0] == d):
                dh = dh + ds[t, :, at]
                dl = np.where(live, dh, 0)
                dc = dl * (1 - z) * (1 - c * c)
                dz = dl * (h - c) * z * (1 - z)
                dr = dc * gn * r * (1 - r)
                dg = np.concatenate([dz, dr, dc * r], 1)
                da_t[t] = np.concatenate([dz, dr, dc], 1)
                du += h.T @ dg
                dh = np.where(live, dl * z, dh) + dg @ u.T
            dproj[flat[sort][first]] = np.add.reduceat(da_t.reshape(-1, 3 * H)[sort], first)
            dproj[-1] = 0
            g[f"u{d}"], g[f"x{d}"], g[f"b{d}"] = du, x.T @ dproj, dproj.sum(0)
            dx += dproj @ p[f"x{d}"].T
        part = dx[:-1, DIM:] / np.maximum(1, real.sum(1))[:, None]
        k, j = np.nonzero(real)
        g["word"], g["char"] = _scatter(word, dx[:-1, :DIM]), _scatter(grams[k, j], part[k])
        return g


def _scatter(slot: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(slot, weights=rows[:, c], minlength=SLOTS) for c in range(DIM)], 1)


def _platt(odds: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a one-dimensional logistic fit; both labels get smoothed targets, so that it stays finite."""
    n1, n0 = float((y == 1).sum()), float((y == 0).sum())
    if not n1 or not n0:
        return 1.0, 0.0
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    mid, spread = float(odds.mean()), float(odds.std()) or 1.0
    x = np.stack([(odds - mid) / spread, np.ones_like(odds)], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = _sigmoid(np.clip(x @ w, -30, 30))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (t - p) - 1e-3 * w)
    return float(w[0] / spread), float(w[1] - w[0] * mid / spread)


def train(texts: list[str], labels: np.ndarray, epochs: int = 8, steps: int = 300, batch: int = 256, rate: float = 0.01,
          seed: int = 42) -> BiGru:
    """Adam on windows of labelled texts, then a calibration on every fourth text, which the network does not see.

    Small samples get smaller batches and more epochs, `steps` steps about. In each epoch a label-1 text gives its two highest windows (in the first epoch up to four drawn ones); a label-0 text
    gives its three highest and two drawn ones. Two thirds of the words' own embeddings are blanked in each step, so that the
    characters are learned too.
    """
    net, r = BiGru.start(seed), np.random.default_rng(seed)
    ids, owner, words = windows(texts)
    if not words:
        return net
    word, grams, real = slots(words)
    y = labels[owner].astype(np.float32)
    learn = np.arange(len(texts)) % 4 != 3
    m1, m2 = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    step, size = 0, int((np.bincount(owner[learn[owner]], minlength=1).clip(0, 5)).sum())
    batch = int(np.clip(size // 16, 16, batch))
    epochs = int(np.clip(-(-steps * batch // max(size, 1)), epochs, 24))
    for epoch in range(epochs):
        chance = r.random(len(ids))
        rank = _rank_within(owner, chance)
        if epoch:
            high = _rank_within(owner, -net.odds(ids, words))
            use = np.where(y == 1, high < 2, (high < 3) | (rank < 2))
        else:
            use = rank < 4
        use = np.flatnonzero(use & learn[owner])
        for part in np.array_split(r.permutation(use), max(1, len(use) // batch)):
            if not len(part):
                continue
            own, local = np.unique(ids[part], return_inverse=True)
            local = local.reshape(len(part), WINDOW) - (1 if own[0] < 0 else 0)
            own = own[own >= 0]
            slot = np.where(r.random(len(own)) < 0.67, SLOTS - 1, word[own])
            step += 1
            for k, g in net.gradients(slot, grams[own], real[own], local, y[part]).items():
                m1[k] += 0.1 * (g - m1[k])
                m2[k] += 0.01 * (g * g - m2[k])
                move = (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-6)
                net.p[k] -= (rate * (1 - epoch / (epochs + 1)) * move).astype(np.float32)
            net.p["word"][SLOTS - 1] = 0
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, owner, net.odds(ids, words))
    check = ~learn if len(set(labels[~learn])) == 2 else np.ones(len(texts), bool)
    net.scale = _platt(best[check], labels[check])
    return net


def _rank_within(owner: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Rank of each window by key among the windows of its text."""
    order = np.lexsort((key, owner))
    sorted_owner = owner[order]
    first = np.searchsorted(sorted_owner, sorted_owner)
    rank = np.empty(len(owner), np.int64)
    rank[order] = np.arange(len(owner)) - first
    return rank


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1000, longest: int = 8000, seed: int = 42) -> BiGru:
    """Train on a bounded sample: the `per_class` label-1 and twice as many label-0 documents that come first by a seeded
    hash of the id, not held out, of at most `longest` characters. Only the training sample is bounded; scoring reads all."""
    known = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(~held_out(F.col("doc_id")))
    sizes = docs.select("doc_id", F.char_length("text").alias("n")).filter((F.col("n") <= longest) & (F.col("n") > 0))
    drawn = sizes.join(known, "doc_id").withColumn("draw", F.xxhash64("doc_id", F.lit(seed))).select("doc_id", "toxic", "draw")
    parts = [drawn.filter(F.col("toxic") == t).orderBy("draw", "doc_id").limit(per_class * (2 - t)) for t in (0, 1)]
    ids = settle(parts[0].unionByName(parts[1]).distinct(), "sample")  # at most 3 * per_class rows
    usable = docs.select("doc_id", "text").filter((F.char_length("text") <= longest) & (F.char_length("text") > 0))
    rows = usable.join(F.broadcast(ids), "doc_id").orderBy("draw", "doc_id", "text").limit(3 * per_class).collect()
    return train([r["text"] for r in rows], np.array([r["toxic"] for r in rows], np.float32), seed=seed)


def score(docs: DataFrame, net: BiGru, threshold: float = 0.3) -> DataFrame:
    """docs (doc_id, text) -> doc_id, held_out, score (double), predicted (int), one row per document row.

    Null and empty texts get the score of an empty window. A text with a null id is scored and not held out. Repeated rows get equal scores; empty tables none.
    Without any labelled rows the network stays untrained, and scores say nothing.
    """
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), _scorer(net)("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def _scorer(net: BiGru):
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts, at = texts.tolist(), 0
            scores = np.empty(len(texts))
            while at < len(texts):  # blocks of about a million characters
                to, size = at, 0
                while to < len(texts) and (to == at or size < 1_000_000):
                    size += len(texts[to] or "")
                    to += 1
                scores[at:to] = net.score(texts[at:to])
                at = to
            yield pd.Series(np.round(scores, 6))

    return run


def keep_clean(docs: DataFrame, net: BiGru, threshold: float = 0.3) -> DataFrame:
    """Document rows, all columns, whose score is below the threshold."""
    return docs.filter(_scorer(net)("text") < threshold)
