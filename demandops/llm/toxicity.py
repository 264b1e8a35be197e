"""Toxicity: bidirectional gated recurrent network with attention pooling.

Word inputs (hashed word vectors) and character inputs (mean vector of the
word's hashed 3- and 4-grams) go through one GRU per direction; attention
pools the states of a window of ``LENGTH`` words to one logit. A text's score
is the largest over its windows, one from every start position. Scoring runs in
tasks with the broadcast weights, about 2 MB whatever the corpus.

The network is trained in numpy on a bounded sample of labelled texts
(``MAX_TOXIC`` and ``MAX_CLEAN`` texts, the least hashes of their ids). Labels
are of whole texts, so every round first picks windows in tasks, from all
windows of each text: the one that is most likely toxic, and of clean texts
another at random. Only these windows come to the driver, which trains on them.
The first round picks by hashed words that lie in more toxic texts of the
sample than chance gives; the vectors start from the same statistic. Words are
left out at random while training, so that no rare word decides alone.

Defined results: null, empty and wordless texts score 0; very long texts are
scored whole, ``SLICE_CHARS`` of other texts at a time; labels that are null
or of unknown ids are ignored, an id labelled both ways is toxic; an id with
several texts teaches by the least of them; without labelled rows of both kinds
every score is 0; repeated rows are scored row by row; language, source and id
are never inputs. Training runs its jobs while the query is built.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandops.llm.common import bounded_batches, cut, release, shield, sized_join

LENGTH = 32                      #: words of a window
DIM, HIDDEN, ATT = 12, 8, 8      #: input vector, GRU state, attention size
WORDS, GRAMS = 1 << 15, 1 << 13  #: hashed vocabularies
MAX_TOXIC, MAX_CLEAN = 1500, 4000  #: labelled texts to train on
ROUNDS, BATCH, RATE = 4, 64, 0.01
STEPS = 30                       #: least steps of a round: small samples are passed over several times
DROP = 0.2                       #: share of words left out of a training window
PARTS = 32                       #: tasks that pick windows
SEED = 11
CACHE_WORDS = 120_000            #: words a worker remembers
SLICE_CHARS = 600_000
BLOCK = 2048                     #: windows scored at a time

_WORD = re.compile(r"\w{1,64}")  #: longer runs are consecutive words of 64 characters
_MUL = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed word, hashed grams of all words, first gram of each word)."""
    raw = [f"^{w}$".encode("utf-8", "surrogatepass") for w in words]
    buf = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    size = np.array([len(r) for r in raw])
    start = np.cumsum(size) - size
    word = np.array([zlib.crc32(r) % WORDS for r in raw], np.int64)
    h3 = buf[:-2] * np.uint64(65599 * 65599) + buf[1:-1] * np.uint64(65599) + buf[2:]
    h4 = h3[:-1] * np.uint64(65599) + buf[3:] + np.uint64(1 << 40)
    h4 = np.r_[h4, np.uint64(0)]

    def slot(h: np.ndarray) -> np.ndarray:
        return ((h * _MUL) >> np.uint64(64 - 13)).astype(np.int64)
    # a word of n bytes with its marks has n - 2 trigrams and, from four bytes on, n - 3 four-grams
    n3, n4 = size - 2, np.maximum(size - 3, 0)
    at3 = np.repeat(start - (np.cumsum(n3) - n3), n3) + np.arange(n3.sum())
    at4 = np.repeat(start - (np.cumsum(n4) - n4), n4) + np.arange(n4.sum())
    owner = np.r_[np.repeat(np.arange(len(raw)), n3), np.repeat(np.arange(len(raw)), n4)]
    grams = np.r_[slot(h3)[at3], slot(h4)[at4]]
    by = np.argsort(owner, kind="stable")
    return word, grams[by], np.searchsorted(owner[by], np.arange(len(raw)))


def windows_of(n: int) -> list[tuple[int, int]]:
    """All overlapping windows of a text of ``n`` words."""
    return [(a, min(a + LENGTH, n)) for a in range(max(1, n - LENGTH + 1))] if n else []


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Network:
    """Weights, forward and backward pass; axis 0 of GRU weights: direction."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f = lambda *s, k=0.3: (r.standard_normal(s) * k).astype(np.float32)
        self.p = {"word": f(WORDS, DIM, k=0.03), "gram": f(GRAMS, DIM, k=0.03),
                  "win": f(2, DIM, 3 * HIDDEN), "u": f(2, HIDDEN, 3 * HIDDEN), "b": f(2, 1, 3 * HIDDEN, k=0.01),
                  "att": f(2 * HIDDEN, ATT), "ab": f(ATT, k=0.01), "v": f(ATT),
                  "out": f(2 * HIDDEN), "c": np.zeros(1, np.float32)}
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.s = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0

    @classmethod
    def of(cls, weights: dict[str, np.ndarray]) -> "Network":
        """For scoring only: a network of given weights."""
        net = cls.__new__(cls)
        net.p = weights
        return net

    def start_from(self, excess: dict[str, np.ndarray]) -> None:
        """One input of each table starts from its slots' ``excess``."""
        self.p["word"][:, 0] = excess["word"]
        self.p["gram"][:, 1] = excess["gram"]

    def vectors(self, feats) -> np.ndarray:
        word, grams, first = feats
        n = np.diff(np.r_[first, len(grams)])
        return self.p["word"][word] + np.add.reduceat(self.p["gram"][grams], first, axis=0) / n[:, None].astype(np.float32)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """Input part of the gates: (2, words, 3 * HIDDEN)."""
        return vectors @ self.p["win"] + self.p["b"]

    def run(self, gates: np.ndarray, idx: np.ndarray, keep: list | None = None):
        """Logits of windows ``idx`` (rows of word numbers, -1 padded)."""
        p, n = self.p, len(idx)
        turn = np.stack([idx, idx[:, ::-1]])                      # the second reads backwards
        h = np.zeros((2, n, HIDDEN), np.float32)
        states = np.empty((2, LENGTH, n, HIDDEN), np.float32)
        for t in range(LENGTH):
            at = turn[:, :, t]
            mask = (at >= 0)[:, :, None]
            gx = np.stack([gates[0][at[0]], gates[1][at[1]]])
            gh = h @ p["u"]
            zr = _sigmoid(gx[:, :, :2 * HIDDEN] + gh[:, :, :2 * HIDDEN])
            z, r = zr[:, :, :HIDDEN], zr[:, :, HIDDEN:]
            cand = np.tanh(gx[:, :, 2 * HIDDEN:] + r * gh[:, :, 2 * HIDDEN:])
            new = np.where(mask, cand + z * (h - cand), h)
            if keep is not None:
                keep.append((at, mask, h, z, r, cand, gh))
            h = new
            states[0, t], states[1, LENGTH - 1 - t] = h[0], h[1]
        s = np.concatenate([states[0], states[1]], axis=2)        # time, window, 2 * HIDDEN
        mask = (idx.T >= 0)
        u = np.tanh(s @ p["att"] + p["ab"])
        e = np.where(mask, u @ p["v"], -30.0)
        a = np.exp(e - e.max(0))
        a /= a.sum(0)
        pooled = np.einsum("tn,tnk->nk", a, s)
        logit = pooled @ p["out"] + p["c"][0]
        return logit if keep is None else (logit, s, u, a, pooled, mask)

    def slide(self, gates: np.ndarray, room: np.ndarray | None = None) -> np.ndarray:
        """Logits of the windows at every start position of a run of words,
        given the words' gates in order: the same as ``run`` of full windows.
        A sigmoid is half of 1 + tanh of half its input; the halves stand in
        the weights. One product gives a state's part of the next gates and
        of the attention, so that no states are kept. Rows are filled up to
        whole cache lines. ``room``: ``room_for`` as many windows, to work in."""
        p, words, h1 = self.p, gates.shape[1], HIDDEN
        n = -(-(words - LENGTH + 1) // 16) * 16
        sizes = self._sizes(n)
        parts = np.split((self.room_for(n) if room is None else room)[:sum(sizes)], np.cumsum(sizes)[:-1])
        gh, h = parts[0].reshape(2, -1, n), parts[1].reshape(2, h1, n)
        q, g = parts[2].reshape(LENGTH, ATT + 1, n), parts[3].reshape(2, 3 * h1, -1)
        z, r, zr, cand, seen = gh[:, :h1], gh[:, h1:2 * h1], gh[:, :2 * h1], gh[:, 2 * h1:3 * h1], gh[:, 3 * h1:]
        np.multiply(gates.transpose(0, 2, 1), np.repeat(np.float32([0.5, 1]), [2 * h1, h1])[:, None], out=g[:, :, :words])
        g[:, :, words:] = 0
        w = np.concatenate([0.5 * p["u"].transpose(0, 2, 1), p["att"].reshape(2, h1, ATT).transpose(0, 2, 1),
                            p["out"].reshape(2, 1, h1)], axis=1, dtype=np.float32)
        bias = np.r_[p["ab"], np.float32(0)][:, None]
        h[:] = 0
        for t in range(LENGTH + 1):
            np.matmul(w, h, out=gh)
            for d, end in ((0, t - 1), (1, LENGTH - t)) if t else ():  # where the last step's states belong
                if t <= LENGTH // 2:
                    np.add(seen[d], bias, out=q[end])
                else:
                    q[end] += seen[d]
            if t == LENGTH:
                break
            ends = (t, LENGTH - 1 - t)
            for d in (0, 1):
                zr[d] += g[d, :2 * h1, ends[d]:ends[d] + n]
            np.tanh(zr, out=zr)
            zr += 1
            cand *= r
            for d in (0, 1):
                cand[d] += g[d, 2 * h1:, ends[d]:ends[d] + n]
            np.tanh(cand, out=cand)
            h -= cand
            h *= z
            h *= 0.5
            h += cand
        u = q[:, :ATT]
        np.tanh(u, out=u)
        e = p["v"] @ u
        e -= e.max(0)
        np.exp(e, out=e)
        total = e.sum(0)
        e *= q[:, ATT]
        return (e.sum(0) / total + p["c"][0])[:words - LENGTH + 1]

    @staticmethod
    def _sizes(n: int) -> list[int]:
        return [2 * (3 * HIDDEN + ATT + 1) * n, 2 * HIDDEN * n, LENGTH * (ATT + 1) * n, 6 * HIDDEN * (n + LENGTH)]

    @classmethod
    def room_for(cls, windows: int) -> np.ndarray:
        """Numbers that ``slide`` works in, from the start of a cache line."""
        room = np.empty(sum(cls._sizes(-(-windows // 16) * 16)) + 16, np.float32)
        return room[-room.ctypes.data // 4 % 16:]

    def step(self, words: list[list[str]], y: np.ndarray) -> float:
        """One Adam step on windows of words with labels ``y``."""
        names = sorted({w for ws in words for w in ws})
        number = {w: i for i, w in enumerate(names)}
        idx = np.full((len(words), LENGTH), -1, np.int64)
        for i, ws in enumerate(words):
            idx[i, :len(ws)] = [number[w] for w in ws]
        feats = word_features(names)
        x = self.vectors(feats)
        gates = self.project(x)
        keep: list = []
        logit, s, u, a, pooled, mask = self.run(gates, idx, keep)
        p, g = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        prob = _sigmoid(logit)
        dlog = ((prob - y) / len(y)).astype(np.float32)
        g["c"][0], g["out"] = dlog.sum(), pooled.T @ dlog
        dpool = dlog[:, None] * p["out"]
        da = np.einsum("tnk,nk->tn", s, dpool)
        ds = a[:, :, None] * dpool
        de = a * (da - (a * da).sum(0))
        g["v"] = np.einsum("tn,tnk->k", de, u)
        du = de[:, :, None] * p["v"] * (1 - u * u)
        g["att"], g["ab"] = np.einsum("tnk,tnj->kj", s, du), du.sum((0, 1))
        ds = ds + du @ p["att"].T
        dh = np.zeros_like(keep[0][2])
        dgates = np.zeros_like(gates)
        for t in range(LENGTH - 1, -1, -1):
            at, m, h, z, r, cand, gh = keep[t]
            dh = dh + np.stack([ds[t, :, :HIDDEN], ds[LENGTH - 1 - t, :, HIDDEN:]])
            live = np.where(m, dh, 0)
            dcand = live * (1 - z) * (1 - cand * cand)
            dz = live * (h - cand) * z * (1 - z)
            dr = dcand * gh[:, :, 2 * HIDDEN:] * r * (1 - r)
            dgx = np.concatenate([dz, dr, dcand], axis=2)
            dgh = np.concatenate([dz, dr, dcand * r], axis=2)
            g["u"] += np.swapaxes(h, 1, 2) @ dgh
            dh = np.where(m, live * z, dh) + dgh @ np.swapaxes(p["u"], 1, 2)
            for d in (0, 1):
                ok = at[d] >= 0
                np.add.at(dgates[d], at[d][ok], dgx[d][ok])
        g["b"] = dgates.sum(1, keepdims=True)
        g["win"] = np.stack([x.T @ dgates[d] for d in (0, 1)])
        dx = sum(dgates[d] @ p["win"][d].T for d in (0, 1))
        word, grams, first = feats
        n = np.diff(np.r_[first, len(grams)])
        np.add.at(g["word"], word, dx)
        np.add.at(g["gram"], grams, np.repeat(dx / n[:, None].astype(np.float32), n, axis=0))
        self._adam(g)
        return float(-np.mean(y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7)))

    def _adam(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        rate = RATE * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, v in g.items():
            self.m[k] += 0.1 * (v - self.m[k])
            self.s[k] += 0.001 * (v * v - self.s[k])
            self.p[k] -= (rate * self.m[k] / (np.sqrt(self.s[k]) + 1e-7)).astype(np.float32)


class Scorer:
    """Largest window score of texts, with a bounded memory of words."""

    def __init__(self, net: Network):
        self.net = net
        self.room = net.room_for(BLOCK)  # new pages for every block would cost more than its steps
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.gates = np.zeros((2, 0, 3 * HIDDEN), np.float32)

    def _learn(self, names: list[str]) -> None:
        n = len(self.number)
        gates = self.net.project(self.net.vectors(word_features(names)))
        if self.gates.shape[1] < n + len(names):
            room = np.zeros((2, max(1 << 14, 2 * (n + len(names))), 3 * HIDDEN), np.float32)
            room[:, :n] = self.gates[:, :n]
            self.gates = room
        self.gates[:, n:n + len(names)] = gates
        self.number.update(zip(names, range(n, n + len(names))))

    def logits(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(logit, text number) of every window."""
        if len(self.number) > CACHE_WORDS:
            self.clear()
        new = list(set(chain.from_iterable(texts)).difference(self.number))
        for a in range(0, len(new), 50_000):
            self._learn(new[a:a + 50_000])
        sizes = np.array([len(ws) for ws in texts])
        flat = np.fromiter(map(self.number.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
        first = np.cumsum(sizes) - sizes
        per = np.where(sizes > 0, np.maximum(1, sizes - LENGTH + 1), 0)
        owner = np.repeat(np.arange(len(texts)), per)
        begin = first[owner] + np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        out = np.empty(len(owner), np.float32)
        # windows that a text fills: all start positions of a stretch of words
        # at a time, those across two texts are left out
        full = np.flatnonzero(sizes[owner] >= LENGTH)
        at, starts = 0, begin[full]
        while at < len(full):
            a = starts[at]
            to = int(np.searchsorted(starts, a + BLOCK))
            mine = full[at:to]
            logit = self.net.slide(self.gates[:, flat[a:begin[mine[-1]] + LENGTH]], self.room)
            out[mine] = logit[begin[mine] - a]
            at = to
        short = np.flatnonzero(sizes[owner] < LENGTH)
        span = np.arange(LENGTH)
        for a in range(0, len(short), BLOCK):
            some = short[a:a + BLOCK]
            at = begin[some, None] + span
            ok = span < sizes[owner[some], None]
            out[some] = self.net.run(self.gates, np.where(ok, flat[np.minimum(at, len(flat) - 1)], -1))
        return out, owner

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        for a, part in _slices(texts):
            worded = [words_of(t) for t in part]
            logit, owner = self.logits(worded)
            best = np.full(len(part), -np.inf)
            np.maximum.at(best, owner, logit)
            out[a:a + len(part)] = np.where(np.isfinite(best), _sigmoid(best), 0.0)
        return out


def _slices(texts: list) -> Iterator[tuple[int, list]]:
    a, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if chars >= SLICE_CHARS:
            yield a, texts[a:i + 1]
            a, chars = i + 1, 0
    if a < len(texts):
        yield a, texts[a:]


def _top_windows(net: Network, worded: list[list[str]], which: list[int]) -> list[tuple[int, int]]:
    """(text, start) of the highest of all windows of each text."""
    scorer, top, words = Scorer(net), [], 0
    part: list[int] = []
    for n, i in enumerate(which):
        part.append(i)
        words += len(worded[i])
        if words < SLICE_CHARS // 8 and n + 1 < len(which):
            continue
        logit, owner = scorer.logits([worded[j] for j in part])
        start = np.searchsorted(owner, np.arange(len(part) + 1))
        top += [(j, int(np.argmax(logit[start[k]:start[k + 1]]))) for k, j in enumerate(part)]
        part, words = [], 0
    return top


def _top_by_words(excess: np.ndarray, worded: list[list[str]], which: list[int]) -> list[tuple[int, int]]:
    """(text, start) of the window of each text with the most excess of its words."""
    top = []
    for i in which:
        word = word_features(worded[i])[0]
        total = np.cumsum(np.r_[0.0, np.maximum(excess[word], 0) ** 2])
        n = min(LENGTH, len(word))
        top.append((i, int(np.argmax(total[n:] - total[:len(total) - n]))))
    return top


def slot_counts(sample: DataFrame) -> pd.DataFrame:
    """Texts and toxic texts of the sample by hashed slot: at most WORDS + GRAMS rows."""
    def slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["_y"]):
                words = sorted(set(words_of(text)))
                if words:
                    word, grams, _ = word_features(words)
                    both = np.unique(word), np.unique(grams)
                    yield pd.DataFrame({"kind": np.repeat(["word", "gram"], [len(b) for b in both]),
                                        "slot": np.concatenate(both), "y": int(y)})
    rows = sample.mapInPandas(slots, "kind string, slot long, y long")
    return rows.groupBy("kind", "slot").agg(F.count("*").alias("n"), F.sum("y").alias("toxic")).toPandas()


def slot_excess(counts: pd.DataFrame, share: float) -> dict[str, np.ndarray]:
    """How far a slot's toxic texts exceed ``share`` of its texts, in thirds of
    standard deviations between -1 and 1. One text of each slot is left out:
    what a single toxic text holds says nothing of others."""
    out = {"word": np.zeros(WORDS, np.float32), "gram": np.zeros(GRAMS, np.float32)}
    for kind, c in counts.groupby("kind"):
        n, toxic = c["n"].to_numpy() - 1, np.maximum(c["toxic"].to_numpy() - 1, 0)
        z = (toxic - share * n) / np.sqrt(share * (1 - share) * n + 0.5)
        out[kind][c["slot"].to_numpy()] = np.clip(z / 3, -1, 1)
    return out


def pick_windows(sample: DataFrame, weights: dict[str, np.ndarray] | None, excess: np.ndarray, turn: int) -> pd.DataFrame:
    """Training windows (_id, other, _y, words) of a round, from all windows
    of the sample's texts: at most two of LENGTH words a text. The random ones
    hang on the id and the round, so a task that runs again picks the same."""
    sc = sample.sparkSession.sparkContext
    held = sc.broadcast((weights, excess))  # plain arrays of fixed size

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, by_word = held.value
        for pdf in batches:
            for a, part in _slices(pdf["text"].tolist()):
                worded = [words_of(t) for t in part]
                ids, y = pdf["_id"].iloc[a:a + len(part)].tolist(), pdf["_y"].iloc[a:a + len(part)].tolist()
                which = [i for i, ws in enumerate(worded) if ws]
                top = _top_by_words(by_word, worded, which) if known is None else \
                    _top_windows(Network.of(known), worded, which)
                rows = [(ids[i], 0, y[i], worded[i][k:k + LENGTH]) for i, k in top]
                for i in which:
                    rng = np.random.default_rng([SEED, turn, zlib.crc32(str(ids[i]).encode())])
                    if y[i] == 0 and (turn == 0 or rng.random() < 0.5):
                        k = int(rng.integers(max(1, len(worded[i]) - LENGTH + 1)))
                        rows.append((ids[i], 1, 0, worded[i][k:k + LENGTH]))
                yield pd.DataFrame(rows, columns=["_id", "other", "_y", "words"])
    schema = f"_id {sample.schema['_id'].dataType.simpleString()}, other int, _y int, words array<string>"
    got = sample.mapInPandas(pick, schema).toPandas()
    held.destroy()
    return got.sort_values(["_id", "other"]).reset_index(drop=True)


def train(sample: DataFrame, seed: int = SEED) -> Network | None:
    """A network from whole-text labels (_id, _y, text); None without both kinds."""
    kinds = dict(sample.filter(F.col("text").rlike(r"(?U)\w")).groupBy("_y").count().collect())
    if len(kinds) < 2:
        return None
    excess = slot_excess(slot_counts(sample), kinds[1] / (kinds[0] + kinds[1]))
    rng, net = np.random.default_rng(seed), Network()
    net.start_from(excess)
    for turn in range(ROUNDS):
        chosen = pick_windows(sample, net.p if turn else None, excess["word"], turn)
        words, y = chosen["words"].tolist(), chosen["_y"].to_numpy(np.float32)
        for _ in range(max(1, -(-STEPS * BATCH // len(y)))):
            order = rng.permutation(len(y))
            for a in range(0, len(y), BATCH):
                part = order[a:a + BATCH]
                net.step([[w for w in words[i] if rng.random() >= DROP] or list(words[i][:1]) for i in part], y[part])
    net.m = net.s = {}
    return net


def score_column(spark, net: Network | None, text: Column) -> Column:
    if net is None:
        return F.lit(0.0)
    bounded_batches(spark)
    held = spark.sparkContext.broadcast(net.p)  # plain arrays of fixed size, see the module's head

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(Network.of(held.value))
        for part in batches:
            yield pd.Series(scorer.scores(part.tolist()))
    return score(text)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str) -> DataFrame:
    """The bounded sample, one row an id: id, label and text of the ids with the least hashes."""
    marked = (labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_y"))
              .filter("_id is not null and _y in (0, 1)").groupBy("_id").agg(F.max("_y").alias("_y")))
    ids = docs.select(F.col(f"`{id_col}`").alias("_id")).join(marked, "_id").distinct()
    least = [ids.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
             for y, n in ((1, MAX_TOXIC), (0, MAX_CLEAN))]
    sample = least[0].unionByName(least[1])
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("text"))
    texts = (sized_join(rows, sample, ["_id"], rows=MAX_TOXIC + MAX_CLEAN)
             .groupBy("_id", "_y").agg(F.coalesce(F.min("text"), F.lit("")).alias("text")))
    return cut(texts.repartition(PARTS, "_id"), "toxicity-sample")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
             label: str = "toxic", train_on: Column | None = None, threshold: float = 0.7) -> DataFrame:
    """``docs`` with score and predicted (columns of these names are replaced).
    ``train_on``: condition on the rows whose labels may be learnt."""
    bounded_batches(docs.sparkSession)
    known = docs if train_on is None else docs.filter(train_on)
    docs, restore = shield(docs, [text])
    sample = training_rows(known, labels, id_col, text, label)
    net = train(sample)
    release(sample)
    judged = (docs.withColumn("score", score_column(docs.sparkSession, net, F.col(f"`{text}`")))
              .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
    return restore(judged, "score", "predicted")
