"""Toxicity of texts: a bidirectional gated recurrent network with attention pooling over overlapping windows of words.

A word's input is the vector of the word (known words only) plus the mean of the vectors of its character strings, so unknown words
are read by their letters. Both directions run over windows of WINDOW words that start every STEP words; attention pools a window into a
logit. A text scores as its most toxic window. The network is trained in numpy on a bounded sample of labelled texts, whose labels
hold for whole texts: each step moves the highest window of each text of a batch. Tasks score batches of texts with the broadcast
parameters, a few hundred kilobytes whatever the corpus.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common

WINDOW, STEP = 32, 16
#: Labelled texts of each class that the network is trained on at most.
TRAINED_ON = {1: 1000, 0: 2000}
#: Windows of a training text that are looked at, evenly spread over it, and bytes of such a text that the driver may hold.
TRAINING_WINDOWS, TRAINING_BYTES = 512, 1 << 20
KNOWN_WORDS, LEAST_TEXTS = 20_000, 3
#: Lengths in bytes of the character strings of a word (all inner ones, its beginnings; edges included), and rows of their table.
INNER, BEGINNINGS = 3, (6, 8)
GRAM_ROWS = 1 << 15
EMBEDDED, HIDDEN, ATTENDED = 8, 8, 8
EPOCHS, BATCH, RATE = 14, 32, 0.01
#: Steps of the training at least: a small sample is gone through more often.
LEAST_UPDATES = 1000
DECAY = 0.01
#: Windows that go through the network together, and distinct words whose character strings are looked up together.
TOGETHER, WORDS_TOGETHER = 2048, 8192
_R = 0x9E3779B97F4A7C15 | 1
_SIGN = np.zeros(256, dtype=bool)
_SIGN[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True


def sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Vocabulary:
    """The distinct words of a batch, lower-cased, without signs around them: `hashes`, and per word of the batch its number in `of`; the
    character strings of word i are `grams[begin[i] : begin[i + 1]]`."""

    def __init__(self, column: pa.Array):
        w = common.Words(column, lower=True)
        for _ in range(3):
            w.ends = w.ends - (_SIGN[w.data[w.ends - 1]] & (w.ends - w.starts > 1))
            w.starts = w.starts + (_SIGN[w.data[w.starts]] & (w.ends - w.starts > 1))
        self.words = w
        self.hashes, first, self.of = np.unique(w.hashes(), return_index=True, return_inverse=True)
        starts, sizes = w.starts[first], (w.ends - w.starts)[first]
        total = sizes + len(BEGINNINGS)
        self.begin = np.cumsum(total) - total
        parts = [self._grams(starts[a : a + WORDS_TOGETHER], sizes[a : a + WORDS_TOGETHER]) for a in range(0, len(sizes), WORDS_TOGETHER)]
        self.grams = np.concatenate([np.zeros(0, np.int32), *parts])

    def _grams(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Table rows of the character strings of some distinct words, word after word."""
        # The words in one row of bytes, a space before and after each.
        edges = np.cumsum(sizes + 1) - sizes
        data = np.full(int(edges[-1] + sizes[-1]) + 1, 32, dtype=np.uint64)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        data[edges[owner] + inner] = self.words.data[starts[owner] + inner]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * common.powers(_R, len(data)), dtype=np.uint64)])
        # Of " word ": every string of INNER bytes, and the beginnings of the lengths BEGINNINGS.
        total = sizes + len(BEGINNINGS)
        owner = np.repeat(np.arange(len(sizes)), total)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(total) - total, total)
        beyond = place - sizes[owner]
        size = np.where(beyond < 0, INNER, np.array(BEGINNINGS)[np.maximum(beyond, 0)])
        place = np.where(beyond < 0, place, 0)
        low = edges[owner] - 1 + place
        high = np.minimum(low + size, (edges + sizes + 1)[owner])
        gram = (sums[high] - sums[low]) * common.powers(pow(_R, -1, 2**64), len(sums))[low]
        return (common.mix(gram + size.astype(np.uint64)) % np.uint64(GRAM_ROWS)).astype(np.int32)

    def windows(self, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, word numbers, lengths) of all windows: numbers index the distinct words, one past them where a window is short."""
        counts = self.words.counts()
        n = np.where(counts > 0, np.maximum(0, -(-(counts - WINDOW) // STEP)) + 1, 0)
        row = np.repeat(np.arange(len(n)), n)
        number = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        if most is not None and len(n) and n.max() > most:
            some = np.zeros(len(row), dtype=bool)
            for i, (a, k) in enumerate(zip(np.cumsum(n) - n, n)):
                some[a + np.unique(np.linspace(0, k - 1, min(k, most)).astype(int))] = True
            row, number = row[some], number[some]
        length = np.minimum(WINDOW, counts[row] - number * STEP)
        start, of = self.words.first[row] + number * STEP, np.append(self.of, len(self.hashes)).astype(np.int32)
        numbers = np.empty((len(row), WINDOW), np.int32)
        for t in range(WINDOW):
            numbers[:, t] = np.where(t < length, of[np.minimum(start + t, len(of) - 1)], len(self.hashes))
        return row, numbers, length


@dataclass
class Network:
    """Parameters; `known` are the sorted hashes of the known words, row 0 of `word` stands for all others."""

    known: np.ndarray
    p: dict[str, np.ndarray]

    @classmethod
    def start(cls, known: np.ndarray, odds: np.ndarray, rng) -> "Network":
        """Small random parameters; a word's first component starts as its log-odds, which the first unit of both directions sees."""

        def small(*shape, scale=0.3):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        p = {"word": small(len(known) + 1, EMBEDDED, scale=0.1), "gram": small(GRAM_ROWS, EMBEDDED, scale=0.1)}
        p["word"][1:, 0] += odds
        for d in "fb":
            p[f"in_{d}"], p[f"up_{d}"], p[f"bias_{d}"] = small(EMBEDDED, 3 * HIDDEN), small(HIDDEN, 3 * HIDDEN), np.zeros(3 * HIDDEN, np.float32)
            p[f"in_{d}"][0, 2 * HIDDEN] = 1.0
        p["look"], p["weigh"] = small(2 * HIDDEN, ATTENDED), small(ATTENDED)
        p["out"], p["bias"] = small(2 * HIDDEN), np.array([-1.0], np.float32)
        p["out"][0] = p["out"][HIDDEN] = 1.0
        return cls(known, p)

    def word_rows(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        return np.where(self.known[at] == hashes, at + 1, 0) if len(self.known) else np.zeros(len(hashes), np.int64)

    def inputs(self, v: Vocabulary) -> np.ndarray:
        """Vectors of the distinct words, and zeros for none."""
        x, ends = self.p["word"][self.word_rows(v.hashes)], np.append(v.begin, len(v.grams))
        for a in range(0, len(v.hashes), WORDS_TOGETHER):
            some = ends[a : a + WORDS_TOGETHER + 1]
            sums = np.add.reduceat(self.p["gram"][v.grams[some[0] : some[-1]]], some[:-1] - some[0], axis=0)
            x[a : a + WORDS_TOGETHER] += sums / np.diff(some)[:, None].astype(np.float32)
        return np.concatenate([x, np.zeros((1, EMBEDDED), np.float32)])

    def run(self, projected: dict[str, np.ndarray], numbers: np.ndarray, lengths: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """Logits of windows, given the distinct words' inputs times the input matrices. `trace` keeps what `gradients` needs."""
        p, n, h3 = self.p, len(numbers), HIDDEN
        out = np.empty((WINDOW, n, 2 * HIDDEN), np.float32)
        for d, steps, part in (("f", range(WINDOW), slice(0, HIDDEN)), ("b", range(WINDOW - 1, -1, -1), slice(HIDDEN, 2 * HIDDEN))):
            h = np.zeros((n, HIDDEN), np.float32)
            for t in steps:
                x = projected[d][numbers[:, t]]
                u = h @ p[f"up_{d}"]
                gates = sigmoid(x[:, : 2 * h3] + u[:, : 2 * h3])
                z, r = gates[:, :h3], gates[:, h3:]
                c = np.tanh(x[:, 2 * h3 :] + r * u[:, 2 * h3 :])
                new = c + z * (h - c)
                new = np.where((lengths > t)[:, None], new, h)
                if trace is not None:
                    trace[d, t] = (h, u, z, r, c)
                h = new
                out[t, :, part] = h
        seen = np.tanh(out @ p["look"])
        weight = seen @ p["weigh"]
        weight[np.arange(WINDOW)[:, None] >= lengths] = -np.inf
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * out).sum(axis=0)
        if trace is not None:
            trace["all"] = (out, seen, weight, pooled)
        return pooled @ p["out"] + p["bias"]

    def project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {d: x @ self.p[f"in_{d}"] + self.p[f"bias_{d}"] for d in "fb"}

    def logits(self, v: Vocabulary, numbers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        projected = self.project(self.inputs(v))
        parts = [self.run(projected, numbers[a : a + TOGETHER], lengths[a : a + TOGETHER]) for a in range(0, len(numbers), TOGETHER)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def gradients(self, v: Vocabulary, numbers: np.ndarray, lengths: np.ndarray, aim: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy of the windows' logits against `aim`."""
        p, h3 = self.p, HIDDEN
        x_all = self.inputs(v)
        trace: dict = {}
        logits = self.run(self.project(x_all), numbers, lengths, trace)
        out, seen, weight, pooled = trace["all"]
        g = {name: np.zeros_like(value) for name, value in p.items()}
        d_logit = (sigmoid(logits) - aim).astype(np.float32) / len(aim)
        g["bias"][0], g["out"] = d_logit.sum(), d_logit @ pooled
        d_pooled = d_logit[:, None] * p["out"]
        d_weight = (out * d_pooled).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["weigh"] = np.einsum("tn,tna->a", d_score, seen)
        d_seen = d_score[:, :, None] * p["weigh"] * (1 - seen**2)
        g["look"] = np.einsum("tnh,tna->ha", out, d_seen)
        d_out = weight[:, :, None] * d_pooled + d_seen @ p["look"].T
        d_x = np.zeros_like(x_all)
        for d, steps, part in (("f", range(WINDOW - 1, -1, -1), slice(0, HIDDEN)), ("b", range(WINDOW), slice(HIDDEN, 2 * HIDDEN))):
            d_h = np.zeros((len(aim), HIDDEN), np.float32)
            for t in steps:
                h, u, z, r, c = trace[d, t]
                on = (lengths > t)[:, None]
                d_h = d_h + d_out[t][:, part]
                d_new = np.where(on, d_h, 0)
                d_c = d_new * (1 - z) * (1 - c**2)
                d_gates = np.concatenate([d_new * (h - c) * z * (1 - z), d_c * u[:, 2 * h3 :] * r * (1 - r)], axis=1)
                d_u = np.concatenate([d_gates, d_c * r], axis=1)
                d_in = np.concatenate([d_gates, d_c], axis=1)
                g[f"up_{d}"] += h.T @ d_u
                g[f"bias_{d}"] += d_in.sum(axis=0)
                g[f"in_{d}"] += x_all[numbers[:, t]].T @ d_in
                np.add.at(d_x, numbers[:, t], d_in @ p[f"in_{d}"].T)
                d_h = np.where(on, d_new * z, d_h) + d_u @ p[f"up_{d}"].T
        d_x = d_x[:-1]
        np.add.at(g["word"], self.word_rows(v.hashes), d_x)
        sizes = np.diff(np.append(v.begin, len(v.grams)))
        np.add.at(g["gram"], v.grams, np.repeat(d_x / np.maximum(sizes, 1)[:, None], sizes, axis=0).astype(np.float32))
        return g


def _column(texts: list[str]) -> pa.Array:
    return pa.array(texts, pa.string())


def _log_odds(item: np.ndarray, text: np.ndarray, toxic: np.ndarray, n: int):
    """Items in at least LEAST_TEXTS texts, most frequent first, and each item's log-odds of toxic over other texts that have it."""
    pair = np.unique(item.astype(np.int64) * len(toxic) + text)
    has = [np.bincount(pair[toxic[pair % len(toxic)] == c] // len(toxic), minlength=n) for c in (0, 1)]
    often = np.flatnonzero(has[0] + has[1] >= LEAST_TEXTS)
    share = [(h + 0.5) / ((toxic == c).sum() + 1.0) for c, h in enumerate(has)]
    return often[np.argsort(-(has[0] + has[1])[often], kind="stable")], np.clip(np.log(share[1] / share[0]), -3, 3).astype(np.float32)


def train(texts: list[str], toxic: np.ndarray, seed: int = 7, totals: tuple[int, int] | None = None) -> Network:
    """A network for texts labelled 0 or 1. With texts of one class only, or none, it gives every text the smoothed base rate.

    `totals` are the counts of the classes that the texts are drawn from (else those of the texts): the threshold errs least at that ratio.
    """
    rng = np.random.default_rng(seed)
    v = Vocabulary(_column(texts))
    totals = totals or tuple(int((toxic == c).sum()) for c in (0, 1))
    rate = (totals[1] + 0.5) / (sum(totals) + 1.0)
    row = v.words.rows()
    top, odds = _log_odds(v.of, row, toxic, len(v.hashes))
    chosen = np.sort(top[:KNOWN_WORDS])
    net = Network.start(v.hashes[chosen], odds[chosen], rng)
    if toxic.min(initial=1) == toxic.max(initial=0) or not len(toxic):
        net.p["out"][:] = 0
        net.p["bias"][0] = np.log(rate / (1 - rate))
        return net

    window_row, numbers, lengths = v.windows(TRAINING_WINDOWS)
    first = np.searchsorted(window_row, np.arange(len(texts) + 1))
    usable = np.flatnonzero(np.diff(first))
    moments = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in net.p.items()}
    done, epochs = 0, max(EPOCHS, -(-LEAST_UPDATES // max(1, -(-len(usable) // BATCH))))
    for epoch in range(epochs):
        best = np.empty(len(texts), dtype=np.int64)
        scored = net.logits(v, numbers, lengths)  # where each text is most toxic, as the network sees it now
        for i in usable:
            best[i] = first[i] + scored[first[i] : first[i + 1]].argmax()
        order = rng.permutation(usable)
        for a in range(0, len(order), BATCH):
            some = order[a : a + BATCH]
            g = _batch_gradients(net, v, numbers[best[some]], lengths[best[some]], toxic[some])
            done += 1
            rate_now = RATE * (1 - epoch / epochs) * np.sqrt(1 - 0.999**done) / (1 - 0.9**done)
            for k, x in net.p.items():
                m, s = moments[k]
                m += 0.1 * (g[k] - m)
                s += 0.001 * (g[k] ** 2 - s)
                x -= (rate_now * (m / (np.sqrt(s) + 1e-8) + DECAY * x)).astype(np.float32)
    scored = net.logits(v, numbers, lengths)
    highest = np.maximum.reduceat(scored, first[usable]) if len(usable) else scored
    drawn = [max(1, int((toxic[usable] == c).sum())) for c in (0, 1)]
    net.p["bias"][0] -= _border(highest, toxic[usable], (totals[0] * drawn[1], totals[1] * drawn[0]))
    return net


def _border(logits: np.ndarray, toxic: np.ndarray, weights: tuple[int, int] = (1, 1)) -> float:
    """The middle of the logits that part the classes with the fewest errors, those on class c counted `weights[c]` times."""
    order = np.argsort(logits, kind="stable")
    logits, toxic = logits[order], toxic[order]
    # Errors if the first i count as clean and the others as toxic.
    missed, wrong = np.concatenate([[0], np.cumsum(toxic)]), np.concatenate([np.cumsum((1 - toxic)[::-1])[::-1], [0]])
    errors = missed * weights[1] + wrong * weights[0]
    best = np.flatnonzero(errors == errors.min())
    below, above = logits[max(0, best[0] - 1)], logits[min(len(logits) - 1, best[-1])]
    return float((below + above) / 2)


class _Part(Vocabulary):
    """The distinct words of a few windows, renumbered."""

    def __init__(self, whole: Vocabulary, numbers: np.ndarray):
        used, self.numbers = np.unique(numbers, return_inverse=True)
        self.numbers = self.numbers.reshape(numbers.shape)
        real = used[used < len(whole.hashes)]
        self.numbers[self.numbers >= len(real)] = len(real)
        ends = np.append(whole.begin, len(whole.grams))
        sizes = (ends[1:] - ends[:-1])[real]
        self.hashes = whole.hashes[real]
        self.begin = np.cumsum(sizes) - sizes
        self.grams = whole.grams[np.repeat(whole.begin[real] - self.begin, sizes) + np.arange(sizes.sum())].astype(np.int64)


def _batch_gradients(net, v, numbers, lengths, aim):
    part = _Part(v, numbers)
    return net.gradients(part, part.numbers, lengths, aim.astype(np.float32))


def held_out(doc_id) -> F.Column:
    """Whether a document is kept from training: one in five, by a checksum of its id."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most: dict[int, int] = TRAINED_ON) -> Network:
    """Train on at most `most[c]` texts of each class c, drawn by a hash of the id among labelled documents that are not held out.

    `docs` has doc_id, text; `labels` doc_id, toxic (0, 1; null: not labelled; several rows of a document: the highest counts). The threshold
    is set for the ratio of the classes among all those labelled documents, whatever was drawn.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id")))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    drawn = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c, n in most.items()]
    ids = F.broadcast(drawn[0].unionByName(drawn[1]))  # at most sum(most.values()) rows
    rows = docs.select("doc_id", "text").join(ids, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    rows = rows.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= TRAINING_BYTES)
    found = sorted(rows.collect(), key=lambda r: r["doc_id"])
    return train([r["text"] or "" for r in found], np.array([r["toxic"] for r in found], dtype=np.int64), totals=(counts.get(0, 0), counts.get(1, 0)))


def score_batch(column: pa.Array, net: Network) -> np.ndarray:
    """Score of each text: that of its most toxic window; of a text without words, that of no input."""
    v = Vocabulary(column)
    row, numbers, lengths = v.windows()
    top = np.full(len(column), -np.inf, dtype=np.float64)
    np.maximum.at(top, row, net.logits(v, numbers, lengths).astype(np.float64))
    top[np.isneginf(top)] = net.p["bias"][0]
    return 1 / (1 + np.exp(-top))


def score(docs: DataFrame, net: Network, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and score (0 to 1) of each row of `docs` (doc_id, text), over all windows of its whole text.

    Only the text matters. Null and empty texts get the network's score for no input. Columns not kept are ignored; a kept column named
    score gives way. An empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batch: pa.RecordBatch) -> dict:
        return {"score": score_batch(batch.column("text"), shared.value)}

    return common.per_batch(docs.select(*dict.fromkeys([*keep, "text"])), run, "score double", keep)
