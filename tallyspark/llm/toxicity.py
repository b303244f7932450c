"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word enters as a vector of word inputs (its bucket's log-odds and a trained
embedding) and character inputs (the same for its 4-byte pieces, and log-odds
of its first four, five and six bytes).  Two gated recurrent chains read a window of 32 words from both
ends, attention weighs their states, and a logistic unit scores the window.
Windows overlap by eight words and cover the whole text; a logistic unit scores
the document from its three worst windows and the mean of all.

Training is in numpy on the driver, on at most ``TRAIN_DOCS`` labelled
documents (clean, toxic), chosen by a hash of their id.  The log-odds a
document trains with come from the folds it isn't in.  The inputs of a score are text only.

A null or empty text is scored as a window without words.  Rows whose label is
null teach nothing; a document labelled twice counts as toxic if either says
so.  Without labelled documents of both classes every score is 0.5.  Repeated
rows are scored each; a null doc_id is scored and counts as not held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import clean_columns, slices, text_buffer
from .words import LOWER, mix, powers, prefix_sums, word_spans

WINDOW, STRIDE = 32, 24
TRAIN_DOCS = (2500, 1000)
TRAIN_SLICE = 1 << 19
THRESHOLD = 0.7
WORD_BUCKETS, PIECE_BUCKETS = 1 << 16, 1 << 15
#: Lengths in bytes of the word beginnings that have a bucket.
HEADS = (4, 5, 6)
EMBEDDED = 4
HIDDEN = 8
ODDS = 3 + len(HEADS)
INPUTS = ODDS + 2 * EMBEDDED
SMOOTH = 3.0
#: Rounds over the training windows: at least EPOCHS, and STEPS batches.
EPOCHS, STEPS, BATCH, RATE = 4, 300, 64, 0.02
FOLDS = 4
SLICE = 2 << 20


#: A word here is a run of letters, digits and characters beyond ASCII.
NO_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def lower_case(data: np.ndarray) -> np.ndarray:
    """A-Z and the capital letters of Latin-1 in UTF-8, in lower case."""
    out = LOWER[data]
    wide = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[1:][wide] += 0x20
    return out


class Words:
    """The distinct words of a slice, their buckets, and each place's word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = lower_case(data)
        starts, ends, self.first = word_spans(data, offsets, NO_WORD)
        sums, down = prefix_sums(data), powers(len(data))[1]
        span = lambda a, b: mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        h, at, self.word = np.unique(span(starts, ends), return_index=True, return_inverse=True)
        self.bucket = (h >> np.uint64(48)).astype(np.int64)
        starts, ends = starts[at], ends[at]
        self.pieces = np.maximum(1, ends - starts - 3)
        self.piece_at = np.cumsum(self.pieces) - self.pieces
        begin = np.repeat(starts - self.piece_at, self.pieces) + np.arange(int(self.pieces.sum()))
        stop = np.minimum(begin + 4, np.repeat(ends, self.pieces))
        to_bucket = np.uint64(64 - 15)
        self.piece = (span(begin, stop) >> to_bucket).astype(np.int64)
        heads = [mix(span(starts, np.minimum(starts + n, ends)) + np.uint64(1)) >> to_bucket for n in HEADS]
        self.head = np.stack(heads, axis=1).astype(np.int64)

    def of_pieces(self, values: np.ndarray, how=np.add) -> np.ndarray:
        return how.reduceat(values[self.piece], self.piece_at, axis=0) if len(self.bucket) else values[:0]


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """text, first word and word count of every window; a text has at least one."""
    n = np.diff(first)
    count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    # The last window ends with the text.
    start = first[:-1][text] + np.maximum(0, np.minimum(nth * STRIDE, n[text] - WINDOW))
    return text, start, np.minimum(n[text], WINDOW)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(rng: np.random.Generator, log_odds: tuple[np.ndarray, ...]) -> dict[str, np.ndarray]:
    draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    p = dict(zip(("word_odds", "piece_odds", "head_odds"), log_odds, strict=True))
    p |= {"word_in": draw(WORD_BUCKETS, EMBEDDED) * 0.1, "piece_in": draw(PIECE_BUCKETS, EMBEDDED) * 0.1}
    for side in "fb":
        p |= {f"W{side}": draw(INPUTS, 3 * HIDDEN), f"U{side}": draw(HIDDEN, 3 * HIDDEN), f"b{side}": np.zeros(3 * HIDDEN, np.float32)}
    return p | {"A": draw(2 * HIDDEN, HIDDEN), "a": draw(HIDDEN), "v": draw(2 * HIDDEN), "c": np.zeros(1, np.float32)}


def inputs(p: dict[str, np.ndarray], words: Words) -> np.ndarray:
    """One row for each distinct word, and a last one of zeros for no word."""
    n = len(words.bucket)
    x = np.zeros((n + 1, INPUTS), np.float32)
    if n:
        x[:n, 0] = p["word_odds"][words.bucket]
        x[:n, 1] = words.of_pieces(p["piece_odds"], np.maximum)
        x[:n, 2] = words.of_pieces(p["piece_odds"]) / words.pieces
        x[:n, 3:ODDS] = p["head_odds"][words.head]
        x[:n, ODDS : ODDS + EMBEDDED] = p["word_in"][words.bucket]
        x[:n, ODDS + EMBEDDED :] = words.of_pieces(p["piece_in"]) / words.pieces[:, None]
    return x


def run_chain(projected: np.ndarray, index: np.ndarray, real: np.ndarray, U: np.ndarray, keep: bool = False):
    """States of one chain; index: word of each (step, window)."""
    steps, n = index.shape
    h = np.zeros((n, HIDDEN), np.float32)
    states, tape = np.empty((steps, n, HIDDEN), np.float32), []
    for t in range(steps):
        g = projected[index[t]]
        z_r = sigmoid(g[:, : 2 * HIDDEN] + h @ U[:, : 2 * HIDDEN])
        z, r = z_r[:, :HIDDEN], z_r[:, HIDDEN:]
        new = np.tanh(g[:, 2 * HIDDEN :] + (r * h) @ U[:, 2 * HIDDEN :])
        z = z * real[t][:, None]
        if keep:
            tape.append((h, z, r, new))
        h = h + z * (new - h)
        states[t] = h
    return states, tape


def forward(p: dict[str, np.ndarray], x: np.ndarray, index: np.ndarray, real: np.ndarray, keep: bool = False):
    fwd, tape_f = run_chain(x @ p["Wf"] + p["bf"], index, real, p["Uf"], keep)
    bwd, tape_b = run_chain(x @ p["Wb"] + p["bb"], index[::-1], real[::-1], p["Ub"], keep)
    s = np.concatenate([fwd, bwd[::-1]], axis=2)
    u = np.tanh(s @ p["A"])
    e = np.where(real, u @ p["a"], -1e9)
    w = np.exp(e - e.max(axis=0)) * real
    w /= np.maximum(w.sum(axis=0), 1e-9)
    pooled = np.einsum("tn,tnh->nh", w, s)
    return pooled @ p["v"] + p["c"], (tape_f, tape_b, s, u, w, pooled)


def backward(p: dict[str, np.ndarray], x: np.ndarray, index: np.ndarray, real: np.ndarray, tape, d_out: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the weights and of ``x``."""
    tape_f, tape_b, s, u, w, pooled = tape
    g = {"v": pooled.T @ d_out, "c": d_out.sum(keepdims=True)}
    d_pooled = d_out[:, None] * p["v"]
    d_s = w[:, :, None] * d_pooled
    d_w = np.einsum("nh,tnh->tn", d_pooled, s)
    d_e = w * (d_w - (w * d_w).sum(axis=0))
    d_u = d_e[:, :, None] * p["a"] * (1 - u * u)
    g["a"] = np.einsum("tn,tnh->h", d_e, u)
    g["A"] = np.einsum("tns,tnh->sh", s, d_u)
    d_s += d_u @ p["A"].T
    d_x = np.zeros_like(x)
    for side, tapes, d_states, idx, on in (("f", tape_f, d_s[:, :, :HIDDEN], index, real), ("b", tape_b, d_s[::-1, :, HIDDEN:], index[::-1], real[::-1])):
        U, dU = p[f"U{side}"], np.zeros_like(p[f"U{side}"])
        d_h, d_gates = np.zeros_like(d_states[0]), np.zeros((len(x), 3 * HIDDEN), np.float32)
        for t in range(len(idx) - 1, -1, -1):
            h, z, r, new = tapes[t]
            d_h = d_h + d_states[t]
            d_new = d_h * z * (1 - new * new)
            d_z = d_h * (new - h) * z * (1 - z) * on[t][:, None]
            d_rh = d_new @ U[:, 2 * HIDDEN :].T
            d_r = d_rh * h * r * (1 - r)
            gates = np.concatenate([d_z, d_r, d_new], axis=1)
            dU[:, : 2 * HIDDEN] += h.T @ gates[:, : 2 * HIDDEN]
            dU[:, 2 * HIDDEN :] += (r * h).T @ d_new
            np.add.at(d_gates, idx[t], gates)
            d_h = d_h * (1 - z) + d_rh * r + gates[:, : 2 * HIDDEN] @ U[:, : 2 * HIDDEN].T
        g[f"U{side}"], g[f"W{side}"], g[f"b{side}"] = dU, x.T @ d_gates, d_gates.sum(axis=0)
        d_x += d_gates @ p[f"W{side}"].T
    return g, d_x


def window_index(words: Words, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    step = np.arange(WINDOW)[:, None]
    real = step < count
    at = np.minimum(start + step, max(0, len(words.word) - 1))
    blank = len(words.bucket)
    return np.where(real, words.word[at] if len(words.word) else blank, blank).astype(np.int32), real


def document_inputs(logit: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Of each text: its three worst windows, their mean score, its length."""
    order = np.lexsort((-logit, text))
    logit, text = np.clip(logit[order], -9, 9), text[order]
    nth = np.arange(len(text)) - np.searchsorted(text, text)
    out = np.full((n, 6), -9.0)
    for k in range(3):
        out[text[nth == k], k] = logit[nth == k]
    count = np.bincount(text, minlength=n)
    out[:, 3] = 9 * np.bincount(text, sigmoid(logit), minlength=n) / count
    out[:, 4] = np.log(count)
    out[:, 5] = 1
    return out


def window_logits(p: dict[str, np.ndarray], x: np.ndarray, index: np.ndarray, real: np.ndarray) -> np.ndarray:
    return np.concatenate([forward(p, x, index[:, a : a + 4096], real[:, a : a + 4096])[0] for a in range(0, index.shape[1], 4096)])


def text_scores(p: dict[str, np.ndarray], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The score of each text, from the logits of all its windows."""
    if len(offsets) < 2:
        return np.zeros(0)
    words = Words(data, offsets)
    text, start, count = windows(words.first)
    logit = window_logits(p, inputs(p, words), *window_index(words, start, count))
    return sigmoid(document_inputs(logit, text, len(offsets) - 1) @ p["document"])


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: float) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w, each = np.zeros(x.shape[1]), np.where(y > 0, weight, 1.0)
    for _ in range(25):
        s = sigmoid(x @ w)
        curve = (x * (each * s * (1 - s))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w - np.linalg.solve(curve, x.T @ (each * (s - y)) + 0.1 * w)
    return w


class AllWords(Words):
    """The words of many texts, found a slice at a time and kept as small numbers.

    A word that occurs in two slices is kept twice, which changes nothing.
    """

    def __init__(self, texts: list[str]):
        parts, held, size = [], [], 0
        for k, t in enumerate(texts):
            held.append(t)
            size += len(t or "")
            if size >= TRAIN_SLICE or k == len(texts) - 1:
                parts.append(Words(*buffer_of(held)))
                held, size = [], 0
        join = lambda name: np.concatenate([getattr(w, name) for w in parts]).astype(np.int32)
        self.bucket, self.pieces, self.piece, self.head = join("bucket"), join("pieces"), join("piece"), join("head")
        self.piece_at = np.cumsum(self.pieces) - self.pieces
        shift = np.cumsum([0, *(len(w.bucket) for w in parts)])
        self.word = np.concatenate([w.word + a for w, a in zip(parts, shift, strict=False)]).astype(np.int32)
        self.first = np.cumsum([0, *(n for w in parts for n in np.diff(w.first))])

    def some(self, part: np.ndarray) -> Words:
        """Only the words of these numbers, in this order."""
        few = object.__new__(Words)
        few.bucket, few.head, few.pieces = self.bucket[part], self.head[part], self.pieces[part]
        few.piece_at = np.cumsum(few.pieces) - few.pieces
        few.piece = self.piece[np.repeat(self.piece_at[part] - few.piece_at, few.pieces) + np.arange(int(few.pieces.sum()))]
        return few


def seen_in(words: AllWords, toxic: np.ndarray, fold: np.ndarray) -> dict[str, np.ndarray]:
    """Documents that hold each bucket, by fold and label."""
    seen = {k: np.zeros((FOLDS, 2, n), np.int32) for k, n in (("word_odds", WORD_BUCKETS), ("piece_odds", PIECE_BUCKETS), ("head_odds", PIECE_BUCKETS))}
    for i, (label, k) in enumerate(zip(toxic, fold, strict=True)):
        own = words.some(np.unique(words.word[words.first[i] : words.first[i + 1]]))
        for name, buckets in (("word_odds", own.bucket), ("piece_odds", own.piece), ("head_odds", own.head)):
            seen[name][k, label, np.unique(buckets)] += 1
    return seen


def odds(seen: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Smoothed log-odds of each bucket's presence in toxic documents."""
    n = np.maximum(n, 1)[:, None]
    # In proportion to the classes, so a bucket that nothing is known of has 0.
    prior = SMOOTH * 2 * n / n.sum()
    share = (seen + prior) / (n + 2 * prior)
    return np.log(share[1] / share[0]).astype(np.float32)


def buffer_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return text_buffer(pa.array([t or "" for t in texts], pa.string()))


def train(texts: list[str], toxic: np.ndarray, seed: int = 7) -> dict[str, np.ndarray] | None:
    """The weights, from whole texts and their 0/1 labels."""
    if len(set(toxic.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    toxic = np.asarray(toxic, int)
    fold = rng.permutation(len(texts)) % FOLDS
    words = AllWords(texts)
    size = np.stack([np.bincount(toxic[fold == k], minlength=2) for k in range(FOLDS)])
    # What a document of fold k learns with comes from the other folds.
    tables = {name: [odds(seen.sum(axis=0) - seen[k], size.sum(axis=0) - size[k]) for k in range(FOLDS)] + [odds(seen.sum(axis=0), size.sum(axis=0))] for name, seen in seen_in(words, toxic, fold).items()}
    p = initial(rng, [t[FOLDS] for t in tables.values()])
    of_fold = [{name: t[k] for name, t in tables.items()} for k in range(FOLDS)]
    y = toxic.astype(np.float32)
    text, start, count = windows(words.first)
    bounds = np.searchsorted(text, np.arange(len(y) + 1))
    strength = np.append(np.maximum(p["word_odds"][words.bucket], p["head_odds"][words.head].max(axis=1, initial=-9)), 0).astype(np.float32)
    index, real = window_index(words, start, count)
    guess = strength[index].max(axis=0)
    moments: dict[str, list] = {}
    step = 0
    weight = min(5.0, max(1.0, (2 * (y == 0).sum()) / (y == 1).sum()))
    batches = -(-(len(y) + int((y == 0).sum())) // BATCH)
    for _ in range(max(EPOCHS, -(-STEPS // batches))):
        # The worst window of each document, and any other of the clean ones.
        worst = np.array([a + int(np.argmax(guess[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
        other = rng.integers(bounds[:-1], bounds[1:])[y == 0]
        chosen, target = np.r_[worst, other], np.r_[y, np.zeros(len(other), np.float32)]
        order = rng.permutation(len(chosen))
        folds = [order[fold[text[chosen[order]]] == k] for k in range(FOLDS)]
        for k, i in [(k, f[a : a + BATCH]) for a in range(0, max(map(len, folds)), BATCH) for k, f in enumerate(folds) if a < len(f)]:
            seen_p = p | of_fold[k]
            part, back = np.unique(index[:, chosen[i]], return_inverse=True)
            back = back.reshape(WINDOW, -1)
            x_all = sub_inputs(seen_p, words, part)
            logit, tape = forward(p, x_all, back, real[:, chosen[i]], keep=True)
            d_logit = (sigmoid(logit) - target[i]) * np.where(target[i] > 0, weight, 1) / len(i)
            g, d_x = backward(p, x_all, back, real[:, chosen[i]], tape, d_logit.astype(np.float32))
            step += 1
            for name, d in g.items():
                m = moments.setdefault(name, [np.zeros_like(d), np.zeros_like(d)])
                m[0] = 0.9 * m[0] + 0.1 * d
                m[1] = 0.99 * m[1] + 0.01 * d * d
                p[name] = (p[name] - RATE * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
            teach_embeddings(p, words, part, d_x)
        guess = known_logits(p, words, index, real)
    # The document's unit learns from windows seen with the other folds' odds.
    logit = np.empty(len(text))
    for k in range(FOLDS):
        i = np.flatnonzero(fold[text] == k)
        logit[i] = known_logits(p | of_fold[k], words, index[:, i], real[:, i])
    p["document"] = fit_logistic(document_inputs(logit, text, len(y)), y, 1.0)
    return p


def known_logits(p: dict[str, np.ndarray], words: AllWords, index: np.ndarray, real: np.ndarray) -> np.ndarray:
    out = []
    for a in range(0, index.shape[1], 2048):
        part, back = np.unique(index[:, a : a + 2048], return_inverse=True)
        out.append(forward(p, sub_inputs(p, words, part), back.reshape(WINDOW, -1), real[:, a : a + 2048])[0])
    return np.concatenate(out)


def sub_inputs(p: dict[str, np.ndarray], words: AllWords, part: np.ndarray) -> np.ndarray:
    """``inputs`` of a few words; the number after the last word is no word."""
    real = part[part < len(words.bucket)]
    x = inputs(p, words.some(real))
    return x if len(real) < len(part) else x[:-1]


def teach_embeddings(p: dict[str, np.ndarray], words: AllWords, part: np.ndarray, d_x: np.ndarray) -> None:
    few = words.some(part[part < len(words.bucket)])
    d = d_x[: len(few.bucket)]
    np.add.at(p["word_in"], few.bucket, -RATE * d[:, ODDS : ODDS + EMBEDDED])
    np.add.at(p["piece_in"], few.piece, np.repeat(-RATE * d[:, ODDS + EMBEDDED :] / few.pieces[:, None], few.pieces, axis=0))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """Texts and labels of the sample, in the order of their ids."""
    known = clean_columns(labels, "doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = [known.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in enumerate(TRAIN_DOCS)]
    # At most sum(TRAIN_DOCS) ids.
    rows = clean_columns(docs, "doc_id", "text").join(F.broadcast(some[0].unionByName(some[1])), "doc_id").select("doc_id", "text", "toxic").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return rows.column("text").to_pylist(), rows.column("toxic").to_numpy().astype(int)


def scorer(docs: DataFrame, labels: DataFrame):
    """A function for ``mapInArrow`` helpers: text column to scores."""
    p = train(*training_rows(docs, labels))
    shared = docs.sparkSession.sparkContext.broadcast(p)

    def score(text: pa.Array) -> np.ndarray:
        p = shared.value
        return np.full(len(text), 0.5) if p is None else text_scores(p, *text_buffer(text))

    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    score = scorer(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield pa.record_batch([part.column("doc_id"), pa.array(score(part.column("text")))], names=["doc_id", "score"])

    docs = clean_columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    scored = docs.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, that score below the threshold."""
    score = scorer(docs, labels)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield part.filter(pa.array(score(part.column("text")) < THRESHOLD))

    at = names.index("text")
    inner = docs.toDF(*(f"c{i}" if i != at else "text" for i in range(len(names))))
    return inner.mapInArrow(run, inner.schema).toDF(*names)
