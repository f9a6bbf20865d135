"""Toxicity: averaged bags of subword embeddings with a linear softmax, trained jointly by gradient descent in numpy."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.functions import quoted
from classweave.llm import textbytes as tb
from classweave.llm.frames import free_name, map_batches

#: Bound of the labelled sample: at most so many documents of each label, and of each a passage of so many characters.
SAMPLE_PER_LABEL, PASSAGE_CHARS = 2500, 2500
#: Sizes of the character n-grams of a word (with a mark before and behind it), hashed slots, dimensions of an embedding.
GRAMS, SLOTS, DIMENSIONS = (3, 4, 5), 1 << 17, 8
EPOCHS, BATCH, RATE = 10, 32, 0.1
#: How much shorter an embedding gets at each step that uses it: those that no label needs stay at zero.
SHRINK = 0.05
#: Every so many-th document of the sample calibrates the scores and trains nothing.
CALIBRATE_EVERY = 8
MARK = 32


@dataclass
class Words:
    """Distinct words of some texts, and how often each text has each of them."""

    slots: np.ndarray  # hashed subwords of all distinct words, one word behind the other
    first: np.ndarray  # where each word's subwords begin, one more at the end
    text: np.ndarray  # entries: the text, the distinct word, how often
    word: np.ndarray
    count: np.ndarray
    n_words: np.ndarray  # words of each text


def _subwords(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots, first): the word itself and its n-grams, for words that lie one behind the other in `data`.

    The n-grams of one size and the whole words have ranges of slots of their own. A word of n bytes and its two marks
    has n + 3 - size n-grams of a size, so even a word of one byte has one of size 3.
    """
    n = len(lengths)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
    marked = np.full(len(data) + 2 * n, MARK, dtype=np.uint8)
    begin = np.cumsum(lengths + 2) - (lengths + 2)
    marked[np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, lengths)] = data
    whole = tb.span_hash(tb.prefix_hash(tb.byte_codes(marked)), begin, begin + lengths + 2) >> np.uint64(32)
    codes, owners = [(whole % np.uint64(SLOTS)).astype(np.int64)], [np.arange(n)]
    for k, size in enumerate(GRAMS, 1):
        count = np.maximum(lengths + 3 - size, 0)
        owner = np.repeat(np.arange(n), count)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + begin[owner]
        code = np.zeros(len(at), dtype=np.uint64)
        for j in range(size):
            code = code << np.uint64(8) | marked[at + j].astype(np.uint64)
        codes.append((tb.mix(code) % np.uint64(SLOTS)).astype(np.int64) + k * SLOTS)
        owners.append(owner)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(codes)[order], np.searchsorted(owner[order], np.arange(n + 1))


def read_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words (letters, digits and all characters beyond ASCII, A-Z lower-cased) of texts in one array of bytes."""
    starts, ends, first_word = tb.word_spans(data, offsets)
    lengths = ends - starts
    inside = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
    flat = tb.LOWER[data[inside]]
    ends32 = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    spelled = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends32.tobytes()), pa.py_buffer(flat.tobytes())])
    coded = spelled.dictionary_encode()
    distinct = coded.dictionary
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(np.frombuffer(distinct.buffers()[1], dtype=np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]) if len(distinct) else np.zeros(0, dtype=np.int64)
    letters = np.frombuffer(distinct.buffers()[2] or b"", dtype=np.uint8)[: int(sizes.sum())]
    slots, first = _subwords(letters, sizes)
    n_words = np.diff(first_word)
    text = np.repeat(np.arange(len(n_words)), n_words)
    pair, count = np.unique(text * max(len(distinct), 1) + code, return_counts=True)
    return Words(slots, first, pair // max(len(distinct), 1), pair % max(len(distinct), 1), count, n_words)


@dataclass
class Model:
    """The embedding of each subword times the output layer, as one logit for label 1; the calibrated scale and shift."""

    weights: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def logits(self, words: Words) -> np.ndarray:
        """The calibrated logit of every text: of its words' averages, the average. A text without words has the shift alone."""
        sizes = np.maximum(np.diff(words.first), 1)
        per_word = np.add.reduceat(self.weights[words.slots], words.first[:-1]) / sizes if len(words.slots) else np.zeros(0)
        sums = np.bincount(words.text, weights=per_word[words.word] * words.count, minlength=len(words.n_words))
        return self.scale * sums / np.maximum(words.n_words, 1) + self.shift


def _as_bytes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    encoded = [t.encode() for t in texts]
    return np.frombuffer(b"".join(encoded), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(e) for e in encoded])]).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: Sequence[str], labels: Sequence[int], share: float | None = None, seed: int = 11) -> Model:
    """Fit embeddings and softmax together on texts labelled 0 or 1.

    `share` is the share of label 1 among all labelled documents, which the scores are calibrated for; by default that of
    the given ones. Without both labels every score is that share, or 0 where nothing is known.
    """
    y = np.asarray(labels, dtype=np.int64)
    share = float(y.mean()) if share is None and len(y) else float(share or 0.0)
    bounded = min(max(share, 1e-6), 1 - 1e-6)
    prior = float(np.log(bounded / (1 - bounded)))
    if len(np.unique(y)) < 2:
        return Model(np.zeros((len(GRAMS) + 1) * SLOTS), 0.0, prior)
    rng = np.random.default_rng(seed)
    held = np.arange(len(y)) % CALIBRATE_EVERY == CALIBRATE_EVERY - 1 if len(y) >= 10 * CALIBRATE_EVERY else np.zeros(len(y), dtype=bool)
    bags = [read_words(*_as_bytes([t])) for t in texts]
    # The output layer starts at random, so that the embeddings can start at nothing: unseen subwords then say nothing.
    embed = np.zeros(((len(GRAMS) + 1) * SLOTS, DIMENSIONS), dtype=np.float32)
    out, bias = rng.normal(0, 1, (DIMENSIONS, 2)), np.zeros(2)
    seen = np.full(len(embed), 1e-8)
    fit = np.flatnonzero(~held)
    steps, step = EPOCHS * -(-len(fit) // BATCH), 0
    # A sum over few words among many moves little: the averages are spread out before the output layer.
    spread = float(np.median([max(b.n_words[0], 1) for b in bags])) ** 0.5
    for _ in range(EPOCHS):
        order = rng.permutation(fit)
        for k in range(0, len(order), BATCH):
            rows = order[k : k + BATCH]
            flat, owner, part = _entries([bags[i] for i in rows])
            used, place = np.unique(flat, return_inverse=True)
            shares = np.bincount(owner * len(used) + place, weights=part, minlength=len(rows) * len(used)).reshape(len(rows), -1) * spread
            hidden = shares @ embed[used]
            error = _softmax(hidden @ out + bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            rate = RATE * (1 - step / steps)
            toward = shares.T @ (error @ out.T)
            seen[used] += (toward**2).mean(axis=1)
            moved = embed[used] - rate * toward / np.sqrt(seen[used])[:, None]
            length = np.maximum(np.sqrt((moved**2).sum(axis=1)), 1e-9)
            embed[used] = moved * np.maximum(0, 1 - rate * SHRINK / length)[:, None]
            out -= rate * 0.1 * hidden.T @ error
            bias -= rate * 0.1 * error.sum(axis=0)
            step += 1
    raw = Model((embed @ (out[:, 1] - out[:, 0])).astype(np.float64) * spread, 1.0, float(bias[1] - bias[0]))
    checked = np.flatnonzero(held) if held.any() else fit
    return _calibrated(raw, [bags[i] for i in checked], y[checked], bounded)


def _entries(bags: Sequence[Words]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot, text, part): the subwords of some texts; a word's part of its text is dealt to its subwords evenly."""
    flat, owner, part = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0)]
    for i, bag in enumerate(bags):
        sizes = np.diff(bag.first)
        flat.append(bag.slots)
        owner.append(np.full(len(bag.slots), i))
        part.append(np.repeat(bag.count / bag.n_words[0] / sizes, sizes))
    return np.concatenate(flat), np.concatenate(owner), np.concatenate(part)


def _calibrated(model: Model, bags: Sequence[Words], y: np.ndarray, share: float) -> Model:
    """Scale and shift of the logits by logistic regression (Newton's method), each label weighted to its share of the corpus."""
    x = np.array([model.logits(b)[0] for b in bags])
    scale = x.std() or 1.0
    design = np.stack([x / scale, np.ones(len(x))], 1)
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    beta = np.array([0.0, 0.0])
    for _ in range(50):
        p = _sigmoid(design @ beta)
        slope = design.T @ (weight * (y - p)) - 1e-3 * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        change = np.linalg.solve(curve, slope)
        beta = beta + np.clip(change, -2, 2)
        if np.abs(change).max() < 1e-9:
            break
    return Model(model.weights, float(beta[0] / scale), float(beta[1] + beta[0] / scale * model.shift))


def held_out(id_col: str = "doc_id") -> Column:
    """Documents whose labels are kept from training: the crc32 of the id as text is a multiple of 5; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(quoted(id_col)).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, may_learn: Column, per_label: int = SAMPLE_PER_LABEL, chars: int = PASSAGE_CHARS
) -> tuple[list[tuple[str, int]], float | None]:
    """([(passage, label)], share of label 1): at most `per_label` documents of each label, and of each one passage.

    Label rows are picked by a hash of their id, as many as the bound needs, and only those meet the documents, by
    broadcast: the share counts all label rows that may be learnt from. Rows with a null id, label or text teach nothing.
    The bound holds whatever ids repeat: among rows that share an id, a hash of the text decides.
    """
    known = labels.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & may_learn)
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not counts:
        return [], None
    pick = F.xxhash64(F.col("id").cast("string"), F.lit(per_label))
    sample = []
    for label in sorted(counts):
        # TakeOrdered: no task and no driver holds more than the bound.
        chosen = known.where(F.col("label") == label).orderBy(pick, "id").limit(per_label).distinct()
        texts = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text")).where(F.col("text").isNotNull())
        start = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.length("text") - chars + 1, F.lit(1))).cast("int") + 1
        passage = F.substring(F.col("text"), start, F.lit(chars))
        met = texts.join(F.broadcast(chosen), "id").select(F.xxhash64("id", "text").alias("k"), passage.alias("t"))
        sample += [(r["k"], r["t"], label) for r in met.orderBy("k", "t").limit(per_label).collect()]
    return [(t, label) for _, t, label in sorted(sample)], counts.get(1, 0) / sum(counts.values())


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", may_learn: Column | None = None, **bounds) -> Model:
    """Learn `label_col` of `labels` (0 or 1) from the texts of `docs`; `may_learn` is a condition on a column called id."""
    sample, share = labelled_sample(docs, labels, id_col, text_col, label_col, F.lit(True) if may_learn is None else may_learn, **bounds)
    return train([t for t, _ in sample], [label for _, label in sample], share)


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """All columns of `docs` (or those in `keep`), and behind them score and predicted (underscores appended where taken).

    The whole text is read and nothing else: the score is the calibrated probability of label 1, `predicted` 1 from 0.5
    on. A text that is null, empty or without words gets the score of no evidence. Rows neither move nor meet, so equal
    texts have equal scores.
    """
    names = [free_name(docs.columns, n) for n in ("score", "predicted")]
    fields = [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())]
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        score = np.zeros(batch.num_rows)
        for first, end, data, offsets in tb.text_runs(batch.column(at)):
            score[first:end] = _sigmoid(shared.value.logits(read_words(data, offsets)))
        return dict(zip(names, [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]))

    return map_batches(docs, judge, fields, keep)
