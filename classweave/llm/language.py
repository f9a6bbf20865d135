"""Language identification: averaged embeddings of hashed subwords with a linear softmax, trained by gradient descent."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.llm import textbytes as tb
from classweave.llm.frames import columns, free_name, map_batches

#: Bound of the labelled sample: about so many documents of each language, and of each a passage of so many characters.
SAMPLE_PER_LANGUAGE, PASSAGE_CHARS = 1500, 600
GRAMS, SLOTS, DIMENSIONS = (2, 3, 4), 1 << 16, 16
EPOCHS, BATCH, RATE = 6, 32, 30.0
#: Share of rightly recognised calibration passages that may be rejected, and the highest score that is ever rejected.
REJECTED_SHARE, REJECTED_BELOW = 0.001, 0.5
UNDETERMINED = "und"

# Bytes of letters keep their value in lower case; whatever parts words becomes a space.
_CLEAN = np.where(tb.IS_WORD & ~((tb._BYTE >= 48) & (tb._BYTE <= 57)), tb.LOWER, 32).astype(np.uint8)


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot, text) of all subwords: 2 to 4 bytes of a word, or with the space before or behind it."""
    n = len(data)
    clean = np.full(n + len(offsets), 32, dtype=np.uint8)  # a space before every text and at the end
    at = np.arange(n) + np.repeat(np.arange(1, len(offsets)), np.diff(offsets))
    clean[at] = _CLEAN[data]
    starts = offsets + np.arange(len(offsets))
    letter = clean != 32
    slots, texts = [], []
    for k, size in enumerate(GRAMS):
        count = len(clean) - size + 1
        if count <= 0:
            continue
        inner = np.ones(count, dtype=bool)
        for j in range(1, size - 1):
            inner &= letter[j : j + count]
        where = np.flatnonzero(inner & (letter[:count] | letter[size - 1 :][:count]))
        code = np.zeros(len(where), dtype=np.uint64)
        for j in range(size):
            code = code << np.uint64(8) | clean[where + j].astype(np.uint64)
        slot = code if size == 2 else tb.mix(code) >> np.uint64(48)
        slots.append(slot.astype(np.int64) + k * SLOTS)
        texts.append(np.searchsorted(starts, where, side="right") - 1)
    if not slots:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(slots), np.concatenate(texts)


@dataclass
class Model:
    """Weights of each subword towards each language (its embedding times the output layer), bias, scale and threshold."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits of every text, and how many subwords it has."""
        slots, texts = subwords(data, offsets)
        n = len(offsets) - 1
        count = np.bincount(texts, minlength=n)[:n]
        sums = np.stack([np.bincount(texts, weights=w[slots], minlength=n)[:n] for w in self.weights.T], 1) if len(slots) else np.zeros((n, len(self.languages)))
        return sums / np.maximum(count, 1)[:, None] + self.bias, count


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _as_bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    encoded = [t.encode() for t in texts]
    return np.frombuffer(b"".join(encoded), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(e) for e in encoded])]).astype(np.int64)


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model:
    """Fit on passages: nine in ten train the weights, one in ten the temperature and the rejection threshold."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((len(GRAMS) * SLOTS, 0)), np.zeros(0))
    y = np.searchsorted(languages, labels)
    rng = np.random.default_rng(seed)
    held = np.arange(len(texts)) % 10 == 9 if len(texts) >= 50 else np.zeros(len(texts), dtype=bool)
    embed = rng.uniform(-1, 1, (len(GRAMS) * SLOTS, DIMENSIONS)) / DIMENSIONS
    out, bias = rng.uniform(-1, 1, (DIMENSIONS, len(languages))) / DIMENSIONS, np.zeros(len(languages))
    fit = np.flatnonzero(~held)
    steps = EPOCHS * -(-len(fit) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(fit)
        for k in range(0, len(order), BATCH):
            rows = order[k : k + BATCH]
            slots, owner = subwords(*_as_bytes([texts[i] for i in rows]))
            used, place = np.unique(slots, return_inverse=True)
            counts = np.bincount(owner * len(used) + place, minlength=len(rows) * len(used)).reshape(len(rows), -1)
            share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
            hidden = share @ embed[used]
            error = _softmax(hidden @ out + bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            rate = RATE * (1 - step / steps) / len(rows)
            back = error @ out.T
            out -= rate * 0.1 * hidden.T @ error
            bias -= rate * 0.01 * error.sum(axis=0)
            embed[used] -= rate * share.T @ back
            step += 1
    model = Model(languages, (embed @ out).astype(np.float32), bias)
    return _calibrated(model, [texts[i] for i in np.flatnonzero(held)], y[held], rng)


def _calibrated(model: Model, texts: list[str], y: np.ndarray, rng: np.random.Generator) -> Model:
    """The temperature that makes held-out scores most likely, and the score below which hardly a right answer lies."""
    if not len(texts):
        return model
    cut = [t[: int(rng.integers(20, max(21, len(t) + 1)))] for t in texts]
    logits, _ = model.logits(*_as_bytes(cut))

    def loss(temperature: float) -> float:
        return -np.log(np.maximum(_softmax(logits / temperature)[np.arange(len(y)), y], 1e-12)).mean()

    model.temperature = float(min(np.geomspace(0.05, 20, 121), key=loss))
    scores = _softmax(logits / model.temperature)
    right = scores.max(axis=1)[scores.argmax(axis=1) == y]
    if len(right):
        model.threshold = float(min(REJECTED_BELOW, np.quantile(right, REJECTED_SHARE)))
    return model


def labelled_sample(docs: DataFrame, id_col: str, text_col: str, label_col: str, may_learn: Column, per_language: int = SAMPLE_PER_LANGUAGE, chars: int = PASSAGE_CHARS) -> list[tuple[str, str]]:
    """(passage, label): about `per_language` documents of each label, picked by a hash, and of each one passage, placed by the hash.

    The hash is that of id and text, so neither a null nor a repeated id brings many rows together; rows that are equal in
    both count once. At most 1.1 times the bound of each label comes to the driver.
    """
    known = docs.where(may_learn & F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(label_col).count().collect()}
    if not counts:
        return []
    key = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    pick = F.pmod(key, F.lit(1 << 30))
    bound = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, int(min(1.0, per_language / n) * (1 << 30)))])
    start = F.pmod(F.xxhash64(F.col(text_col), F.lit(1)), F.greatest(F.length(text_col) - chars + 1, F.lit(1)))
    passage = F.substring(F.col(text_col), start.cast("int") + 1, F.lit(chars))
    rows = known.where(pick <= bound[F.col(label_col)]).select(key.alias("k"), passage.alias("t"), F.col(label_col).alias("l"))
    # Equal rows are merged in their tasks first, so the window sees about the bound for each label.
    distinct = rows.groupBy("l", "k").agg(F.min("t").alias("t"))
    place = F.row_number().over(Window.partitionBy("l").orderBy("k"))
    kept = distinct.withColumn("place", place).where(F.col("place") <= per_language + per_language // 10)
    return [(r["t"], r["l"]) for r in sorted(kept.select("k", "t", "l").collect())]


def fit_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", may_learn: Column | None = None, **bounds) -> Model:
    """Learn the labels of `label_col` from the text of documents for which `may_learn` is true."""
    sample = labelled_sample(docs, id_col, text_col, label_col, F.lit(True) if may_learn is None else may_learn, **bounds)
    return train([t for t, _ in sample], [label for _, label in sample])


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of `docs`, and behind them lang_pred, score and rejected (underscores appended where a name is taken).

    The whole text is read and nothing else. A text that is null or has no letter is `und` with score 0 and rejected; so
    is every text if the model knows no language. Any other text gets the likeliest language and its calibrated
    probability, and is rejected if that is below the model's threshold. Rows neither move nor meet.
    """
    names = [free_name(docs.columns, n) for n in ("lang_pred", "score", "rejected")]
    fields = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.BooleanType())]
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        model = shared.value
        column = pc.fill_null(batch.column(at), "")
        known = np.array(pc.match_substring_regex(column, r"\p{L}"), dtype=bool) & bool(model.languages)
        best = np.zeros(len(column), dtype=np.int64)
        score = np.zeros(len(column))
        if model.languages:
            for first, end, data, offsets in tb.text_runs(column, 1 << 20):
                p = _softmax(model.logits(data, offsets)[0] / model.temperature)
                best[first:end], score[first:end] = p.argmax(axis=1), p.max(axis=1)
        labels = np.array([*model.languages, UNDETERMINED], dtype=object)[np.where(known, best, len(model.languages))]
        score = np.where(known, score, 0.0)
        return dict(zip(names, [pa.array(labels, pa.string()), pa.array(score), pa.array(~known | (score < model.threshold))]))

    return map_batches(docs, predict, fields)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` without the rejected documents."""
    judged = identify(docs, model, text_col)
    return judged.where(~F.col(judged.columns[-1])).select(*columns(docs.columns))


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that are kept from training: the remainder 2 of four of the crc32 of the id as text; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
