"""Operator 3: toxicity, by a convolutional text classifier trained in numpy.

A word's embedding is the sum of hashed embeddings of the whole word and of its
first 3 to 6 bytes (A-Z lowered, ASCII punctuation left out), so an unseen inflection of a
known stem is recognised.  Filters of widths 1, 2 and 3 run over the whole
text, each keeps its maximum over all positions, and a logistic unit gives the score.

The classifier is fitted on a bounded sample of labelled rows; every
text is then scored whole, inside tasks.  Thresholds per language are calibrated on all
labelled rows that the fit did not use, and decide in ``without_toxic``; language is never an input of the score.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm.common import table, text_or_empty
from barforge.llm.words import Hasher, find_words, salt, text_groups

_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Bytes of the prefixes of a word that have embeddings of their own.
PREFIXES = (3, 4, 5, 6)
#: Bins of the scores' histograms; a power of two, so that a bin's edge is exact.
SCORE_BINS = 4096
#: Rows of either label from which a language has a threshold of its own.
LEAST_LABELS = 20


@dataclass
class Settings:
    """``sample_rows`` of each label (at most ``sample_bytes`` long each) bound
    the fit; every row is scored, and whole texts."""
    sample_rows: int = 3000
    sample_bytes: int = 16_384
    table_bits: int = 17
    size: int = 8
    filters: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    epochs: int = 6
    batch: int = 32
    least_texts: int = 3
    rate: float = 0.03
    threshold: float = 0.7
    precision: float = 0.95


@dataclass
class Model:
    settings: Settings
    embed: np.ndarray
    weights: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    #: Language -> score from which its texts are called toxic.
    thresholds: dict[str | None, float] = field(default_factory=dict)


def _parts(model: Model) -> dict:
    """The model as plain arrays, as broadcasts need no class of this package."""
    return {**vars(model), "settings": vars(model.settings)}


def _model(parts: dict) -> Model:
    return Model(**{**parts, "settings": Settings(**parts["settings"])})


_HASH = Hasher(41, fold_case=True, skip=_PUNCTUATION)


def features(data: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(words x features) slots of the embedding table, and each text's first word."""
    starts, ends, first = find_words(data, at)
    shift = np.uint64(64 - bits)
    out = np.empty((len(starts), 1 + len(PREFIXES)), np.int32)
    out[:, 0] = _HASH(data, starts, ends) >> shift
    own = salt(len(PREFIXES), 43)
    for j, n in enumerate(PREFIXES):
        out[:, j + 1] = (_HASH(data, starts, np.minimum(ends, starts + n)) ^ own[j]) * np.uint64(0x9E3779B97F4A7C15) >> shift
    return out, first


def _pooled(model: Model, slots: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Maxima of all filters by text, the values they are taken from, and the embedded words.
    Texts are padded at their ends, so a short one has a window too; the
    windows that begin so late in the padding that they would reach into the next text don't count."""
    s, texts = model.settings, len(first) - 1
    pad = max(s.widths)
    length = np.diff(first)
    row = np.arange(len(slots)) + pad * np.repeat(np.arange(texts), length)
    words = np.zeros((len(slots) + pad * texts, s.size), model.embed.dtype)
    for j in range(slots.shape[1]):
        words[row] += model.embed[slots[:, j]]
    begin = first[:-1] + pad * np.arange(texts)
    maxima, where = [], []
    for w, weight in zip(s.widths, model.weights):
        n = len(words) - w + 1
        conv = words[:n] @ weight[0]
        for j in range(1, w):
            conv += words[j:j + n] @ weight[j]
        for j in range(1, w):
            conv[begin[1:] - j] = -np.inf
        maxima.append(np.maximum.reduceat(conv, begin, axis=0))
        where.append(conv)
    return np.concatenate(maxima, 1) + model.bias, where, words


def _score(model: Model, pooled: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.maximum(pooled, 0) @ model.out + model.out_bias, -30, 30)))


def score_texts(model: Model, column: pa.Array) -> np.ndarray:
    out = []
    for _, _, data, at in text_groups(column):
        for lo, hi in _word_slices(data, at):
            slots, first = features(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo], model.settings.table_bits)
            out.append(_score(model, _pooled(model, slots, first)[0]))
    return np.concatenate(out) if out else np.zeros(0)


def _word_slices(data: np.ndarray, at: np.ndarray, limit: int = 1 << 17):
    """Rows of about ``limit`` bytes: the arrays stay in the processor's cache."""
    lo = 0
    while lo < len(at) - 1:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield lo, min(hi, len(at) - 1)
        lo = hi


def fit(texts: list[str], labels: np.ndarray, settings: Settings | None = None) -> Model:
    """Minibatch Adam on the logistic loss; only the positions of the maxima
    carry gradients.  Only embeddings of slots that ``least_texts``
    texts hold are trained, the others are zero: unknown words say nothing, and rare ones can't be
    learnt by heart.  Filters only add to the score, so a long text's other words
    can't outweigh an insult.  Deterministic."""
    s = settings or Settings()
    rng = np.random.default_rng(3)
    f = s.filters * len(s.widths)
    model = Model(s, np.zeros((1 << s.table_bits, s.size), np.float32),
                  [rng.normal(0, 0.5, (w, s.size, s.filters)).astype(np.float32) for w in s.widths],
                  np.zeros(f, np.float32), np.abs(rng.normal(0, 0.3, f)).astype(np.float32), float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))))
    kept = [features(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]), s.table_bits)[0] for t in texts]
    held = np.bincount(np.concatenate([np.unique(k) for k in kept]) if kept else [], minlength=1 << s.table_bits)
    known = held >= s.least_texts
    model.embed[known] = rng.normal(0, 0.01, (int(known.sum()), s.size))
    params = [model.embed, *model.weights, model.bias, model.out]
    first_moment, second_moment, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(s.epochs):
        rate = s.rate * 0.5 ** max(0, epoch - s.epochs // 2)
        for pick in np.array_split(rng.permutation(len(kept)), max(1, len(kept) // s.batch)):
            slots = np.concatenate([kept[i] for i in pick])
            first = np.concatenate([[0], np.cumsum([len(kept[i]) for i in pick])])
            grads, bias_grad = _gradients(model, slots, first, labels[pick], known)
            model.out_bias -= rate * bias_grad
            step += 1
            for p, g, m, v in zip(params, grads, first_moment, second_moment):
                rows = slice(None) if isinstance(g, np.ndarray) else g[0]
                g = g if isinstance(g, np.ndarray) else g[1]
                m[rows] = 0.9 * m[rows] + 0.1 * g
                v[rows] = 0.99 * v[rows] + 0.01 * g * g
                p[rows] -= rate * (m[rows] / (1 - 0.9 ** step)) / (np.sqrt(v[rows] / (1 - 0.99 ** step)) + 1e-6)
            np.maximum(model.out, 0, out=model.out)
    return model


def _gradients(model: Model, slots: np.ndarray, first: np.ndarray, labels: np.ndarray, known: np.ndarray):
    s, texts = model.settings, len(labels)
    pooled, conv, words = _pooled(model, slots, first)
    active = np.maximum(pooled, 0)
    error = ((_score(model, pooled) - labels) / texts).astype(model.embed.dtype)
    back = error[:, None] * model.out * (pooled > 0)
    d_words, pad = np.zeros_like(words), max(s.widths)
    begin = first[:-1] + pad * np.arange(texts)
    stop = np.append(begin[1:], len(words))
    d_weights = []
    for k, (w, weight) in enumerate(zip(s.widths, model.weights)):
        part = slice(k * s.filters, (k + 1) * s.filters)
        at = np.stack([b + conv[k][b:e].argmax(0) for b, e in zip(begin, stop)])
        d = np.empty_like(weight)
        for j in range(w):
            place = np.minimum(at + j, len(words) - 1)
            d[j] = np.einsum("tfc,tf->cf", words[place], back[:, part])
            np.add.at(d_words, place.ravel(), (back[:, part][:, :, None] * weight[j].T[None]).reshape(-1, s.size))
        d_weights.append(d)
    row = np.arange(len(slots)) + pad * np.repeat(np.arange(texts), np.diff(first))
    moved = np.flatnonzero(np.abs(d_words[row]).sum(1))
    touched = slots[moved].ravel()
    learnt = known[touched]
    used, number = np.unique(touched[learnt], return_inverse=True)
    d_embed = np.zeros((len(used), s.size), model.embed.dtype)
    np.add.at(d_embed, number, np.repeat(d_words[row[moved]], slots.shape[1], 0)[learnt])
    return [(used, d_embed), *d_weights, back.sum(0), active.T @ error], float(error.sum())


def held_out(doc_id: str = "doc_id"):
    """Rows that no fit or threshold sees: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """Fits on the sample and calibrates each language's threshold: the least
    score from which the labelled texts that the fit did not use, all and whole, are toxic with the
    precision asked for, not under 0.5; ``settings.threshold`` for languages with few such texts.

    Sampled are about ``sample_rows`` ids of either label by a hash of the id, and of their texts
    those within ``sample_bytes``; null labels, ids and texts are left out.
    Without both labels the model is the base rate.
    """
    s = settings or Settings()
    marked = labels.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(~held_out())
    counts = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    turn, steps = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)), {y: int((1 << 30) * min(1.0, s.sample_rows / n)) for y, n in counts.items()}
    picked = F.lit(False)
    for y, step in steps.items():
        picked = picked | ((F.col("toxic") == y) & (turn < step))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.where(F.octet_length("text").between(1, s.sample_bytes)).select("doc_id", F.struct("text", lang.alias("lang")).alias("own"))
    # The sample bounds the broadcast ids, and with sample_bytes the texts that come to the driver.
    rows = rows.join(F.broadcast(marked.where(picked)), "doc_id").groupBy("doc_id", "toxic").agg(F.min("own").alias("own"))
    got = sorted(rows.select("doc_id", "toxic", "own.text", "own.lang").collect(), key=lambda r: r.doc_id)
    aside = np.array([zlib.crc32(f"{r.doc_id}/aside".encode()) % 5 == 0 for r in got], bool)
    labels_of = np.array([r.toxic for r in got], np.float32)
    fitted = np.flatnonzero(~aside)
    s_fit = s if len(set(labels_of[fitted].tolist())) == 2 else Settings(**{**s.__dict__, "epochs": 0})
    model = fit([got[i].text for i in fitted], labels_of[fitted], s_fit)
    if len(counts) == 2 and min(counts.values()) >= LEAST_LABELS:
        model.thresholds = calibrate(docs.where(F.octet_length("text") >= 1).where(~held_out()), marked, [got[i].doc_id for i in fitted], model)
    return model


def calibrate(docs: DataFrame, marked: DataFrame, fitted: list[int], model: Model) -> dict[str | None, float]:
    """Thresholds from histograms of the scores of the ``marked`` ``docs`` that are not ``fitted``
    (a bounded list of ids), for languages with enough rows of either label."""
    ids = docs.sparkSession.createDataFrame([(i,) for i in fitted], "doc_id long")
    rows = _scored(docs, model).select("doc_id", "lang", F.floor(F.col("score") * SCORE_BINS).cast("int").alias("bin"))
    rows = rows.join(F.broadcast(ids), "doc_id", "left_anti").join(marked, "doc_id")
    bins = rows.groupBy("lang", "bin").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
    held = bins.groupBy("lang").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("bin", "toxic", "n")), False).alias("bins"))
    out = {}
    for r in held.where((F.col("toxic") >= LEAST_LABELS) & (F.col("n") - F.col("toxic") >= LEAST_LABELS)).select("lang", "bins").collect():
        edges, toxic, n = np.array([tuple(b) for b in r.bins]).T
        ends = np.flatnonzero(np.cumsum(toxic) / np.cumsum(n) >= model.settings.precision)
        out[r.lang] = max(0.5, float(edges[ends[-1]]) / SCORE_BINS) if len(ends) else model.settings.threshold
    return out


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and lang_threshold of every row of ``docs``
    (doc_id, text, optionally lang; other columns are not read).  Null and empty texts get the
    score of no words; every row is scored on its own, so repeated rows agree."""
    return _scored(docs, model).drop("lang")


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(_parts(model))  # of the size that Settings fix

    def run(batches):
        own = _model(sent.value)
        for b in batches:
            scores = score_texts(own, b.column("text"))
            limits = [own.thresholds.get(x, own.settings.threshold) for x in b.column("lang").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(scores, pa.float64()), pa.array(limits, pa.float64()), b.column("lang")],
                names=["doc_id", "held_out", "score", "lang_threshold", "lang"])

    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_or_empty().alias("text"),
                       lang.cast("string").alias("lang"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, lang_threshold double, lang string")


def without_toxic(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """A filtering stage: the rows of ``docs`` (all columns) whose score is under their language's threshold."""
    model = train(docs, labels, settings)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(_parts(model))
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    at = docs.columns.index("text")
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")

    def run(batches):
        own = _model(sent.value)
        for b in batches:
            limits = np.array([own.thresholds.get(x, own.settings.threshold) for x in b.column(b.num_columns - 1).to_pylist()], np.float64)
            kept = b.filter(pa.array(score_texts(own, b.column(at)) < limits))
            yield kept.select(range(b.num_columns - 1))

    rows = docs.select("*", lang.alias("__lang")).toDF(*[f"c{i}" for i in range(len(docs.columns) + 1)])
    return rows.mapInArrow(run, schema).toDF(*docs.columns)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score_documents(docs, model)
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= model.settings.threshold, 1).otherwise(0).alias("predicted"),
                         "lang_threshold")
