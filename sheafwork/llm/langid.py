"""Language identification: averaged hashed subword embeddings with a linear softmax.

Every run of 2, 3 and 4 bytes of a lower-cased text that lies inside a word (with the blank before and
after it) is hashed into ``BUCKETS`` subwords. A text is the mean of its subwords' embeddings; a linear
softmax turns that into languages. Both are trained together by stochastic gradient descent in numpy,
on a bounded sample: of the ``LANGUAGES`` commonest languages the ``PER_LANGUAGE`` different texts with the
least hashes. A tenth of the sample is set aside to fit the temperature that makes the softmax a
calibrated probability (a sample of under ``CALIBRATED`` rows has none to spare and keeps temperature 1); a text
is rejected when the probability of its language is under ``LEAST_PROBABILITY``, or when it has no letter.

For prediction, embeddings and softmax fold into one table (subword, language), so that a text costs one
sum. Every text is read whole, where it lies.

Defined results: a null text or one without a letter gets ``und``, score 0 and is rejected; rows without
a language or text teach nothing, nor do languages beyond the commonest (ties by name); repeated texts of a
language teach once; without any language to learn, as in an empty table, every text gets ``und``; of equal
probabilities the first language by name wins; repeated rows get equal answers; an empty table gives an
empty table; extra columns stay (those named like a result are replaced).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frugal import over_batches
from .words import SEPARATOR, slices, text_bytes

PER_LANGUAGE, LANGUAGES = 800, 200
BUCKETS, DIMENSIONS, SIZES = 1 << 15, 16, (2, 3, 4)
EPOCHS, BATCH, RATE, SEED = 8, 16, 20.0, 7
# A small sample is gone through more often, up to as many steps.
LEAST_STEPS = 1500
CALIBRATED = 50
LEAST_PROBABILITY = 0.5
# Bytes of texts worked on at once; a byte begins up to three subwords, each held in several arrays.
SLICE = 1 << 19
UNDETERMINED = "und"
_HASHES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
_JUDGED = ("lang_pred", "score", "rejected")
_JUDGEMENT = "lang_pred string, score double, rejected boolean"


def subwords(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Subword buckets of a batch of texts, and the text each belongs to, in order of texts per size."""
    data, offsets = text_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
    n = len(data)
    if not n:
        return np.empty(0, np.uint16), np.empty(0, np.int32)
    gap = SEPARATOR[data]
    text = np.where(gap, np.uint8(32), data).astype(np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(offsets))
    buckets, owners = [], []
    for size, factor in zip(SIZES, _HASHES):
        m = n - size + 1
        if m <= 0:
            continue
        value, good = np.zeros(m, np.uint32), owner[:m] == owner[size - 1 :]
        for k in range(size):
            value = (value << np.uint32(8)) | text[k : k + m]
            if 0 < k < size - 1:
                good &= ~gap[k : k + m]
        good &= ~(gap[:m] & gap[size - 1 :])
        hashed = (value ^ np.uint32(size)) * np.uint32(factor)
        buckets.append(((hashed ^ (hashed >> np.uint32(15))) >> np.uint32(32 - 15))[good].astype(np.uint16))
        owners.append(owner[:m][good])
    return np.concatenate(buckets), np.concatenate(owners)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class Model:
    """Folded table of log odds per subword and language, and the fitted temperature."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float):
        self.languages, self.table, self.bias, self.temperature = languages, table, bias, temperature

    def logits(self, texts: pa.Array) -> np.ndarray:
        buckets, owners = subwords(texts)
        counts = np.maximum(np.bincount(owners, minlength=len(texts)), 1)
        sums = [np.bincount(owners, self.table[:, k][buckets], minlength=len(texts)) for k in range(len(self.languages))]
        return np.stack(sums, axis=1) / counts[:, None] + self.bias

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        n = len(texts)
        letters = np.fromiter(map(has_letter, texts.to_pylist()), bool, n)
        if not self.languages or not n:
            return [UNDETERMINED] * n, np.zeros(n), np.ones(n, bool)
        p = softmax(self.logits(texts) / self.temperature)
        best = p.argmax(axis=1)
        score = np.where(letters, p[np.arange(n), best], 0.0)
        names = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters)]
        return names, score, ~letters | (score < LEAST_PROBABILITY)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """Stochastic gradient descent over (language, buckets, counts) rows, in the order given by a seed."""
    languages = sorted({s[0] for s in samples})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0)
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(samples))
    apart = len(order) // 10 if len(order) >= CALIBRATED else 0
    held, taught = order[:apart], order[apart:]
    target = np.array([languages.index(s[0]) for s in samples])
    embeddings = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = rng.normal(0, 0.1, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    per_epoch = max(1, -(-len(taught) // BATCH))
    epochs = max(EPOCHS, -(-LEAST_STEPS // per_epoch))
    steps, step = epochs * per_epoch, 0
    for _ in range(epochs):
        rng.shuffle(taught)
        for at in range(0, len(taught), BATCH):
            rate, step = RATE * (1 - step / steps), step + 1
            rows = [samples[i] for i in taught[at : at + BATCH]]
            index = np.concatenate([r[1] for r in rows])
            share = np.concatenate([r[2] / r[2].sum() for r in rows]).astype(np.float32)
            cuts = np.cumsum([0] + [len(r[1]) for r in rows])[:-1]
            mean = np.add.reduceat(embeddings[index] * share[:, None], cuts, axis=0)
            error = softmax(mean @ weights + bias).astype(np.float32)
            error[np.arange(len(rows)), target[taught[at : at + BATCH]]] -= 1
            error /= len(rows)
            back = error @ weights.T
            weights -= 0.05 * rate * (mean.T @ error)
            bias -= 0.01 * rate * error.sum(axis=0)
            owner = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
            np.add.at(embeddings, index, -rate * back[owner] * share[:, None])
    model = Model(languages, embeddings @ weights, bias, 1.0)
    if not apart:
        return model
    model.temperature = temperature(
        np.stack([(model.table[samples[i][1]] * (samples[i][2] / samples[i][2].sum())[:, None]).sum(0) for i in held]) + bias,
        target[held],
    )
    return model


def temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The divisor of the logits under which the held-out languages are most likely."""
    tried = np.geomspace(0.05, 20, 120)
    loss = [-np.log(softmax(logits / t)[np.arange(len(target)), target] + 1e-12).mean() for t in tried]
    return float(tried[int(np.argmin(loss))])


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES) -> DataFrame:
    """``lang, text`` to learn from: no more than ``languages`` times ``per_language`` rows, whatever the table.

    Texts are chosen by hash, so copies of a text are one candidate and are combined before they are exchanged.
    """
    labelled = docs.select("lang", "text", F.xxhash64("text").alias("mark")).filter("text IS NOT NULL AND lang IS NOT NULL")
    common = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(languages)
    names = [r["lang"] for r in common.select("lang").collect()]
    least = Window.partitionBy("lang").orderBy("mark")
    marks = labelled.select("lang", "mark").filter(F.col("lang").isin(names)).distinct()
    chosen = marks.withColumn("place", F.row_number().over(least)).filter(F.col("place") <= per_language).drop("place")
    # The bound of the sample bounds the broadcast: a language and a number a row.
    return labelled.join(F.broadcast(chosen), ["lang", "mark"]).groupBy("lang", "mark").agg(F.min("text").alias("text")).drop("mark")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES) -> Model:
    """Learn from ``text`` and ``lang`` of ``docs``.

    The driver gets the names of the languages and the model; the sampled rows meet in one task, which they fit
    into by the bound of the sample: each is a vector of ``BUCKETS`` counts at most.
    """

    @over_batches
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                buckets, owners = subwords(part.column("text"))
                order = np.argsort(owners, kind="stable")
                cuts = np.searchsorted(owners[order], np.arange(part.num_rows + 1))
                packed = []
                for a, b in zip(cuts[:-1], cuts[1:]):
                    found, counts = np.unique(buckets[order[a:b]], return_counts=True)
                    packed.append(found.astype(np.uint16).tobytes() + counts.astype(np.uint32).tobytes())
                yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(packed, pa.binary())], names=["lang", "vector"])

    @over_batches
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(b.column("lang").to_pylist(), b.column("vector").to_pylist())]
        # The order rows arrive in must not matter. Vectors are read where they lie: six bytes for a subword.
        samples = [
            (lang, np.frombuffer(v, np.uint16, len(v) // 6), np.frombuffer(v, "<u4", offset=len(v) // 6 * 2)) for lang, v in sorted(rows)
        ]
        model = fit([s for s in samples if len(s[1])])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model.__dict__)], pa.binary())], names=["model"])

    chosen = sample(docs, per_language, languages)
    packed = chosen.mapInArrow(vectors, "lang string, vector binary").repartition(1).mapInArrow(learn, "model binary")
    row = packed.first()
    if row is None:
        return fit([])
    model = Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0)
    model.__dict__.update(pickle.loads(row["model"]))
    return model


def judgement(text: Column, model: Model) -> Column:
    """Struct of ``lang_pred``, ``score`` and ``rejected``. Only the texts cross to Python, each once."""

    def judge(texts: pa.Array) -> pa.Array:
        found: tuple[list, list, list] = ([], [], [])
        for part in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text", SLICE):
            for kept, values in zip(found, model.predict(part.column("text"))):
                kept.extend(values)
        columns = [pa.array(c, k) for c, k in zip(found, (pa.string(), pa.float64(), pa.bool_()))]
        return pa.StructArray.from_arrays(columns, names=list(_JUDGED))

    # Costly, so Spark must not work it out again below a filter.
    return F.arrow_udf(judge, _JUDGEMENT).asNondeterministic()(text)


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``; only ``text`` is looked at."""
    kept = [c for c in docs.columns if c not in _JUDGED]
    found = docs.select(F.struct(*kept).alias("_row"), judgement(F.col("text"), model).alias("_found"))
    return found.select("_row.*", "_found.*")


def recognised(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected."""
    return docs.filter(~judgement(F.col("text"), model)["rejected"])
