"""Language identification by a byte convolutional network.

Texts (A-Z lower-cased, UTF-8) are cut into fixed windows of ``LENGTH`` bytes.  Filters of
several widths run over a window's bytes, each filter's largest response is kept, and a
softmax layer over these gives the window's language.  A filter over one-hot bytes is one
row of weights per byte and offset, so a response is a sum of looked-up rows; windows are
computed in batches.  A text's score per language is the mean over all its windows, weighted
by their letters; texts are never cut short.

Training (numpy, Adam, on the driver): at most ``TRAIN_TEXTS`` texts with a language, those
with the smallest hashed doc_id whose crc32(doc_id as text) mod 3 is not 1 (of a repeated doc_id one
text), and of each at most ``TRAIN_WINDOWS`` windows spread over the text (documented bounds).  Windows of a training
text that the first round finds in another of the languages with near certainty are left out
of the second round (passages in another language).  Only text and language are used.

Defined results: ``und`` with score 0 for null texts and texts without letters; also if
nothing could be learned; a null doc_id is neither learned from nor held out; null languages
are not learned; one learned language is given to every text with letters; repeated rows give
repeated results; an empty table gives an empty one; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import ASCII_LOWER, arrow_map, column_of, docs_table, slices, texts

LENGTH = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
TRAIN_TEXTS = 4000
TRAIN_WINDOWS = 8
EPOCHS = 4
BATCH = 256

# bytes that count as letters of a window (ASCII letters and parts of other characters)
_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])


def windows(text: str, most: int | None = None) -> np.ndarray:
    """All fixed-length windows of a text (the last one padded), or ``most`` spread over it."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER), dtype=np.uint8)
    n = max(1, -(-len(raw) // LENGTH))
    flat = np.full(n * LENGTH, 32, dtype=np.uint8)
    flat[:len(raw)] = raw
    out = flat.reshape(n, LENGTH)
    return out if most is None or n <= most else out[np.linspace(0, n - 1, most).astype(int)]


@dataclass
class Network:
    languages: list[str]
    filters: list[np.ndarray]  # per width: (width, 256, FILTERS)
    weights: np.ndarray        # (filters in all, languages)
    bias: np.ndarray

    def pool(self, x: np.ndarray, places: bool = False):
        """Largest response of each filter over each window (and where)."""
        n = len(x)
        best, at = [], []
        for w in self.filters:
            k = len(w)
            last = LENGTH - k + 1
            r = w[0][x[:, :last]]
            for j in range(1, k):
                r += w[j][x[:, j:j + last]]
            if places:
                p = r.argmax(axis=1)
                at.append(p)
                best.append(np.take_along_axis(r, p[:, None], axis=1)[:, 0])
            else:
                best.append(r.max(axis=1))
        h = np.maximum(np.concatenate(best, axis=1), 0) if n else np.zeros((0, len(self.filters) * FILTERS), np.float32)
        return (h, at) if places else h

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = [np.zeros((0, len(self.languages)), np.float32)]
        for a in range(0, len(x), BATCH):
            z = self.pool(x[a:a + BATCH]) @ self.weights + self.bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out.append(z / z.sum(axis=1, keepdims=True))
        return np.concatenate(out)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], epochs: int = EPOCHS, rate: float = 3e-3, seed: int = 0) -> Network:
    rng = np.random.default_rng(seed)
    net = Network(languages, [rng.normal(0, 0.15, (k, 256, FILTERS)).astype(np.float32) for k in WIDTHS],
                  rng.normal(0, 0.15, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))
    params = [*net.filters, net.weights, net.bias]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    share = np.bincount(y, minlength=len(languages))
    weight = (len(y) / (len(languages) * np.maximum(share, 1)))[y].astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 64):
            pick = order[a:a + 64]
            h, at = net.pool(x[pick], places=True)
            z = h @ net.weights + net.bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            g = z / z.sum(axis=1, keepdims=True)
            g[np.arange(len(pick)), y[pick]] -= 1
            g *= (weight[pick] / len(pick))[:, None]
            back = (g @ net.weights.T) * (h > 0)
            grads = []
            column = np.broadcast_to(np.arange(FILTERS), (len(pick), FILTERS))
            row = np.arange(len(pick))[:, None]
            for i, w in enumerate(net.filters):
                d = np.zeros_like(w)
                for j in range(len(w)):
                    np.add.at(d[j], (x[pick][row, at[i] + j], column), back[:, i * FILTERS:(i + 1) * FILTERS])
                grads.append(d)
            grads += [h.T @ g + 1e-4 * net.weights, g.sum(axis=0)]
            step += 1
            for p, d, mm, vv in zip(params, grads, m, v):
                mm += 0.1 * (d - mm)
                vv += 0.001 * (d * d - vv)
                p -= rate * (mm / (1 - 0.9 ** step)) / (np.sqrt(vv / (1 - 0.999 ** step)) + 1e-7)
    return net


def training_rows(docs: DataFrame, most: int = TRAIN_TEXTS) -> DataFrame:
    """A bounded number of labelled documents, never held-out ones (docs: doc_id, text, lang);
    a repeated doc_id is one of them, with its first language."""
    return (docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
            .groupBy("doc_id").agg(F.min("lang").alias("lang"))
            .select("doc_id", "lang", F.xxhash64("doc_id").alias("o")).orderBy("o", "doc_id").limit(most))


def train(docs: DataFrame, most: int = TRAIN_TEXTS) -> Network | None:
    chosen = training_rows(docs, most).select(F.col("doc_id").alias("_pc_id"), F.col("lang").alias("_pc_lang"))

    def cut(batches):
        for batch in slices(batches):
            rows = [windows(t or "", TRAIN_WINDOWS) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), column_of(batch, "lang"), pa.array([r.tobytes() for r in rows], pa.binary())],
                                             ["doc_id", "lang", "x"])
    found = (docs.filter("text is not null").join(F.broadcast(chosen), (F.col("doc_id") == F.col("_pc_id")) & (F.col("lang") == F.col("_pc_lang")), "left_semi")
             .groupBy("doc_id", "lang").agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    cut_up = arrow_map(found, cut, "doc_id long, lang string, x binary").toArrow()
    got = sorted(set(zip(*(cut_up[c].to_pylist() for c in ("doc_id", "lang", "x")))))
    languages = sorted({r[1] for r in got})
    if not languages:
        return None
    x = [np.frombuffer(r[2], dtype=np.uint8).reshape(-1, LENGTH) for r in got]
    y = np.repeat([languages.index(r[1]) for r in got], [len(a) for a in x])
    x = np.concatenate(x)
    letters = _LETTER[x].sum(axis=1) >= LENGTH // 4
    if letters.any():
        x, y = x[letters], y[letters]
    net = fit(x, y, languages, epochs=max(1, EPOCHS // 2))
    if len(languages) > 1:
        p = net.probabilities(x)
        other = (p.argmax(axis=1) != y) & (p.max(axis=1) > 0.9)
        if (~other).any() and len(set(y[~other])) == len(languages):
            x, y = x[~other], y[~other]
        net = fit(x, y, languages)
    return net


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs (doc_id, text)."""
    def run(batches):
        for batch in slices(batches, 1 << 20):
            text = texts(batch)
            told = [net is not None and t is not None and _has_letter(t) for t in text]
            cut = [windows(t) for t, ok in zip(text, told) if ok]
            lang, score = ["und"] * len(text), [0.0] * len(text)
            if cut:
                x = np.concatenate(cut)
                w = _LETTER[x].sum(axis=1) + 1e-3
                starts = np.cumsum([0, *map(len, cut)])[:-1]
                p = np.add.reduceat(net.probabilities(x) * w[:, None], starts, axis=0) / np.add.reduceat(w, starts)[:, None]
                for i, q in zip(np.flatnonzero(told).tolist(), p):
                    k = int(q.argmax())
                    lang[i], score[i] = net.languages[k], float(min(max(q[k], 0.0), 1.0))
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double").select("doc_id", held.alias("held_out"), "lang_pred", "score")


def language_report(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return predict(docs, train(docs))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(docs_table(spark, sf_dir))


SQL: dict[str, str] = {}
QUERIES = {"op4_language_id": op4_language_id}
