"""Language identification with a string kernel.

The blended-spectrum presence kernel counts the character n-grams (n = 1..``N``) that two texts share, each
once however often it occurs, divided by the root of the product of their n-gram counts. N-grams are
hashed to ``BUCKETS`` places. Per language ``LANDMARKS`` landmark texts span the Nyström feature space
K_mm^(-1/2) k(x); ``TRAIN`` texts per language fit one ridge regression per language against the rest
there. A batch of whole texts is scored by two matrix products: presence x landmarks, then x weights. Landmarks stay packed
(4 kB each) and are unpacked ``STEP`` at a time, 16 MB, so a worker's memory does not grow with the languages.

Both samples are the different (id, text) rows with the smallest hash of their id, so the fit is the same on every run and a
row that repeats counts once. Only the packed presence bits of the sample (4 kB a text, ``TRAIN`` texts for each of
the ``LANGS`` languages that most rows have) reach the driver, never texts.

Defined cases: null texts and texts without a letter are ``und`` with score 0, and so are all if there is
nothing to learn from; rows with a null language, text or id teach nothing; with one language all texts
with a letter get it; very long texts are read in pieces; repeated rows score alike; an empty table gives
no rows; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Written

N, BUCKETS = 4, 1 << 15
LANDMARKS, TRAIN = 32, 256  # texts per language
LANGS = 200  # languages that are learned at most
RIDGE = 1e-2
UNKNOWN = "und"
PIECE, ROWS, STEP = 1 << 18, 128, 128
_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def presence(text: str, row: np.ndarray) -> None:
    """Sets the places of a text's n-grams in ``row``; blanks and letter case do not count."""
    text = " " + " ".join(text.lower().split()) + " "
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    for at in range(0, len(text), PIECE):
        c = np.frombuffer(text[at:at + PIECE + N - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        h = np.zeros(len(c), np.uint64)
        for n in range(1, min(N, len(c)) + 1):
            h = h[:len(c) - n + 1] * _SALTS[0] + (c[n - 1:] + np.uint64(n)) * _SALTS[1]
            row[((h ^ (h >> np.uint64(29))) * _SALTS[n - 1]) >> shift] = 1


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _matrix(texts: list[str]) -> np.ndarray:
    m = np.zeros((len(texts), BUCKETS), np.float32)
    for row, t in zip(m, texts):
        presence(t, row)
    return m


def _unpacked(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(bits, axis=1).astype(np.float32)


class KernelRidge:
    """Landmarks, Nyström map and ridge weights; ``scores`` gives a row of class scores per text."""

    def __init__(self, bits: np.ndarray, langs: list[str]):
        """bits: packed presence of the sample, one row a text, the landmarks of each language first in it."""
        self.langs = sorted(set(langs))
        y, seen, marks = np.array([self.langs.index(x) for x in langs]), {}, []
        for i, c in enumerate(y.tolist()):
            seen[c] = seen.get(c, 0) + 1
            if seen[c] <= LANDMARKS:
                marks.append(i)
        self.marks = bits[marks]
        k = np.vstack([self.kernel(_unpacked(self.marks[at:at + ROWS])) for at in range(0, len(marks), ROWS)])
        val, vec = np.linalg.eigh((k + k.T).astype(np.float64) / 2)
        root = (vec * np.where(val > 1e-6, 1 / np.sqrt(np.maximum(val, 1e-6)), 0)) @ vec.T
        gram, right = np.zeros((len(marks) + 1,) * 2), np.zeros((len(marks) + 1, len(self.langs)))
        for at in range(0, len(bits), ROWS):
            phi = self.kernel(_unpacked(bits[at:at + ROWS])) @ root
            phi = np.hstack([phi, np.ones((len(phi), 1))])
            one = np.where(y[at:at + ROWS, None] == np.arange(len(self.langs)), 1.0, -1.0)
            gram += phi.T @ phi
            right += phi.T @ one
        w = np.linalg.solve(gram + RIDGE * np.eye(len(gram)), right)
        self.weights, self.bias = (root @ w[:-1]).astype(np.float32), w[-1].astype(np.float32)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "cols"}

    def landmarks(self):
        """(first, columns of unit length) of ``STEP`` landmarks after the other; one step's are kept if there are no more."""
        for at in range(0, len(self.marks), STEP):
            cols = getattr(self, "cols", None)
            if cols is None:
                m = _unpacked(self.marks[at:at + STEP])
                m /= np.sqrt(np.maximum(m.sum(axis=1, keepdims=True), 1))
                cols = np.ascontiguousarray(m.T)
                if len(self.marks) <= STEP:
                    self.cols = cols
            yield at, cols

    def kernel(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.marks)), np.float32)
        for at, cols in self.landmarks():
            out[:, at:at + STEP] = x @ cols
        return out / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        f = self.kernel(_matrix(texts)) @ self.weights + self.bias
        e = np.exp(4 * (f - f.max(axis=1, keepdims=True)))
        e /= e.sum(axis=1, keepdims=True)
        return [self.langs[i] for i in f.argmax(axis=1)], e.max(axis=1).astype(np.float64).tolist()


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, learn) -> DataFrame:
    """(n, lang, bits): packed presence of the texts to learn from, n from 1 per language; at most ``TRAIN`` rows for each of at most
    ``LANGS`` languages, however often a row, an id or a text repeats."""
    rows = docs.select(docs[id_col].cast("long").alias("k"), docs[lang_col].cast("string").alias("lang"), docs[text_col].alias("t"))
    known = (rows.where("k IS NOT NULL AND lang IS NOT NULL AND t RLIKE '\\\\p{L}'").where(learn(F.col("k")))
             .withColumn("th", F.xxhash64("t")))
    langs = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGS).select("lang")
    top = Window.partitionBy("lang").orderBy(F.xxhash64("k"), "k", "th")
    ids = (known.select("k", "lang", "th").distinct().join(langs, "lang")
           .withColumn("n", F.row_number().over(top)).where(f"n <= {TRAIN}"))

    def run(batches):
        for b in batches:
            bits = [np.packbits(_matrix([t]).astype(bool)).tobytes() for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bits, pa.binary())], ["n", "lang", "bits"])

    # one text for each of them: at most TRAIN x LANGS
    chosen = (known.join(F.broadcast(Written(ids, "language-ids").df), ["k", "lang", "th"])
              .groupBy("n", "lang").agg(F.min("t").alias("t")))
    return chosen.mapInArrow(run, "n int, lang string, bits binary")


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, learn) -> KernelRidge | None:
    """Fits on the bounded sample; None if no row can be learned from."""
    got = sorted(sample(docs, id_col, text_col, lang_col, learn).collect())
    if not got:
        return None
    return KernelRidge(np.frombuffer(b"".join(bytes(r["bits"]) for r in got), np.uint8).reshape(len(got), -1),
                       [r["lang"] for r in got])


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             learn=lambda k: F.crc32(k.cast("string")) % 3 != 1) -> DataFrame:
    """(doc_id, lang_pred, score) per row. Languages are learned from the rows that ``learn`` accepts."""
    model = fit(docs, id_col, text_col, lang_col, learn)

    def run(batches):
        for b in batches:
            texts, n = b.column(1).to_pylist(), b.num_rows
            lang, score = [UNKNOWN] * n, [0.0] * n
            at = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
            for j in range(0, len(at), ROWS):
                part = at[j:j + ROWS]
                for i, x, s in zip(part, *model.predict([texts[i] for i in part])):
                    lang[i], score[i] = x, min(1.0, s)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("t")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")
