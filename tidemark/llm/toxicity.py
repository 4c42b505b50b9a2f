"""Toxicity by compression distance.

Two zstandard dictionaries are trained on a bounded sample of labelled documents: one on ordinary
text, one that has the same base and then what is typical of toxic
text: a lexicon of word beginnings that at least three, and a fiftieth, of the sampled toxic documents hold, 30 times
more often than ordinary ones. Toxicity that lies in rarer words, or in ordinary words put together, is not seen (README). Both have the same
size and layout (the ordinary one has filler there), so they compress ordinary text alike. Every window of a text - ``WINDOW`` words with the
blanks around them, all windows of the whole text - is compressed with both; the window's distance is
the length with the ordinary dictionary less the length with the toxic one. On labelled documents that
trained no dictionary, the odds of each (distance, bytes left under the toxic dictionary) are counted. The sum of the
log odds of its different windows, those that speak against included, is taken of every stretch of ``STRETCH`` windows
(half overlapping, the whole text); a document's feature is the largest sum less the log of the number of stretches, so
that neither more clean text alone lifts it nor a toxic passage drowns in clean text. A window stands between carriers that both
dictionaries hold, as zstandard seeks no match in the last bytes of a block and stores a block that hardly shrinks uncompressed, which would hide the distance. The threshold is calibrated on the same
documents, and the feature is mapped to a score of 0.5 at the threshold.

Windows repeat, so each task keeps the distances it has computed in a bounded table.

Defined cases: empty and null texts, and all texts if no toxic label can be learned from, score
``EMPTY_SCORE``; documents without a label or with a null id train nothing; a document labelled twice
is toxic if one label says so; very long words are windows cut at ``MAX_WINDOW`` bytes; repeated rows
score alike; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Written

WINDOW, MAX_WINDOW, STRETCH = 1, 256, 400
#: The training sample: documents per class and characters per class, at most.
SAMPLE_DOCS, SAMPLE_CHARS = 2000, 4_000_000
#: Longer texts come last in the sample, the shorter of them first: they get the room that the others leave.
LONG_CHARS = 40_000
BASE_BYTES, TOXIC_BYTES = 8192, 8192
KNOWN = 200_000
EMPTY_SCORE = 0.01
CARRIER = bytes(range(128, 192))


def windows(text: str | None) -> list[bytes]:
    """The lower-cased windows of a whole text."""
    w = (text or "").lower().encode().split()
    out = [b" " + b" ".join(w[i:i + WINDOW]) + b" " for i in range(0, len(w), WINDOW)]
    if any(len(x) > MAX_WINDOW for x in out):
        out = [x[i:i + MAX_WINDOW] for x in out for i in range(0, len(x), MAX_WINDOW)]
    return out


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    p = zstandard.ZstdCompressionParameters(compression_level=5, window_log=17, hash_log=15, chain_log=15, search_log=4,
                                            min_match=4, target_length=8, strategy=3, write_checksum=False,
                                            write_content_size=False, write_dict_id=False)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=p)


def _trained(size: int, samples: list[bytes]) -> bytes:
    """A dictionary of at most ``size`` bytes; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Distance:
    """Windows under a pair of dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes, odds: dict[tuple[int, int], float] | None = None):
        self.ordinary, self.toxic, self.odds, self.known = _compressor(ordinary), _compressor(toxic), odds or {}, {}
        self.least = len(self.toxic.compress(CARRIER + CARRIER))

    def of(self, window: bytes) -> tuple[int, int]:
        """(distance, what the toxic dictionary leaves of the window), clipped."""
        cell = self.known.get(window)
        if cell is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            framed = CARRIER + window + CARRIER
            left = len(self.toxic.compress(framed))
            cell = (max(0, min(12, len(self.ordinary.compress(framed)) - left)), max(0, min(12, left - self.least)))
            self.known[window] = cell
        return cell

    def feature(self, text: str | None) -> float | None:
        """The summed log odds of the different windows of a text's most toxic stretch, less the log of the number of
        stretches; None without a window."""
        w = windows(text)
        if not w:
            return None
        odds = [self.odds.get(self.of(x), 0.0) for x in w]
        starts = range(0, max(1, len(w) - STRETCH // 2), STRETCH // 2)
        sums = (math.fsum(dict(zip(w[i:i + STRETCH], odds[i:i + STRETCH])).values()) for i in starts)
        return max(sums) - math.log(len(starts))


def distinct_texts(texts: list[str], k: int = 16, shared: int = 6) -> list[str]:
    """The texts without near copies of earlier ones (bottom-k sketches of three-word shingles): a group of copies
    must not pass for many documents that hold the same words."""
    seen: dict[int, list[int]] = {}
    out = []
    for t in texts:
        w = t.lower().encode().split()
        grams = {b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))}
        low = sorted(xxhash.xxh64_intdigest(g) for g in grams)[:k]
        met = Counter(i for h in low for i in seen.get(h, ()))
        if met and max(met.values()) >= min(shared, len(low)):
            continue
        for h in low:
            seen.setdefault(h, []).append(len(out))
        out.append(t)
    return out


def typical_segments(toxic: list[str], ordinary: list[str], least: int = 5, ratio: float = 30.0) -> list[bytes]:
    """Beginnings of words (with the blank before; whole words with the one after) held by toxic documents
    far more often than by ordinary ones; of nested ones the longest that keeps most documents. Rarest first."""
    def held(texts):
        c: Counter[bytes] = Counter()
        for t in texts:
            c.update({w[:n] for w in {x for x in windows(t) if len(x) <= 40} for n in range(5, min(len(w), 16) + 1)})
        return c

    a, b = held(toxic), held(ordinary)
    typical = {g: n for g, n in a.items()
               if n >= least and n / max(1, len(toxic)) >= ratio * (b[g] + 0.5) / max(1, len(ordinary) + 1)}
    best: dict[bytes, int] = {}
    for g in sorted(typical, key=lambda g: (len(g), g)):
        start = next((g[:n] for n in range(5, len(g)) if g[:n] in typical), None)
        if start is None:
            best[g] = typical[g]  # a shortest one
        else:
            grown = next((h for h in sorted(best, key=len, reverse=True) if g.startswith(h)), None)
            if grown is not None and typical[g] >= 0.6 * typical[start]:
                del best[grown]
                best[g] = typical[g]
    return sorted(best, key=lambda g: (typical[g], g))


def _dictionaries(base: bytes, toxic: list[str], ordinary: list[str]) -> dict[str, bytes]:
    segments = typical_segments(toxic, ordinary, max(3, len(toxic) // 50))
    words = [g for t in toxic for w in windows(t) for g in segments if w.startswith(g)]
    special = (_trained(TOXIC_BYTES // 2, words) + b"".join(segments))[-TOXIC_BYTES:] if segments else b""
    return {"ordinary": base + b"\x01" * len(special), "toxic": base + special}


def fit(toxic: list[str], ordinary: list[str]) -> dict | None:
    """{ordinary, toxic: dictionaries, threshold, slope} from the sample, or None without toxic texts."""
    if not toxic:
        return None
    toxic, ordinary = distinct_texts(toxic), distinct_texts(ordinary)
    ta, tb, oa, ob = toxic[0::2], toxic[1::2] or toxic, ordinary[0::2], ordinary[1::2] or ordinary
    base = CARRIER + _trained(BASE_BYTES, [x for t in oa for x in re.findall(rb".{1,200}", t.lower().encode(), re.S)])
    model = _dictionaries(base, ta, oa)
    d = Distance(model["ordinary"], model["toxic"])
    in1, in0 = (Counter(c for t in ts for c in map(d.of, set(windows(t)))) for ts in (tb, ob))
    n1, n0 = (sum(len(set(windows(t))) for t in ts) + 1 for ts in (tb, ob))
    model["odds"] = {c: math.log((in1[c] + 0.2) / n1 / ((in0[c] + 0.2) / n0)) for c in {*in1, *in0}}
    d.odds = model["odds"]
    f1 = [x for x in map(d.feature, tb) if x is not None]
    f0 = [x for x in map(d.feature, ob) if x is not None]
    # toxic text is the rarer class: a wrongly rejected share weighs four times a missed one
    wrong = lambda t: sum(x < t for x in f1) / max(1, len(f1)) + 4 * sum(x >= t for x in f0) / max(1, len(f0))
    steps = sorted({*f1, *f0}) or [0.0]
    options = [(x + y) / 2 for x, y in zip(steps, [*steps[1:], steps[-1] + 2])]
    model["threshold"] = min((t for t in options if t > 0), key=lambda t: (wrong(t), t), default=1.0)
    return model | _dictionaries(base, toxic, ordinary)  # calibrated: now from the whole sample


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, learn) -> DataFrame:
    """(label, text): the labelled rows to learn from, by hash of the id; bounded by ``SAMPLE_DOCS`` and ``SAMPLE_CHARS``
    per class, but for a class whose every text is longer: it has one, the shortest. No long text shuts out another."""
    known = (labels.where(labels[label_col].isNotNull() & labels[id_col].isNotNull())
             .groupBy(labels[id_col].cast("long").alias("k")).agg(F.max(label_col).alias("label")).where(learn(F.col("k"))))
    top = Window.partitionBy("label").orderBy(F.xxhash64("k"), "k")
    ids = known.withColumn("n", F.row_number().over(top)).where(f"n <= {SAMPLE_DOCS}")
    texts = docs.select(docs[id_col].cast("long").alias("k"), docs[text_col].alias("text")).where("text IS NOT NULL")
    got = Written(texts.join(F.broadcast(ids.select("k", "label", "n")), "k").dropDuplicates(["k"]), "labelled").df
    size = F.char_length("text")
    late = F.when(size > LONG_CHARS, size).otherwise(0)
    order = Window.partitionBy("label").orderBy(late, "n")  # over the sample only
    return (got.withColumns({"upto": F.sum(size).over(order), "nth": F.row_number().over(order)})
            .where(f"upto <= {SAMPLE_CHARS} OR nth = 1").select("label", "text", "n").orderBy("label", "n"))


def score(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """(row: the input's columns, score) for every row of ``docs``."""
    def run(batches):
        d = Distance(model["ordinary"], model["toxic"], model["odds"]) if model else None
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                x = d.feature(t) if d else None
                out.append(EMPTY_SCORE if x is None else
                           1 / (1 + math.exp(max(-30.0, min(30.0, model["threshold"] - x)))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], ["row", "score"])

    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].alias("t"))
    schema = f"row {packed.schema['row'].dataType.simpleString()}, score double"
    return packed.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", learn=lambda k: F.crc32(k.cast("string")) % 5 != 0) -> DataFrame:
    """(row: the input's columns, score: 0 to 1, predicted: 1 from 0.5 on). Labels are learned from the rows that
    ``learn`` accepts."""
    texts: dict[int, list[str]] = {0: [], 1: []}
    for r in sample(docs, labels, id_col, text_col, label_col, learn).collect():  # bounded, see above
        texts[int(bool(r["label"]))].append(r["text"])
    model = fit(texts[1], texts[0])
    return score(docs, model, text_col).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
