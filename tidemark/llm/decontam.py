"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are token sequences (``\\w+``, lower-cased; in scripts without blanks each letter). Seeds are the items' runs
of ``min_match`` tokens; a document that shares a seed with an item is tiled against it: the
longest common runs of unmarked tokens, found by running Karp-Rabin hashes over ever shorter lengths,
are marked on both sides until no run of ``min_match`` is left. Tiles are one to one and in any
order, so the share of marked item tokens (coverage) also catches reordered passages. A document is
contaminated by an item from ``threshold`` coverage on.

While the benchmark has at most ``BROADCAST_CHARS`` characters (counted first), it travels to the tasks
and one scan without a shuffle does all. Beyond it, the seeds of both sides are equality-joined and each
candidate pair is tiled after joining its texts; the results are the same.

Defined cases: null and empty texts match nothing; items of fewer than ``min_match`` tokens are not
tested; repeated documents or items are reported for each row; a null id stays null; rows that share an id, or have none,
are judged each by its own text; empty tables give no rows; other columns are ignored."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Written, doc_key

#: Scripts written without blanks: Thai, Lao, Burmese, Khmer, Kana, Han.
UNSPACED = (r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
            r"\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff")
TOKEN = re.compile(rf"[^\W{UNSPACED}]+|\w")
MIN_MATCH = 5
THRESHOLD = 0.5
BROADCAST_CHARS = 16_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "item bigint, coverage double, n_tiles int, longest int"


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def _rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hash of every run of n tokens (unsigned wrap-around)."""
    if len(ids) < n:
        return np.empty(0, np.uint64)
    h = np.zeros(len(ids) - n + 1, np.uint64)
    mixed = ids.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    for i in range(n):
        h = h * _BASE + mixed[i:len(ids) - n + 1 + i]
    return h


def _free_runs(marked: np.ndarray, n: int) -> np.ndarray:
    """Starts of the windows of n tokens without a marked one."""
    if len(marked) < n:
        return np.empty(0, np.int64)
    c = np.concatenate(([0], np.cumsum(marked)))
    return np.flatnonzero(c[n:] == c[:-n])


def tile(a: np.ndarray, b: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in a, start in b, length), longest first within each search length.
    Negative tokens never match."""
    ma, mb, tiles = a < 0, b < 0, []
    s = max(min_match, min(len(a), len(b)) // 2)
    while True:
        where: dict[int, list[int]] = {}
        hb = _rolling(b, s)
        for j in _free_runs(mb, s).tolist():
            where.setdefault(int(hb[j]), []).append(j)
        found = []
        if where:
            ha, free = _rolling(a, s), _free_runs(ma, s)
            for i in free[np.isin(ha[free], np.array(list(where), np.uint64))].tolist():
                for j in where[int(ha[i])]:
                    if i and j and not ma[i - 1] and not mb[j - 1] and a[i - 1] == b[j - 1]:
                        continue  # part of a longer match that starts earlier
                    k = 0
                    while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not ma[i + k] and not mb[j + k]:
                        k += 1
                    if k >= s:
                        found.append((-k, i, j))
        again = False
        for k, i, j in sorted(found):
            if not ma[i:i - k].any() and not mb[j:j - k].any():
                ma[i:i - k] = mb[j:j - k] = True
                tiles.append((i, j, -k))
            else:
                again = True  # partly hidden by a longer tile: what is left is searched anew
        if again:
            continue
        if s == min_match:
            return tiles
        s = max(min_match, s // 2)


def tile_document(doc: np.ndarray, item: np.ndarray, seeds: np.ndarray, n: int = MIN_MATCH):
    """(coverage, tiles, longest) of a document against one item. Only tokens inside a shared seed can
    be in a tile, so the rest of the document is cut away first."""
    hit = np.zeros(len(doc) + 1, np.int64)
    at = np.flatnonzero(np.isin(_rolling(doc, n), seeds))
    np.add.at(hit, at, 1)
    np.add.at(hit, at + n, -1)
    inside = np.cumsum(hit)[:-1] > 0
    keep = np.flatnonzero(inside)
    if not len(keep):
        return 0.0, 0, 0
    gaps = np.flatnonzero(np.diff(keep) > 1) + 1
    short = np.insert(doc[keep], gaps, -1)
    tiles = tile(short, item, n)
    return (sum(t[2] for t in tiles) / len(item), len(tiles), max((t[2] for t in tiles), default=0))


class Bench:
    """The benchmark as token numbers, and its seeds in sorted arrays."""

    def __init__(self, items: list[tuple[int, str]], n: int = MIN_MATCH):
        self.n, self.vocab, self.items, seeds, owner = n, {}, [], [], []
        for key, text in items:
            ids = np.array([self.vocab.setdefault(t, len(self.vocab)) for t in tokens(text)], np.int64)
            if len(ids) >= n:
                h = np.unique(_rolling(ids, n))
                seeds.append(h)
                owner.append(np.full(len(h), len(self.items)))
                self.items.append((key, ids, h))
        h = np.concatenate(seeds) if seeds else np.empty(0, np.uint64)
        o = np.concatenate(owner) if owner else np.empty(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.seeds, self.owner = h[order], o[order]

    def numbers(self, text: str | None) -> np.ndarray:
        get = self.vocab.get
        return np.array([get(t, -1) for t in tokens(text)], np.int64)

    def matches(self, text: str | None, threshold: float):
        doc = self.numbers(text)
        if len(doc) < self.n or not len(self.seeds):
            return
        c = np.concatenate(([0], np.cumsum(doc < 0)))
        at = np.flatnonzero(c[self.n:] == c[:-self.n])
        if not len(at):
            return
        h = np.unique(_rolling(doc, self.n)[at])
        lo, hi = np.searchsorted(self.seeds, h, "left"), np.searchsorted(self.seeds, h, "right")
        hit = lo < hi
        which = {int(o) for x, y in zip(lo[hit].tolist(), hi[hit].tolist()) for o in self.owner[x:y]}
        for o in sorted(which):
            key, ids, seeds = self.items[o]
            cover, n_tiles, longest = tile_document(doc, ids, seeds, self.n)
            if cover >= threshold:
                yield key, cover, n_tiles, longest


def _rows(found: list) -> pa.RecordBatch:
    names = ["key", "th", "item", "coverage", "n_tiles", "longest"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(types)], names)


def _by_scan(docs: DataFrame, items: list, threshold: float, n: int) -> DataFrame:
    def run(batches):
        bench = Bench(items, n)
        for b in batches:
            yield _rows([(k, h, *m) for k, h, t in zip(*(b.column(j).to_pylist() for j in range(3)))
                         for m in bench.matches(t, threshold)])

    return docs.select("key", "th", "text").mapInArrow(run, f"key bigint, th bigint, {SCHEMA}")


def _seed_rows(df: DataFrame, n: int) -> DataFrame:
    """(key, th, seed): the distinct seeds of each text; tokens are hashed, as there is no common vocabulary."""
    import xxhash

    def run(batches):
        for b in batches:
            key, th, seed = [], [], []
            for k, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                ids = np.array([xxhash.xxh64_intdigest(w) >> 1 for w in tokens(t)], np.int64)
                s = np.unique(_rolling(ids, n)).view(np.int64)
                key += [k] * len(s)
                th += [h] * len(s)
                seed += s.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(th, pa.int64()), pa.array(seed, pa.int64())],
                                             ["key", "th", "seed"])

    return df.select("key", "th", "text").mapInArrow(run, "key bigint, th bigint, seed bigint")


def _by_join(d: DataFrame, items: DataFrame, threshold: float, n: int) -> DataFrame:
    i = items.withColumn("th", F.xxhash64("text"))
    seeds = _seed_rows(i, n).selectExpr("key AS item", "th AS item_th", "seed")
    pairs = (_seed_rows(d.select("key", "th", "text").dropDuplicates(["key", "th"]), n).join(seeds, "seed")
             .select("key", "th", "item", "item_th").distinct())
    texts = (pairs.join(i.selectExpr("key AS item", "th AS item_th", "text AS item_text").dropDuplicates(["item", "item_th"]),
                        ["item", "item_th"]).join(d, ["key", "th"]))

    def run(batches):
        for b in batches:
            yield _rows([(k, h, *m) for k, h, item, text, it in zip(*(b.column(j).to_pylist() for j in range(5)))
                         for m in Bench([(item, it)], n).matches(text, threshold)])

    return texts.select("key", "th", "item", "text", "item_text").mapInArrow(run, f"key bigint, th bigint, {SCHEMA}")


def _found(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD,
           min_match: int = MIN_MATCH, broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """(key, th: hash of the text, item, coverage, n_tiles, longest) for every contaminated document and item."""
    d = docs.select(doc_key(docs[id_col]).alias("key"), F.xxhash64(docs[text_col]).alias("th"), docs[text_col].alias("text"))
    items = benchmark.select(doc_key(benchmark[item_id_col]).alias("key"), benchmark[item_text_col].alias("text"))
    chars = items.agg(F.sum(F.char_length("text") + 16)).first()[0] or 0
    if chars <= broadcast_chars:
        return _by_scan(d, [tuple(r) for r in items.collect()], threshold, min_match)
    return _by_join(d, items, threshold, min_match)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD,
                 min_match: int = MIN_MATCH, broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles, longest) for every contaminated document and item."""
    got = _found(docs, benchmark, id_col, text_col, item_id_col, item_text_col, threshold, min_match, broadcast_chars)
    none = lambda c: F.when(F.col(c) < F.lit(2**63 - 1), F.col(c))
    return got.select(none("key").alias("doc_id"), none("item").alias("item_id"), "coverage", "n_tiles", "longest")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         **options) -> DataFrame:
    """The documents that no item contaminates (all input columns). A row goes for its own text only: others
    with its id, or without any id as well, stay."""
    found = _found(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    bad = Written(found.selectExpr("key AS __bad", "th AS __th").distinct(), "contaminated").df
    mine = (doc_key(docs[id_col]) == bad["__bad"]) & (F.xxhash64(docs[text_col]) == bad["__th"])
    return docs.join(bad, mine, "left_anti")
