"""Divergence of the sources of a language, by their word frequencies.

A document's bytes go through one translation table, which lowers A-Z and blanks every other ASCII character, are split at
blanks, and a counter per document gives term frequencies; a task sums them, and in how many documents each term is, by
(language, source, term) in a table of bounded size before anything is shuffled. A language keeps the terms that at least ``MIN_DOCS``
of its documents (rows) hold.

With smoothing ``p(term) = 1 + floor(UNIT (count + 2) / (N + 2 V))`` per source and per language, and f(p, q) = floor((p - q)^2 / (p + q)),
each (language, source) group is compared with every other source (part ``pair``: f summed over all kept terms, also those that
neither holds) and with its language (part ``term``: the ``TOP`` terms that are most over-used). All arithmetic is on whole numbers.

The pairs are computed on blocks of terms: a block meets its language's sources, forms a small dense matrix of counts and returns one
partial sum per pair, so rows per pair and term never exist and the terms of a large language are spread over many tasks. A block has about
``BLOCK`` counts; the sums of a language's pairs are as many as its part of the result.

Defined cases: null text, lang and source are ''; a text without a term still makes its group occur; rows that repeat an id are
documents of their own; a language with one source has no pairs, one without kept terms has pairs of value 0; ties are ranked by the item's UTF-8; very long texts
are counted whole; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Written

MIN_DOCS, UNIT, PRIOR, TOP = 10, 10**9, 2, 10
BLOCK = 1 << 17  # counts in a block of terms, about
TABLE_ENTRIES = 1 << 18  # terms that a task holds before it passes them on
CELLS = 1 << 20  # entries of the dense matrix at a time

#: Letters and the bytes of other scripts stay, A-Z are lowered, the rest is blank.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes | None) -> Counter:
    """How often a text has each of its terms."""
    return Counter(text.translate(TABLE).split()) if text else Counter()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term: binary, c, docs): partial sums of the tasks. The empty term stands for the group itself."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("c", pa.int64()), ("docs", pa.int64())])

    def passed_on(table):
        for (lang, source), (c, held) in table.items():
            n = len(held)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(list(held), pa.binary()),
                                              pa.array([c[t] for t in held], pa.int64()), pa.array(held.values(), pa.int64())], schema=schema)

    def run(batches):
        table, size = defaultdict(lambda: (Counter(), Counter())), 0
        for b in batches:
            for text, lang, source in zip(*(c.to_pylist() for c in b.columns)):
                c, held = table[lang, source]
                before = len(held)
                one = terms(text)
                for t, n in one.items():
                    c[t] += n
                held.update(one.keys())
                held[b""] += 1
                size += len(held) - before
                if size >= TABLE_ENTRIES:
                    yield from passed_on(table)
                    table.clear()
                    size = 0
        yield from passed_on(table)

    text = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    rows = docs.select(docs[text_col].cast("binary").alias("text"), text(lang_col).alias("lang"), text(source_col).alias("source"))
    return rows.mapInArrow(run, "lang string, source string, term binary, c long, docs long")


def _p(count: Column, total: Column, v: Column) -> Column:
    """Smoothed frequency; the product needs more than a long."""
    return F.lit(1) + F.call_function("div", (count + PRIOR).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)"), (total + 2 * v).cast("decimal(20,0)"))


def smoothed(c: np.ndarray, total: int, v: int) -> np.ndarray:
    """1 + floor(UNIT (c + 2) / (N + 2 V)) by long division, so that no step leaves the long range while N + 2 V < 9e15."""
    q, r = np.divmod(c + PRIOR, total + 2 * v)
    for _ in range(3):  # UNIT is a thousand cubed
        more, r = np.divmod(r * 1000, total + 2 * v)
        q = q * 1000 + more
    return q + 1


def _block_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    """Partial sums of the pairs of sources over a block's terms."""
    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])
    groups = sorted(zip(right["source"].to_pylist(), right["n"].to_pylist(), right["v"].to_pylist()))
    names = [g[0] for g in groups]
    if len(names) < 2:
        return schema.empty_table()
    place = {s: i for i, s in enumerate(names)}
    source = np.array([place[s] for s in left["source"].to_pylist()], np.int64)
    term = left["term"].combine_chunks().dictionary_encode().indices.to_numpy() if len(left) else np.zeros(0, np.int64)
    count = left["c"].to_numpy()
    order = np.argsort(term, kind="stable")
    source, term, count = source[order], term[order], count[order]
    n_terms, step = int(term[-1]) + 1 if len(term) else 0, max(1, CELLS // len(names))
    total = np.zeros((len(names),) * 2, np.int64)
    for at in range(0, n_terms, step):
        part = slice(*np.searchsorted(term, [at, at + step]))
        c = np.zeros((len(names), min(step, n_terms - at)), np.int64)
        c[source[part], term[part] - at] = count[part]
        p = np.stack([smoothed(row, n, v) for row, (_, n, v) in zip(c, groups)])
        for i in range(len(names) - 1):
            total[i, i + 1:] += ((p[i] - p[i + 1:]) ** 2 // (p[i] + p[i + 1:])).sum(axis=1)
    i, j = np.triu_indices(len(names), 1)
    name = pa.array(names, pa.string())
    return pa.Table.from_arrays([pa.array([right["lang"][0].as_py()] * len(i), pa.string()), name.take(pa.array(i)), name.take(pa.array(j)),
                                 pa.array(total[i, j])], schema=schema)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank)."""
    same = Window.partitionBy("lang", "term")
    # dealt by (lang, term): the sums by source and those of the language then need no other shuffle
    counts = (term_counts(docs, text_col, lang_col, source_col).repartition("lang", "term")
              .groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("docs").alias("docs"))
              .withColumns({"held": F.sum("docs").over(same), "all": F.sum("c").over(same), "first": F.min("source").over(same)})
              .where((F.col("held") >= min_docs) | (F.col("term") == F.lit(b""))))
    kept = Written(counts.select("lang", "source", "term", "c", "all", (F.col("first") == F.col("source")).alias("first")), "term-counts").df
    is_term = F.col("term") != F.lit(b"")
    groups = kept.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    langs = kept.groupBy("lang").agg(F.sum("c").alias("n_lang"), F.count_if(is_term & F.col("first")).alias("v"),
                                     F.greatest(F.lit(1), F.ceil(F.count_if(is_term) / block)).cast("int").alias("blocks"))
    groups = groups.join(langs, "lang")

    p, q = F.col("p"), F.col("q")
    over = (kept.where(is_term).join(groups, ["lang", "source"])
            .withColumns({"p": _p(F.col("c"), F.col("n"), F.col("v")), "q": _p(F.col("all"), F.col("n_lang"), F.col("v"))}).where("p > q")
            .withColumn("value", F.call_function("div", (p - q) * (p - q), p + q)))
    rank = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    over = (over.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank"))

    left = (kept.where(is_term).join(langs, "lang")
            .select("lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), "source", "term", "c"))
    right = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block"), "source", "n", "v")
    right = right.toDF(*right.columns)  # new references: both sides come from the same table
    sums = (left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block"))
            .applyInArrow(_block_pairs, "lang string, a string, b string, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = sums.select("lang", "value", F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                         F.struct(F.col("b").alias("source"), F.col("a").alias("item")))))
    pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                        F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank"))
    return pairs.unionByName(over)
