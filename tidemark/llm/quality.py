"""Quality rules with thresholds that adapt to each language and source.

Every document gets counts (``document_counts``) and four integer features. A mergeable quantile
sketch per (language, source, feature) replaces fixed cutoffs: an HDR-style histogram, exact below
``EXACT`` and with ``BITS`` significant bits above, so a sketch has a bounded number of cells and two
sketches merge by adding cells - here in a map-side combined ``groupBy``. A group with fewer than
``min_docs`` documents uses the merged sketch of its language, and that of all documents if the
language is that small as well. A document fails a feature beyond ``q(high) + spread * (q(high) -
q(mid)) + slack``; the joined thresholds then filter. Only DataFrame functions are used.

Defined cases: a null text has no words and fails the base rule; null language or source is a group
of its own; repeated rows count each; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words_of

EXACT, BITS = 2048, 11
MIN_WORDS = 50
#: feature -> slack: how far beyond the spread of its group a value may lie (features are per mille,
#: mean word length in hundredths of a code point).
SLACK = {"word_length": 300, "symbols": 30, "dup_lines": 150, "repeats": 200}
HIGH, MID, SPREAD, MIN_DOCS = 75, 50, 4, 200


def _n_repeat_words(hashes: Column, n: Column) -> Column:
    """Word positions covered by three-word windows that occur twice or more. ``hashes``: of the
    windows, in order. Sorted (hash, start) pairs put equal windows side by side; the covered words
    are summed over the sorted starts of those that have an equal neighbour."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))))
    # state: previous pair, whether it is already known to repeat, starts found so far
    found = F.filter(F.transform(F.arrays_zip(
        pairs.alias("a"), F.concat(F.slice(pairs, 2, F.greatest(F.size(pairs) - 1, F.lit(0))),
                                   F.array(F.lit(None).cast("struct<h:bigint,i:bigint>"))).alias("b"),
        F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:bigint>")), pairs).alias("c")),
        lambda x: F.when((x["a"]["h"] == x["b"]["h"]) | (x["a"]["h"] == x["c"]["h"]), x["a"]["i"])),
        lambda i: i.isNotNull())
    zero = F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("sum"))
    return F.aggregate(F.sort_array(found), zero, lambda s, i: F.struct(
        i.alias("last"), (s["sum"] + F.least(F.lit(3).cast("long"), i - s["last"])).alias("sum")), lambda s: s["sum"])


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    source_col: str = "source") -> DataFrame:
    """doc_id, lang, source and the counts: n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, base_failed. Whole texts, one pass, no shuffle."""
    t = F.coalesce(docs[text_col], F.lit(""))
    a = docs.select(docs[id_col].alias("doc_id"), docs[lang_col].alias("lang"), docs[source_col].alias("source"),
                    F.size(F.split(t, r"[#*$%&|<>]")).alias("sym"), words_of(docs[text_col]).alias("w"),
                    F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    b = a.select("doc_id", "lang", "source", (F.col("sym") - 1).cast("long").alias("n_symbols"),
                 F.size("w").cast("long").alias("n_words"),
                 F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.expr("CASE WHEN size(w) < 4 THEN array() ELSE transform(slice(w, 1, size(w) - 2), "
                        "(x, i) -> xxhash64(x, w[i + 1], w[i + 2])) END").cast("array<bigint>").alias("win"))
    c = b.withColumn("n_repeat_words", F.when(F.size(F.array_distinct("win")) < F.size("win"),
                                              _n_repeat_words(F.col("win"), F.col("n_words")))
                     .otherwise(F.lit(0).cast("long"))).drop("win")
    return c.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def features(counts: DataFrame) -> DataFrame:
    """Adds the features as whole numbers."""
    def per(a, b, unit):
        return F.when(F.col(b) > 0, F.floor(F.lit(unit) * F.col(a) / F.col(b))).otherwise(0).cast("long")

    return counts.withColumns({"word_length": per("word_chars", "n_words", 100), "symbols": per("n_symbols", "word_chars", 1000),
                               "dup_lines": per("n_dup_lines", "n_lines", 1000),
                               "repeats": per("n_repeat_words", "n_words", 1000)})


def cell(v: Column) -> Column:
    """Lower bound of the sketch cell of a value."""
    low = F.greatest(F.length(F.bin(v)) - BITS, F.lit(0))
    return F.when(v < EXACT, v).otherwise(F.call_function("shiftleft", F.call_function("shiftright", v, low), low))


def sketches(feats: DataFrame) -> DataFrame:
    """(lang, source, feature, cell, n): one sketch per group and feature."""
    return (feats.select("lang", "source", F.explode(F.array(
        *[F.struct(F.lit(f).alias("feature"), cell(F.col(f)).alias("cell")) for f in SLACK])).alias("x"))
        .groupBy("lang", "source", F.col("x.feature").alias("feature"), F.col("x.cell").alias("cell"))
        .agg(F.count("*").alias("n")))


def quantiles(sketch: DataFrame, keys: list[str], percents: dict[str, int]) -> DataFrame:
    """(keys, feature, docs, a column per name): merges the sketches of each key and reads its percentiles.
    The windows run over the bounded cells of a sketch, never over documents."""
    by = [*keys, "feature"]
    merged = sketch.groupBy(*by, "cell").agg(F.sum("n").alias("n"))
    part = ", ".join(by)
    cum = merged.selectExpr("*", f"sum(n) OVER (PARTITION BY {part} ORDER BY cell) AS upto",
                            f"sum(n) OVER (PARTITION BY {part}) AS docs")
    return cum.groupBy(*by).agg(F.max("docs").alias("docs"), *[
        F.min(F.when(100 * F.col("upto") >= p * F.col("docs"), F.col("cell"))).alias(name) for name, p in percents.items()])


def thresholds(sketch: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, one limit per feature) for every group, from its own, its language's or all documents' sketch."""
    pc = {"mid": MID, "high": HIGH}
    own, lang, every = (quantiles(sketch, k, pc) for k in (["lang", "source"], ["lang"], []))
    o, l, e = own.alias("o"), lang.alias("l"), every.alias("e")
    picked = (o.join(l, F.expr("o.lang <=> l.lang AND o.feature = l.feature"))
              .join(F.broadcast(e), F.expr("o.feature = e.feature")))  # four rows
    pick = lambda c: F.expr(f"CASE WHEN o.docs >= {min_docs} THEN o.{c} WHEN l.docs >= {min_docs} THEN l.{c} ELSE e.{c} END")
    slack = F.coalesce(*[F.when(F.col("o.feature") == f, F.lit(s)) for f, s in SLACK.items()])
    limit = (pick("high") + SPREAD * (pick("high") - pick("mid")) + slack).alias("lim")
    rows = picked.select("o.lang", "o.source", "o.feature", limit)
    return rows.groupBy("lang", "source").agg(*[F.max(F.when(F.col("feature") == f, F.col("lim"))).alias(f"max_{f}")
                                                for f in SLACK])


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source", min_docs: int = MIN_DOCS) -> DataFrame:
    """The counts and features of every document, its group's limits and ``kept``."""
    from .common import Written

    feats = Written(features(document_counts(docs, id_col, text_col, lang_col, source_col)), "quality").df
    lim = thresholds(sketches(feats), min_docs).withColumnsRenamed({"lang": "l_", "source": "s_"})
    out = feats.join(lim, F.expr("lang <=> l_ AND source <=> s_")).drop("l_", "s_")
    ok = ~F.col("base_failed")
    for f in SLACK:
        ok = ok & (F.col(f) <= F.col(f"max_{f}"))
    return out.withColumn("kept", ok)
