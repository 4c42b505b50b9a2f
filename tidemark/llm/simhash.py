"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into ``max_bits // 2 + 1`` segments, so that two fingerprints
within ``max_bits`` bits have a segment that differs by at most one bit (with 2 bits: two
halves of 32). Each segment is indexed under its one-wildcard variants: bit p is deleted, for
every p. Two segments within one bit share a variant, so an equality join on
(segment, p, remaining bits) finds every link; candidates are verified on all 64 bits.

Only distinct fingerprints are indexed, so exact copies cost nothing. Buckets of up to
``BUCKET`` fingerprints are compared inside the row; a larger one is never compared pair by
pair: its fingerprints are keyed by every choice of ``max_bits`` deleted bits, where a shared key
*is* a link, and each key links its members to the smallest (linear in the bucket).

Defined cases: null or blank text has fingerprint 0, linked like any other; repeated rows and
repeated ids are one entry per fingerprint; a null id never names a component unless no member
has an id; an empty table gives no rows. Other columns of the input are ignored."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Written, components, doc_key

BUCKET = 128
SEED = 42


def fingerprint(text: str | None, words: int = 3) -> int:
    """Unsigned SimHash of the word shingles of a text, A-Z lower-cased."""
    w = (text or "").encode().lower().split()  # bytes: ASCII letters and blanks only
    if not w:
        return 0
    grams = [b" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or [b" ".join(w)]
    votes, digest = np.zeros(64, np.int64), xxhash.xxh64_digest
    for at in range(0, len(grams), 65536):
        h = np.frombuffer(b"".join([digest(g, SEED) for g in grams[at:at + 65536]]), np.uint8)
        votes += np.unpackbits(h.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(grams)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, th, fp) per row; th is a hash of the text, fp the fingerprint's 64 bits as a signed long."""
    def run(batches):
        for b in batches:
            fps = [fingerprint(t, words) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.array(fps, np.uint64).view(np.int64))],
                                             ["doc_id", "th", "fp"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(docs[text_col]).alias("th"),
                       docs[text_col].alias("t")).mapInArrow(run, "doc_id long, th long, fp long")


def links(fps: DataFrame, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` at 1..max_bits differing bits: all of them, but for
    buckets of more than ``bucket``, whose members are linked to the smallest that shares a key (the same components)."""
    segs = max_bits // 2 + 1
    width = -(-64 // segs)
    spans = [(s * width, min(64, (s + 1) * width)) for s in range(segs)]
    seg_masks = [((1 << hi) - (1 << lo)) for lo, hi in spans]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    variants = [(s, p, signed(seg_masks[s] & ~(1 << p))) for s, (lo, hi) in enumerate(spans) for p in range(lo, hi)]
    table = F.expr("array(" + ",".join(f"struct({s} AS s, {p} AS p, {m}L AS m)" for s, p, m in variants) + ")")
    index = (fps.select("fp", F.explode(table).alias("v"))
             .selectExpr("v.p AS p", "fp & v.m AS rest", "fp"))
    sizes = index.groupBy("p", "rest").agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
    shared = Written(sizes.where("n > 1"), "buckets")

    few = shared.df.where("n = 2").selectExpr("lo AS a", "hi AS b").where(f"bit_count(a ^ b) <= {max_bits}")
    # A pair is reported by the first segment within one bit, at that bit (or the segment's first).
    own = "false"
    for s in reversed(range(segs)):
        d = f"((x ^ y) & {signed(seg_masks[s])}L)"
        own = (f"CASE WHEN {d} = 0 THEN p = {spans[s][0]} WHEN bit_count({d}) = 1 "
               f"THEN {d} = shiftleft(1L, p) ELSE {own} END")
    # always a sort-merge join: the shared buckets grow with the input, and the plan should not turn on their size
    some = (index.join(shared.df.where(f"n > 2 AND n <= {bucket}").select("p", "rest").hint("merge"), ["p", "rest"])
            .groupBy("p", "rest").agg(F.sort_array(F.collect_list("fp")).alias("f"))
            .select(F.explode(F.expr(
                f"flatten(transform(f, (x, i) -> transform(filter(slice(f, i + 2, size(f)), "
                f"y -> bit_count(x ^ y) <= {max_bits} AND {own}), y -> struct(x AS a, y AS b))))")).alias("e"))
            .select("e.*"))

    wide = (index.join(shared.df.where(f"n > {bucket}").select("p", "rest").hint("merge"), ["p", "rest"], "left_semi")
            .select("fp").distinct())
    gone = [signed(((1 << 64) - 1) & ~sum(1 << b for b in c)) for c in combinations(range(64), max_bits)]
    def key(batches):
        masks = np.array(gone, np.int64)
        for b in batches:
            for f in b.column(0).to_numpy():
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(masks), dtype=np.int32)), pa.array(masks & f),
                                                  pa.array(np.full(len(masks), f))], ["c", "rest", "fp"])

    keyed = wide.mapInArrow(key, "c int, rest long, fp long")
    stars = (keyed.join(keyed.groupBy("c", "rest").agg(F.min("fp").alias("a"), F.count("*").alias("n"))
                        .where("n > 1").drop("n"), ["c", "rest"]).selectExpr("a", "fp AS b").where("a <> b"))
    return few.union(some).union(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, th, fp, component_id, links, root) per row of ``docs``: a hash of the text, the
    fingerprint, the smallest doc_id reachable over links, how many other fingerprints this one links
    to, and the smallest fingerprint of the component."""
    spark = docs.sparkSession
    rows = Written(fingerprints(docs, id_col, text_col, words), "simhash").df
    first = Written(rows.groupBy("fp").agg(F.min("doc_id").alias("id0")), "distinct")
    edges = Written(links(first.df.select("fp"), max_bits, bucket), "links").df
    comp = components(edges, spark)
    rooted = first.df.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("id0").alias("component_id"))
    degree = (edges.selectExpr("a AS fp").union(edges.selectExpr("b")).groupBy("fp").agg(F.count("*").alias("links")))
    lookup = (rooted.join(names, "root").select("fp", "component_id", "root").join(degree, "fp", "left")
              .na.fill(0, ["links"]))
    return rows.join(lookup, "fp").select("doc_id", "th", "fp", "component_id", "links", "root")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                       max_bits: int = 2) -> DataFrame:
    """One document of each component, the one with the smallest id (all input columns). Of rows that
    repeat both id and text one stays; of a group without any id the one with the smallest text hash."""
    found = near_duplicates(docs, id_col, text_col, words, max_bits).withColumn("d", doc_key(F.col("doc_id")))
    heads = found.groupBy("root").agg(F.min(F.struct("d", "th")).alias("h")).select("h.d", "h.th")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), doc_key(docs[id_col]).alias("d"),
                       F.xxhash64(docs[text_col]).alias("th"))
    return rows.join(heads, ["d", "th"], "left_semi").dropDuplicates(["d", "th"]).select("row.*")
