"""Mixing sources to target weights by balanced sampling (the cube method).

Sources in code point order share the total size by weights 5, 2, 1, repeating. A target stops at
``max_repeats`` times its source's size and the excess is reshared by weight until none is above. With
r = target / source size every document is taken floor(r) times and once more with inclusion
probability r - floor(r).

These probabilities are moved along the null space of the balancing constraints (sum of sizes, number
of documents): any three open documents have a direction that keeps both totals, and a step along it,
to either side with the odds that keep expectations, settles at least one. So at most two documents
of a block stay open. Blocks of about ``BLOCK`` documents of a source run in parallel, their open
documents form the blocks of the next round, and when one block is left, its last documents are the
landing problem: the rounding with totals closest to the target. Large documents are settled first,
so that what lands is small. A source of any size is never in one task.

All randomness comes from the seed, the source's rank and the block, and blocks from a hash of the
document, so reruns and retried tasks agree whatever the partitioning.

Defined cases: null text has size 0; a null source is a source, the last; documents of size 0 are in
the mix without any words; repeated rows are separate documents; if all texts are empty, all targets are 0;
an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Written, words_of

WEIGHTS = (5, 2, 1)
BLOCK = 1024
EPS = 1e-9
MENDS = 32


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """(source, source_size) -> (source, source_size, k: rank, target). One sort by range for the ranks;
    then each round of resharing is one aggregate to two numbers. Any number of sources."""
    spark = sizes.sparkSession
    ranged = Written(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources").df
    before, offsets = 0, {}
    for part, n in sorted(ranged.groupBy("part").count().collect()):  # a row per partition
        offsets[part], before = before, before + n
    first = spark.createDataFrame(list(offsets.items()) or [(0, 0)], "part int, before long")
    k = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1 + F.col("before")
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("k") % len(weights) + 1).cast("int")).cast("long")
    src = Written(ranged.join(first, "part").withColumn("k", k).withColumn("w", w).drop("part", "before"), "ranks").df
    total = src.agg(F.sum("source_size")).first()[0] or 0
    share, seen = 0.0, None
    cap = max_repeats * F.col("source_size")
    while total:
        above = cap <= F.lit(share) * F.col("w")
        capped, open_w = src.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("w")))).first()
        if (capped, open_w) == seen or not open_w:
            break
        seen, share = (capped, open_w), (total - (capped or 0)) / open_w
    return src.select("source", "source_size", "k", F.least(cap.cast("double"), F.lit(share) * F.col("w")).alias("target"))


def flight(size: list[int], p: list[float], rng: np.random.Generator) -> list[int]:
    """Moves ``p`` in place; returns the documents, at most two, that stay strictly between 0 and 1."""
    draws, act, used = rng.random(len(p) + 2), [], 0
    for i in [*range(len(p)), None, None]:
        if i is not None:
            act.append(i)
        while len(act) == 3 or len(act) == 2 and (i is None and size[act[0]] == size[act[1]]):
            if len(act) == 3:
                a, b, c = (size[j] for j in act)
                u = (b - c, c - a, a - b) if not a == b == c else (1, -1, 0)
            else:
                u = (1, -1)
            up = min(((1 - p[j]) / v if v > 0 else p[j] / -v) for j, v in zip(act, u) if v)
            down = min((p[j] / v if v > 0 else (1 - p[j]) / -v) for j, v in zip(act, u) if v)
            step = up if draws[used] * (up + down) < down else -down
            used += 1
            for j, v in zip(act, u):
                x = p[j] + step * v
                p[j] = 0.0 if x < EPS else 1.0 if x > 1 - EPS else x
            left = [j for j in act if 0 < p[j] < 1]
            if len(left) == len(act):  # rounding kept all open: settle the nearest
                j = min(act, key=lambda j: min(p[j], 1 - p[j]))
                p[j] = float(round(p[j]))
                left.remove(j)
            act = left
    return act


def land(size: list[int], p: list[float], act: list[int]) -> None:
    """Rounds the last open documents so that first the words, then the documents are closest to the totals that
    the flight kept; then single documents change sides as long as that brings the words closer."""
    whole = sum(v * s for v, s in zip(p, size))
    options = [[(m >> i) & 1 for i in range(len(act))] for m in range(1 << len(act))]
    best = min(options, key=lambda x: (abs(sum((v - p[j]) * size[j] for v, j in zip(x, act))),
                                       abs(sum(v - p[j] for v, j in zip(x, act))), x))
    for v, j in zip(best, act):
        p[j] = float(v)
    off = sum(v * s for v, s in zip(p, size)) - whole
    for _ in range(MENDS):
        side = 1.0 if off > 0 else 0.0
        at = min((j for j in range(len(p)) if p[j] == side), key=lambda j: (abs(abs(off) - size[j]), j), default=None)
        if at is None or abs(abs(off) - size[at]) >= abs(off):
            break
        p[at] = 1.0 - side
        off += size[at] * (-1 if side else 1)


def _settler(cols: list[str], seed: int, rounds: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("tie", "ascending")])
        size, p = table["size"].to_pylist(), table["p"].to_pylist()
        act = flight(size, p, np.random.default_rng([seed, table["k"][0].as_py(), table["block"][0].as_py(), rounds]))
        if table["blocks"][0].as_py() == 1:
            land(size, p, act)
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(p, pa.float64())).select(cols)

    return run


def cube_sample(units: DataFrame, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """(k: stratum, size, p, tie: hash, ...) -> the same rows with p 0 or 1."""
    cols, schema = units.columns, units.schema
    open_, done, rounds = units.where("p > 0 AND p < 1"), units.where("p <= 0 OR p >= 1"), 0
    while True:
        counts = open_.groupBy("k").count().selectExpr("k AS kk", f"ceil(count / {block}) AS blocks")
        blocked = (open_.join(counts, F.col("k") == F.col("kk")).drop("kk")
                   .withColumn("block", F.pmod(F.xxhash64("tie", F.lit(rounds)), F.col("blocks"))))

        # dealt by block: else a join that has dealt the rows by stratum would leave a whole stratum to one task
        ran = Written(blocked.repartition("k", "block").groupBy("k", "block").applyInArrow(_settler(cols, seed, rounds), schema), "flight").df
        done = done.union(ran.where("p <= 0 OR p >= 1"))
        open_, rounds = ran.where("p > 0 AND p < 1"), rounds + 1
        if open_.isEmpty():
            return done


def numbered(sized: DataFrame, file: str) -> DataFrame:
    """(doc_id, source, size, copy): rows that are equal in all three are numbered from 0, so that no hash puts them all into
    one block. They are counted per ``file`` of theirs and the counts added up over the files, so no group is gathered."""
    per = sized.groupBy("source", "doc_id", "size", file).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("source", "doc_id", "size").orderBy(file).rowsBetween(Window.unboundedPreceding, -1))
    first = per.withColumn("first", F.coalesce(before, F.lit(0)))
    return first.select("doc_id", "source", "size", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("copy"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        max_repeats: int = 3, seed: int = 7) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) per row of ``docs``."""
    sized = Written(docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"),
                                F.size(words_of(docs[text_col])).cast("long").alias("size")), "sizes").df
    src = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeats)
    src = Written(src.withColumnRenamed("source", "s_"), "targets").df
    r = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = numbered(sized.select("*", F.col("_metadata.file_name").alias("f")), "f")
    tie = F.when(F.col("copy") == 0, F.xxhash64("doc_id", "size", F.lit(seed))).otherwise(F.xxhash64("doc_id", "size", "copy", F.lit(seed)))
    units = (rows.join(src, F.expr("source <=> s_")).drop("s_").withColumn("r", r)
             .withColumn("whole", F.floor("r").cast("long")).withColumn("p", F.col("r") - F.col("whole")).drop("r")
             .withColumn("tie", tie).drop("copy"))
    taken = cube_sample(Written(units, "units").df, seed).withColumn("copies", F.col("whole") + F.col("p").cast("long"))
    return taken.select("doc_id", "source", "size", "source_size", "target", "copies",
                        (F.col("size") * F.col("copies")).alias("taken"))


def repeat_documents(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mix itself: every document as often as ``plan`` takes it (ids must be unique)."""
    n = plan.where("copies > 0").select(F.col("doc_id").alias("__id"), F.col("copies").alias("__n"))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].alias("__id")).join(n, "__id")
    return rows.select("row", F.explode(F.expr("sequence(1, __n)"))).select("row.*")
