"""Personal data by weak supervision, in DataFrame functions only.

Candidates are the base spans (email, ip, card, phone), the matches that failed their base check, and
identifier-like tokens (``id``: eight or more characters with a digit). Labelers - a regex for the shape, a gazetteer
of known beginnings and domains, the words before, the mix of characters, the length - vote yes, no or
abstain. Expectation-maximisation over the counts of vote patterns (at most 3^5) estimates how reliable
each labeler is and a probability per pattern; these soft labels train the final span classifier, a naive
Bayes model over categorical features of the span and its surroundings. Spans it accepts are added as kind ``id``
where they do not overlap a base span. Base spans always stay.

Texts are scanned once; only the candidates (never texts) are shuffled, by row, and offsets come from a
running sum per row and kind. What reaches the driver is the pattern counts and the feature counts, both
bounded by the rules below and not by the data.

Defined cases: a null text is empty; repeated rows are handled each; matches touching line ends, signs outside
ASCII and very long runs follow the patterns (all of them linear); a null id stays null; an empty table gives no rows;
other columns are ignored."""

from __future__ import annotations

import math
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Written

BASE = ("email", "ip", "card", "phone")
#: The base patterns, written so that a search is linear: possessive, and begun only where a run begins
#: or where the match before ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "id": r"(?<![A-Za-z0-9+/_=.-])(?=[A-Za-z+/_=.-]*+[0-9])[A-Za-z0-9+/_=.-]{8,}+",
}
#: A text without it has no match of the kind.
NEEDS = {"email": "@", "phone": "+"}
CUES = r"(password|passwd|pwd|token|secret|api[_ -]?key|\bkey|phone|tel|call|mobile|mail|card|iban|ssn|passport|account|login|user)\W*$"
ANTI = r"(version|license|licence|page|figure|chapter|section|isbn|doi|http|www|v)\W*$"
KNOWN = r"^(AKIA|ASIA|ghp_|gho_|sk-|xox[bp]-|eyJ|AIza)|\.(com|org|net|edu|gov|io|de|fr|es|uk|eu)$"
MIN_POSTERIOR = 0.5
EM_ROUNDS = 25


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    def term(i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), term), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    part = r"0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"  # at most one way to match: no possessive star needed
    return (F.when(kind == "email", True).when(kind == "ip", m.rlike(rf"^{part}\.{part}\.{part}\.{part}$"))
            .when(kind == "card", _luhn(digits)).when(kind == "phone", F.length(digits).between(9, 15)).otherwise(False))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, kind, start, end, m: matched text, before, after, base: passes the base check); a row with nulls
    for a text without any."""
    t = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), docs[id_col].alias("doc_id"), t.alias("t"))
    cut, got = {}, {}
    for kind, p in PATTERNS.items():
        some = F.contains(F.col("t"), F.lit(NEEDS[kind])) if kind in NEEDS else F.col("t").rlike("[0-9]")
        cut[kind] = F.when(some, F.split("t", p)).otherwise(F.array(F.lit(""))).alias(f"p_{kind}")
        got[kind] = F.when(some, F.regexp_extract_all("t", F.lit(p), F.lit(0))).otherwise(F.array().cast("array<string>")).alias(f"m_{kind}")
    split = rows.select("rid", "doc_id", *cut.values(), *got.values())
    found = [F.expr(f"transform(m_{k}, (m, i) -> struct('{k}' AS kind, i AS pos, length(p_{k}[i]) AS gap, m AS m, "
                    f"right(p_{k}[i], 24) AS before, left(p_{k}[i + 1], 8) AS after))") for k in PATTERNS]
    each = split.select("rid", "doc_id", F.explode_outer(F.concat(*found)).alias("x")).select("rid", "doc_id", "x.*")
    along = Window.partitionBy("rid", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("m")).over(along)
    return (each.repartition("rid").withColumn("end", end).withColumn("start", F.col("end") - F.length("m"))
            .withColumn("base", F.when(F.col("kind").isNotNull(), _valid(F.col("kind"), F.col("m")))))


def _votes(c: DataFrame) -> DataFrame:
    """Adds v1..v5: 1 yes, 0 no, -1 abstain."""
    m, kind = F.col("m"), F.col("kind")
    low = F.lower("before")
    letters, digits = F.regexp_replace(m, "[^A-Za-z]", ""), F.regexp_replace(m, "[^0-9]", "")
    vote = lambda yes, no: F.when(yes, 1).when(no, 0).otherwise(-1)
    return c.withColumns({
        "v1": vote(F.col("base") | m.rlike(r"^([0-9a-f]{16,}|[A-Z0-9]{16,}|[A-Za-z]+=[0-9a-f]{12,})$"),
                   ((kind != "id") & ~F.col("base")) | m.rlike(r"^[0-9.,/:-]+$")),
        "v2": vote(m.rlike(KNOWN), F.lit(False)),
        "v3": vote(low.rlike(CUES) | m.rlike(r"^(password|passwd|pwd|token|secret|key)="), low.rlike(ANTI)),
        "v4": vote((kind == "id") & (F.length(digits) >= 4) & (F.length(letters) >= 3) & (F.length(m) >= 12),
                   (kind == "id") & ((F.length(digits) < 3) | (F.length(letters) == 0))),
        "v5": vote(F.length(m) >= 16, F.length(m) <= 9)})


def _features() -> dict[str, Column]:
    """Categorical features of a span, each of a few values."""
    m, before = F.col("m"), F.col("before")
    digits = F.length(F.regexp_replace(m, "[^0-9]", ""))
    return {
        "kind": F.col("kind"), "len": F.least(F.floor(F.length(m) / 4), F.lit(12)).cast("string"),
        "share": F.floor(4 * digits / F.greatest(F.length(m), F.lit(1))).cast("string"),
        "case": F.when(m.rlike("^[^a-z]+$"), "upper").when(m.rlike("^[^A-Z]+$"), "lower").otherwise("mixed"),
        "signs": F.when(m.rlike("^[A-Za-z0-9]+$"), "none").when(m.contains("="), "=").when(m.contains("@"), "@")
                  .when(m.rlike(r"^[0-9.]+$"), "dots").otherwise("other"),
        "cue": F.when(F.lower(before).rlike(CUES), "cue").when(F.lower(before).rlike(ANTI), "anti").otherwise("none"),
        "quote": F.when(before.rlike("[\"'=:]\\s*$"), "yes").otherwise("no"),
    }


def expectation_maximisation(patterns: dict[tuple[int, ...], int], rounds: int = EM_ROUNDS) -> dict[tuple[int, ...], float]:
    """Posterior of each vote pattern under a two-class model in which labelers err independently. Starts from the share
    of yes among the votes cast."""
    post = {p: (0.5 + sum(v == 1 for v in p)) / (1 + sum(v >= 0 for v in p)) for p in patterns}
    width = len(next(iter(patterns), ()))
    for _ in range(rounds):
        yes = sum(post[p] * n for p, n in patterns.items())
        total = sum(patterns.values())
        prior = (yes + 1) / (total + 2)
        rate = {}
        for j, v in product(range(width), (-1, 0, 1)):
            a = sum(post[p] * n for p, n in patterns.items() if p[j] == v)
            b = sum((1 - post[p]) * n for p, n in patterns.items() if p[j] == v)
            rate[j, v] = math.log((a + 0.5) / (yes + 1.5)) - math.log((b + 0.5) / (total - yes + 1.5))
        for p in patterns:
            x = math.log(prior) - math.log1p(-prior) + sum(rate[j, v] for j, v in enumerate(p))
            post[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))
    return post


def _lookup(key: Column, table: dict[str, float], default: float = 0.0) -> Column:
    if not table:
        return F.lit(default)
    flat = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*flat), key), F.lit(default))


def classify(spans: DataFrame) -> DataFrame:
    """Adds p: probability of the final classifier. Base spans take part in the training with their votes."""
    votes = ["v1", "v2", "v3", "v4", "v5"]
    voted = _votes(spans.where("kind IS NOT NULL")).withColumns({f"f_{k}": v for k, v in _features().items()})
    names = [f"f_{k}" for k in _features()]
    counts = voted.groupBy(*votes, *names).agg(F.count("*").alias("n"))
    tally = Written(counts, "votes").df  # one row per combination of a few values
    patterns = {tuple(r[v] for v in votes): r["n"] for r in tally.groupBy(*votes).agg(F.sum("n").alias("n")).collect()}
    post = expectation_maximisation(patterns)
    soft = _lookup(F.concat_ws(",", *votes), {",".join(map(str, p)): x for p, x in post.items()})
    weighed = tally.withColumn("w", soft * F.col("n")).withColumn("u", F.col("n") - F.col("w"))
    each = weighed.select(F.explode(F.array(*[F.concat(F.lit(f + "="), F.col(f)) for f in names])).alias("value"), "w", "u")
    sums = {r["value"]: (r["a"], r["b"]) for r in each.groupBy("value").agg(F.sum("w").alias("a"), F.sum("u").alias("b")).collect()}
    a, b = (sum(post[p] * n for p, n in patterns.items()), sum((1 - post[p]) * n for p, n in patterns.items()))
    odds = {v: math.log((x + 0.5) / (a + 1)) - math.log((y + 0.5) / (b + 1)) for v, (x, y) in sums.items()}
    prior = math.log((a + 0.5) / (b + 0.5))
    score = reduce(lambda s, f: s + _lookup(F.concat(F.lit(f + "="), F.col(f)), odds), names, F.lit(prior))
    return spans.withColumns({f"f_{k}": v for k, v in _features().items()}).withColumn(
        "p", F.when(F.col("kind").isNotNull(), 1 / (1 + F.exp(-score)))).drop(*names)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans: sorted array of (order, start, end, kind, p, base)) per row of ``docs``."""
    found = Written(candidates(docs, id_col, text_col), "candidates").df
    scored = classify(found)
    seen = Window.partitionBy("rid").orderBy("start")
    base_end, base_start = F.when(F.col("base"), F.col("end")), F.when(F.col("base"), F.col("start"))
    left = F.max(base_end).over(seen.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    right = F.min(base_start).over(seen.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    free = ~((F.coalesce(left, F.lit(-1)) > F.col("start")) | (F.coalesce(right, F.lit(2**62)) < F.col("end")))
    keep = F.col("base") | ((F.col("kind") == "id") & (F.col("p") >= MIN_POSTERIOR) & free)
    order = F.array_position(F.array(*map(F.lit, PATTERNS)), F.col("kind"))
    span = F.struct(order.alias("order"), "start", "end", "kind", "p", "base")
    return (scored.withColumn("keep", keep).groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.when(F.col("keep"), span))).alias("spans"))
        .drop("rid"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
