"""Operators against brute force: whole small tables, and the cases that docstrings define."""

import collections
import hashlib
import os
import sys

import duckdb
import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute as B  # noqa: E402

from tidemark.llm import decontam, html_text, language, line_dedup, mixing, pii, quality, queries, simhash, suffix_dedup, toxicity  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, d string, key string, fp string"
LONG = ("Alpha beta gamma delta. " * 3000) + "\n" + "x" * 5000
CASES = [(1, None), (2, ""), (3, "One two three four five six seven eight nine ten."),
         (3, "One two three four five six seven eight nine ten."), (4, LONG), (5, LONG), (None, "a line of its own\nA LINE of its own "),
         (6, "  a Line of its own\r\nshort\n"), (7, "mail a@b.c_d@e.f or 1.2.3.4.5.6.7.8, 999.1.1.1, +1 (988) 555-2485; 4111 1111-1111 1111"),
         (8, "ümläut " * 60)]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    return spark.createDataFrame([(i, t, "en" if i != 8 else None, None if i == 8 else "s", 1, "r", "d", "k", "f") for i, t in CASES], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def table():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet'").fetchall()


def test_mixing(spark, table):
    rows = queries.QUERIES["op1_mixing"](spark, SF).collect()
    sizes, taken = collections.Counter(), collections.Counter()
    for _, t, _, s in table:
        sizes[s] += len(B.words(t))
    want = B.targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(rows) == len(table) and sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert abs(sum(taken.values()) - sum(sizes.values())) < 0.05 * sum(sizes.values())
    again = queries.QUERIES["op1_mixing"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_flight_keeps_totals():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 50, 400):
        size, p = rng.integers(0, 9, n).tolist(), rng.random(n).clip(0.01, 0.99).tolist()
        before, count = sum(a * b for a, b in zip(size, p)), sum(p)
        act = mixing.flight(size, p, rng)
        assert len(act) <= 2 and all(0 < p[j] < 1 for j in act)
        assert all(x in (0.0, 1.0) for j, x in enumerate(p) if j not in act)
        assert abs(sum(a * b for a, b in zip(size, p)) - before) < 1e-6 and abs(sum(p) - count) < 1e-6


def test_language_and_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{sf}/documents.parquet'").fetchall())
    held = [r for r in queries.QUERIES["op2_language"](spark, sf).collect() if r["held_out"]]
    assert all(B.crc(r["doc_id"]) % 3 == 1 for r in held)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    rows = queries.QUERIES["op3_toxicity"](spark, sf).collect()
    known = [r for r in rows if r["held_out"] and r["doc_id"] in toxic]
    assert len(rows) == 1000 and all(B.crc(r["doc_id"]) % 5 == 0 for r in known)
    assert sum(r["predicted"] == toxic[r["doc_id"]] for r in known) >= 0.93 * len(known)


def test_a_long_labelled_text_shuts_out_no_other(spark):
    huge = "word " * (toxicity.SAMPLE_CHARS // 5 + 1)
    rows = [(i, huge if i % 10 < 2 else f"text {i}", i % 2) for i in range(40)]  # the shares of both classes vary in the hash order
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    every = lambda k: k.isNotNull()
    got = toxicity.sample(docs, labels, "doc_id", "text", "toxic", every).collect()
    assert sorted((r["label"], r["text"]) for r in got) == sorted((y, t) for _, t, y in rows if t != huge)
    only = toxicity.sample(docs.where("doc_id = 1 OR doc_id % 2 = 0"), labels, "doc_id", "text", "toxic", every).collect()
    assert [len(r["text"]) for r in only if r["label"] == 1] == [len(huge)]


def test_toxicity_does_not_grow_with_length():
    sf = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"SELECT doc_id, text, toxic FROM '{sf}/documents.parquet' JOIN '{sf}/labels.parquet' USING (doc_id) "
                      "WHERE text IS NOT NULL ORDER BY doc_id").fetchall()
    learned = [[t for i, t, y in rows if y == k and B.crc(i) % 5] for k in (0, 1)]
    model = toxicity.fit(learned[1], learned[0])
    d = toxicity.Distance(model["ordinary"], model["toxic"], model["odds"])
    rng = np.random.default_rng(7)
    clean, toxic = [t for i, t, y in rows if not y and B.crc(i) % 5 == 0], [t for t in learned[1] if d.feature(t) >= model["threshold"] + 3]
    some = lambda n: [clean[i] for i in rng.integers(0, len(clean), n)]
    assert sum(d.feature("\n".join(some(40))) >= model["threshold"] for _ in range(50)) <= 2
    found = [d.feature("\n".join([*some(4), t, *some(5)])) >= model["threshold"] for t in toxic]
    assert len(found) >= 10 and sum(found) >= 0.7 * len(found)


def test_kernel_counts_shared_grams():
    a, b = np.zeros(language.BUCKETS, np.float32), np.zeros(language.BUCKETS, np.float32)
    language.presence("Abba", a)
    language.presence(" abba\n", b)
    assert (a == b).all() and 10 <= a.sum() <= 15
    assert not language.has_letter("12 .!") and language.has_letter("1 ß") and not language.has_letter(None)


def test_simhash(spark, table):
    got = {r["doc_id"]: r for r in queries.QUERIES["op4_simhash"](spark, SF).collect()}
    fps = {i: B.fingerprint(t) for i, t, _, _ in table}
    comp = B.components(list(fps.items()))
    assert {i: (int(r["fingerprint"], 16), r["component_id"]) for i, r in got.items()} == {i: (f, comp[f]) for i, f in fps.items()}


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
@pytest.mark.parametrize("bucket", [1, 4, 128])
def test_links_equal_all_pairs(spark, bits, bucket):
    if bits > 2 and bucket < 128:
        pytest.skip("as many keys as choices of three bits")
    rng = np.random.default_rng(bits)
    seeds = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = {0, (1 << 64) - 1}
    for s in seeds.tolist():
        fps |= {s ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(8)}
    fps = sorted(fps)
    want = {(a, b) for a in fps for b in fps if a != b and bin(a ^ b).count("1") <= bits}
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    got = {(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(df, bits, bucket).collect()}
    got, want = {frozenset(p) for p in got}, {frozenset(p) for p in want}
    assert got <= want if bucket < 128 else got == want  # large buckets give stars: fewer links, the same components

    def groups(pairs):
        root = {f: f for f in fps}
        for _ in fps:
            for a, b in map(sorted, pairs):
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert groups(got) == groups(want)


def test_one_of_each_group_stays(docs, empty):
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [*((False, i) for i in (1, 3, 4, 6, 7, 8)), (True, 0)]
    assert simhash.keep_one_per_group(empty).count() == 0


def test_personal_data(spark, docs, empty, table):
    got = {r["doc_id"]: r for r in queries.QUERIES["op5_pii"](spark, SF).collect()}
    for i, t, _, _ in table:
        spans = B.base_spans(t)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest() and got[i]["spans"].startswith(text)
        assert [got[i][f"n_{k}"] for k in B.BASE] == [sum(s[0] == k for s in spans) for k in B.BASE]
    rows = pii.find(docs).collect()
    assert len(rows) == len(CASES) and pii.find(empty).count() == 0
    seven = next(r for r in rows if r["doc_id"] == 7)["spans"]
    assert [(s["kind"], s["start"], s["end"]) for s in seven if s["base"]] == B.base_spans(CASES[8][1])


def test_ip_with_parts_of_zero(spark):
    texts = ["10.0.0.1", "0.0.0.0", "010.00.0.1", "127.0.0.1, 192.168.0.255;256.0.0.1", "0.0.0.256", "000.000.000.000255 1.2.3.4",
             "0" * 3000 + ".0.0." + "0" * 3000 + "7"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]] for r in pii.find(df).collect()}
    assert got == {i: B.base_spans(t) for i, t in enumerate(texts)}
    assert [sum(k == "ip" for k, _, _ in got[i]) for i in range(7)] == [1, 1, 1, 2, 0, 2, 1]


def test_em_finds_reliable_labelers():
    post = pii.expectation_maximisation({(1, 1, -1): 50, (0, 0, -1): 60, (1, 0, 1): 5, (0, 0, 0): 30, (1, 1, 1): 20})
    assert post[1, 1, 1] > 0.9 > 0.1 > post[0, 0, 0]


PAGES = [
    ("<p>a<p>b <b>c</b>", "a\n\nb c"), ("<ul><li>x<li>y<ol start=3><li>n</ol></ul>", "- x\n- y\n  3. n"),
    ("<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>", "a    | bbb\ncccc | d"),
    ("<div style='display: none'>no</div>yes<script>var a='</p>'</script><span hidden>no</span>", "yes"),
    ("<div style='visibility:hidden'>a<b style='visibility:visible'>b</b></div>", "b"),
    ("<pre> k\n  l</pre>x<br>y", " k\n  l\n\nx\ny"), ("<details><summary>s</summary>hidden</details>", "s"),
    ("<head><title>t</title></head>a &amp; b</i></div>", "a & b"), ("", ""), (None, None), ("<td>cell<tr", "cell"),
    ("<dl><dt>t<dd>d</dl>", "t\n  d"),
]


@pytest.mark.parametrize("html,text", PAGES)
def test_visible_text(html, text):
    assert html_text.visible_text(html) == text


ODD_PAGES = [
    ("a<![0]>b", "ab"), ("a<![foo[bar]]>b", "ab"), ("a<!x>b<![CDATA[c>d]]>e<!", "abd]]>e"), ("a<![", "a"), ("<!doctype html>a<!-- > -->b", "ab"),
    ("<table><tr><td colspan='²'>a<td>b</table>", "a | b"), ("<table><tr><td colspan=" + "9" * 5000 + ">a<td>b</table>", "a |" + "  |" * 99 + " b"),
    ("<ol start='²'><li>a</ol>", "1. a"), ("<ol start=" + "9" * 5000 + "><li>a</ol>", "1. a"), ("<ol start=-1><li>a</ol>", "-1. a"),
    ("a&#" + "9" * 5000 + ";b&#0065;", "a\ufffdbA"),
    ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math>", "x=2"),
    ("a<svg><title>no</title><path d=''/><defs><text>no</text></defs>no<text>b<tspan>c</tspan></text><text/><text>d</text></svg>e", "a\nbc\nd\ne"),
    ("<svg><text><![CDATA[x<y]]></text></svg>", "x<y"), ("<svg><foreignObject><p>a</foreignObject></svg><svg><path><p>b", "a\n\nb"),
    ("<div style='backface-visibility:hidden'>a</div>", "a"), ("<b style='--display:none'>a</b>", "a"),
    ("<b style='background:url(x;display:none);color:red'>a</b><b style='color:red; DISPLAY : none !important; display:block'>b</b>", "a"),
    ("<div style='visibility:hidden'>a<b style='visibility:inherit'>b</b><i style='visibility:\tvisible'>c</i></div>", "c"),
]


@pytest.mark.parametrize("html,text", ODD_PAGES)
def test_odd_markup(html, text):
    assert html_text.visible_text(html) == text


def test_extract(spark, empty):
    pages = spark.createDataFrame([(1, "<p>x", "t"), (1, None, "t")], "page_id long, html string, text string")
    assert sorted(str(r["text"]) for r in html_text.extract(pages).collect()) == ["None", "x"]
    assert html_text.visible_text("<div>" * 20000 + "deep") == "deep"
    assert html_text.extract(empty, "text").count() == 0


def test_repeats(spark, table):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op7_suffix_dedup"](spark, SF).collect()}
    assert got == {d[0]: w for d, w in zip(table, B.repeats([d[1] for d in table]))}


@pytest.mark.parametrize("hot", [2, 4096])
def test_repeats_small(spark, hot):
    rng = np.random.default_rng(hot)
    texts = ["".join(rng.choice(list("ab ä"), rng.integers(0, 90))) for _ in range(40)] + [None, "", "ab" * 60, "ab" * 60, "a" * 99]
    df = spark.createDataFrame([(i if i % 9 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, s string")
    rows = suffix_dedup.without_repeats(df, length=12, hot=hot).select("n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, rows)) == sorted(B.repeats(texts, 12))


def test_collection_bwt():
    import random
    import tempfile
    random.seed(1)
    for _ in range(60):
        st = [bytes(random.choice(b"abc") for _ in range(random.randint(0, 20))) for _ in range(random.randint(1, 6))]
        with tempfile.TemporaryDirectory() as f:
            bwt, lcp = suffix_dedup.collection_bwt([np.frombuffer(x, np.uint8) for x in st], suffix_dedup._Files(f), 99)
        suf = sorted(([*s[i:], k - 1000], k, i) for k, s in enumerate(st) for i in range(len(s) + 1))
        assert bwt.tolist() == [st[k][i - 1] + 1 if i else 0 for _, k, i in suf]
        for (a, _, _), (b, _, _), n in zip(suf, suf[1:], lcp.tolist()[1:]):
            assert a[:n] == b[:n] and a[n] != b[n] and min(a[:n], default=0) >= 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want, got = con.sql(queries.ORACLE[name]), queries.QUERIES[name](spark, SF)
    assert sorted(want.columns) == sorted(got.columns)
    cols = ", ".join(sorted(want.columns))
    assert sorted(want.project(cols).fetchall()) == sorted(map(tuple, got.select(sorted(got.columns)).collect()))


def test_quality_cases(docs, empty):
    rows = quality.quality_verdicts(docs).collect()
    assert len(rows) == len(CASES) and not next(r for r in rows if r["doc_id"] == 1)["kept"]
    assert quality.quality_verdicts(empty).count() == 0


@pytest.mark.parametrize("name", ["op5_pii", "op8_quality"])
def test_native_plans(spark, name):
    """The operators marked native run no Python and no RDD code, and join on keys only."""
    p = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "Arrow", "Pandas", "InPandas", "ExistingRDD", "SerializeFromObject", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, bad


def test_line_cases(docs, empty):
    rows = collections.defaultdict(list)
    for r in line_dedup.dedupe_lines(docs, batches=3).collect():
        rows[r["row"]["doc_id"]].append((r["n_lines"], r["n_dropped"], r["text"]))
    assert rows[1] == [(1, 0, None)] and rows[2] == [(1, 0, "")] and rows[None] == [(2, 2, "")]
    assert rows[6] == [(3, 0, CASES[7][1])] and rows[4][0][1] == 0 and rows[5] == [(2, 2, "")]
    assert rows[3] == [(1, 0, CASES[2][1])] * 2
    assert line_dedup.dedupe_lines(empty).count() == 0


def test_tiles():
    ids = lambda s: np.array([ord(c) for c in s], np.int64)
    assert decontam.tile(ids("xxABCDEFyy"), ids("ABCDEF"), 3) == [(2, 0, 6)]
    assert sorted(decontam.tile(ids("DEFG..ABC"), ids("ABCDEFG"), 3)) == [(0, 3, 4), (6, 0, 3)]
    assert decontam.tile(ids("ABC"), ids("XYZ"), 3) == []


@pytest.mark.parametrize("chars", [10**7, 0])
def test_contaminated(spark, docs, empty, chars):
    items = spark.createDataFrame([(10, "one TWO three, four five six seven eight nine ten"), (11, "six seven eight nine ten one two three four five"),
                                   (12, "one two"), (13, None), (None, "alpha beta gamma delta alpha beta")], "item_id long, text string")
    got = decontam.contaminated(docs, items, broadcast_chars=chars).collect()
    assert sorted((r["doc_id"], r["item_id"] or 0, r["coverage"]) for r in got) == [
        (3, 10, 1.0), (3, 10, 1.0), (3, 11, 1.0), (3, 11, 1.0), (4, 0, 1.0), (5, 0, 1.0)]
    left = decontam.without_contaminated(docs, items, broadcast_chars=chars)
    assert left.columns == docs.columns and left.count() == len(CASES) - 4
    assert decontam.contaminated(empty, items, broadcast_chars=chars).count() == 0


@pytest.mark.parametrize("chars", [10**7, 0])
def test_only_the_contaminated_row_of_an_id_goes(spark, chars):
    leak, clean = "Say: one two three four five six seven.", "nothing of the kind is in here at all"
    docs = spark.createDataFrame([(None, leak), (None, clean), (None, None), (5, leak), (5, clean), (5, clean)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    left = decontam.without_contaminated(docs, items, broadcast_chars=chars).collect()
    assert sorted(map(str, left)) == sorted(map(str, docs.where("text IS NULL OR text LIKE 'nothing%'").collect()))
    assert decontam.contaminated(docs, items, broadcast_chars=chars).count() == 2


@pytest.mark.parametrize("chars", [10**7, 0])
def test_items_in_scripts_without_blanks(spark, chars):
    assert decontam.tokens("Ab_1 東京tower は、x") == ["ab_1", "東", "京", "tower", "は", "x"]
    docs = spark.createDataFrame([(1, "前文。日本の首都はどこですか?答え"), (2, "日本の山はどれほど高いのだろう")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "日本の首都はどこですか")], "item_id long, text string")
    got = decontam.contaminated(docs, items, broadcast_chars=chars).collect()
    assert [(r["doc_id"], r["item_id"], r["coverage"]) for r in got] == [(1, 7, 1.0)]


def test_empty_tables(empty, docs, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert mixing.mix(empty).count() == 0 and language.identify(empty).count() == 0
    assert toxicity.toxicity(empty, labels).count() == 0
    assert {r["predicted"] for r in toxicity.toxicity(docs, labels).collect()} == {0}
    assert mixing.mix(docs).count() == language.identify(docs).count() == len(CASES)


def test_pipeline(spark):
    import corpus_pipeline as P
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = table
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == table.columns, name
        docs = spark.createDataFrame(after.collect(), table.schema)
        if name == "simhash":
            fps = [(r["doc_id"], B.fingerprint(r["text"])) for r in docs.collect()]
            assert len(set(B.components(fps).values())) == len(fps)
    mixed = P.STAGES[-1][1](spark, docs, SF).collect()
    assert len(mixed) == docs.count() > 0.5 * table.count()
    assert sorted(map(tuple, mixed)) == sorted(map(tuple, P.run(spark, SF).collect()))
