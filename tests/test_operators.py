import gzip
import json
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gristmill.functions import langs, texts, urls
from gristmill.operators import annotate, batching, components, dedup, ingest, minhash, registers, robots, routing, stats
from gristmill.plans import reference
from gristmill.sources import readers, writers
from gristmill.streaming import records


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def test_reasons(spark):
    cases = [
        ("a b c d e", False, False, "word_avg_5"), ("a b c d e f", False, False, "length_500"), ("", False, False, "word_avg_5"),
        ("a b c d e f" + "x" * 489, False, False, "length_500"), ("a b c d e f" + "x" * 490, False, False, "keep"),
        ("十" * 10, True, False, "char_avg_10"), ("a", True, True, "adult_ut1"), (None, False, False, "keep"),
    ]
    frame = spark.createDataFrame(cases, "text string, cjk boolean, adult boolean, want string")
    got = frame.select("want", annotate.filter_reason(F.col("text"), F.col("cjk"), F.col("adult")).alias("got")).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_urls(spark):
    for url, host, key in (
        ("https://www.a.b.com:80/x", "a.b.com", "a.b.com:80/x"), ("http://u@b.com/p", "b.com", "u@b.com/p"), ("HTTPS://WWW.X.org/", "X.org", "HTTPS://WWW.X.org/"),
    ):
        assert one(spark, urls.host(F.lit(url))) == host
        assert one(spark, urls.strip_prefix(F.lit(url))) == key
    assert [one(spark, urls.adult_pattern(F.lit(u))) for u in ("http://youtube.com/", "http://Essex.gov/", "http://SEX.org/")] == [True, True, False]


def test_robots_rules(spark):
    cases = [
        ([("e.com/a", False)], "e.com/abc", True), ([("e.com/a$", False)], "e.com/abc", False), ([("e.com/*.pdf", False)], "e.com/x/y.pdf?z", True),
        ([("e.com/*.pdf$", False)], "e.com/x/y.pdf?z", False), ([("e.com/a", False), ("e.com/ab", True)], "e.com/abc", False), ([("e.com/ab", True), ("e.com/a", False)], "e.com/abc", True),
    ]
    for rules, url, want in cases:
        frame = spark.createDataFrame([("f", i, p, a) for i, (p, a) in enumerate(rules)], "u string, rule_idx int, pattern string, allowed boolean")
        pages = spark.createDataFrame([("http://www." + url,)], "url string")
        assert (robots.disallowed_urls(pages, frame).count() == 1) is want


def test_clean_takes_five_and_a_missing_allowed(spark):
    frame = spark.createDataFrame(
        [(1, "keep", True, [5.0]), (2, "keep", None, [9.0]), (3, "keep", False, [9.0]), (4, "keep", True, [4.9]), (5, "keep", True, None), (6, "length_500", True, [9.0])],
        "i int, filter string, allowed boolean, doc_scores array<double>",
    )
    assert sorted(r["i"] for r in annotate.clean(frame).collect()) == [1, 2]


def test_merge_drops_empty_and_doubtful(spark):
    meta = spark.createDataFrame([(i, f"u{i}") for i in range(5)], "line_no long, u string")
    text = spark.createDataFrame([(0, "a"), (1, "b"), (2, ""), (3, "c"), (4, "d")], "line_no long, t string")
    lang = spark.createDataFrame([(0, ["en"], [0.5]), (1, ["en"], [0.5001]), (2, ["en"], [0.9]), (3, [], [0.9]), (4, None, None)], "line_no long, lang array<string>, prob array<double>")
    assert [r["line_no"] for r in ingest.merge_sources(meta, text, lang, "c").collect()] == [1]


def test_exact_dedup_and_report(spark):
    frame = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (4, "x "), (5, None), (6, None)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in dedup.exact_dedup(frame).collect()) == [1, 2, 4, 5]
    assert sorted(r["copies"] for r in dedup.exact_dup_report(frame).collect()) == [2, 3]


CLASH = ["component", "cluster_size", "batch", "id", "key", "scope", "band", "n"]


def messy(spark):
    """Repeated ids and rows, null ids and texts, an empty and a very long text, columns with names used inside."""
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (3, None), (4, None), (5, ""), (6, ""), (None, "a b c d"), (None, None), (7, long), (8, long), (9, "x y"), (9, "other words")]
    return spark.createDataFrame([(i, t, *["x"] * len(CLASH)) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASH))


def ids(frame):
    return sorted((r["doc_id"] is None, r["doc_id"]) for r in frame.collect())


def test_dedup_of_messy_rows(spark):
    docs = messy(spark)
    kept = dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert [i for _, i in ids(kept)] == [1, 3, 5, 7, 9, 9, None, None]
    found = minhash.find_components(docs)
    assert {r["doc_id"]: r["component"] for r in found.collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 7, 9: 9}
    near = dedup.near_dedup(docs, found, add_cluster_size=True)
    assert [i for _, i in ids(near)] == [1, 1, 3, 4, 5, 6, 7, 9, 9, None, None]
    assert {r["doc_id"]: r["cluster_size"] for r in near.collect()} == {1: 2, 3: 1, 4: 1, 5: 1, 6: 1, 7: 2, 9: 1, None: 1}
    assert [i for _, i in ids(dedup.near_dedup(docs, found, duplicates_only=True))] == [2, 8]
    none = docs.limit(0)
    assert dedup.exact_dedup(none).count() == 0 and dedup.near_dedup(none, minhash.find_components(none)).count() == 0


def test_signatures_equal_the_expressions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("n_chars < 2000")
    a, b = zip(*minhash.coefficients(20))
    for how in ("whitespace", "char", "vectorizer"):
        want = docs.select("doc_id", minhash.hashed_tokens(F.col("text"), how).alias("h")).collect()
        got = {r["doc_id"]: r["sig"] for r in minhash.minhash_signature(docs, 20, how).collect()}
        for r in want:
            assert got[r["doc_id"]] == ([min((x * h + y) % minhash.PRIME for h in r["h"]) for x, y in zip(a, b)] if r["h"] else None)


def test_what_a_signer_holds_is_bounded():
    """A batch of any size is signed in slices, without loss; long tokens aren't remembered."""
    rows = [(i, None if i % 7 == 0 else "" if i % 7 == 1 else f"text {i} " + "word " * (i % 500)) for i in range(3000)] + [(3000, "x " * minhash.SLICE)]
    batch = pa.RecordBatch.from_pydict({"id": [r[0] for r in rows], "text": pa.array([r[1] for r in rows])})
    parts = list(minhash._pieces([batch, batch.slice(0, 0)]))
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    assert all(p.num_rows <= minhash.SIGNED and sum(len(t or "") for t in p.column(1).to_pylist()[:-1]) < minhash.SLICE for p in parts)
    sign = minhash.Signer(20, "whitespace", 3)
    text = " ".join(f"{i:0100d}" for i in range(50))
    assert list(sign(text + " a b")) == list(minhash.Signer(20, "whitespace", 3)("b a " + text)) and set(sign.memo) == {"a", "b"}


@pytest.mark.parametrize("kind", [pa.int64(), pa.int32(), pa.string()])
def test_components_of_a_task(kind):
    """Chains, stars and random edges, against hanging one edge after the other; numbers take arrays alone."""
    rng = random.Random(4)
    chain, star = [(i, i + 1) for i in range(1000, 3000)], [(9999, i) for i in range(4000, 4400)]
    for edges in ([], [(2, 1)], chain + star, rng.sample(chain, 900), [(rng.randrange(-3000, 3000), rng.randrange(-3000, 3000)) for _ in range(2500)]):
        named = lambda x: f"{x:06d}" if kind == pa.string() else x
        edges = [(named(max(e)), named(min(e))) for e in edges if e[0] != e[1]]
        want = {x: x for e in edges for x in e}
        for a, b in edges:
            a, b = sorted((want[a], want[b]))
            if a != b:
                want = {x: a if c == b else c for x, c in want.items()}
        got = components._solve(pa.table({"u": pa.array([e[0] for e in edges], kind), "v": pa.array([e[1] for e in edges], kind)}))
        assert dict(zip(*(got.column(c).to_pylist() for c in ("node", "component")))) == want and got.num_rows == len(want) and got.schema.types == [kind, kind]


def test_components_of_many_edges_take_little_memory():
    tracemalloc.start()
    components._solve(pa.table({"u": np.arange(1, 200_001), "v": np.arange(200_000) // 3}))
    assert tracemalloc.get_traced_memory()[1] < 30e6  # 100 bytes an edge and more with lists and dictionaries
    tracemalloc.stop()


def test_finder_of_secrets_holds_their_beginnings_alone():
    """Against looking for each word; words that share beginnings, are one another's parts, and are shorter than a beginning."""
    rng = random.Random(9)
    some = lambda least, most: "".join(rng.choice("aäb日") for _ in range(rng.randint(least, most)))
    for least, most in ((1, 3), (5, 9), (6, 12), (9, 14)):
        words = list({some(least, most) for _ in range(20)})
        finder, texts_ = annotate.Finder(words), ["", *(some(0, 40) for _ in range(300)), *(some(0, 9) + w[: rng.choice([len(w) - 1, len(w)])] + some(0, 9) for w in words)]
        assert [finder(t) for t in texts_] == [any(w in t for w in words) for t in texts_]
    assert annotate.Finder([f"{i:040d}"[::-1] for i in range(20_000)]).machine.get_stats()["nodes_count"] < 30_000 + 20_000 * annotate.BEGINNING
    same = annotate.Finder([f"secret_{i:030d}" for i in range(20_000)])  # one beginning for all
    assert same.machine.get_stats()["nodes_count"] < 20 and same("secret_" * 20_000 + f"secret_{7:030d}") and not same("secret_" * 20_000)


def test_edges_sign_texts_once(spark, sf_dir):
    signed = reference.QUERIES["near_dup_edges"](spark, sf_dir)
    assert "MapInArrow" not in signed._jdf.queryExecution().executedPlan().toString()  # it is written before; both sides of the join had it
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = minhash.near_dup_edges(minhash.lsh_bands(minhash.minhash_signature(docs)))
    assert sorted(signed.collect()) == sorted(want.collect()) and signed.count() > 0


def test_near_dedup_reads_texts_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = minhash.minhash_signature(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert "MapInArrow" not in dedup.near_dedup(docs, minhash.find_components(docs))._jdf.queryExecution().executedPlan().toString()


def test_no_text_is_shuffled_for_batches(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = batching.assign_batches(docs.select("doc_id", "source", "text"), 1000, "source").select("doc_id", "batch")._jdf.queryExecution().executedPlan().toString()
    assert not any("text" in line for line in plan.split("\n") if "Exchange" in line)


def test_batches_of_messy_rows(spark):
    rows = [("a", 1, 5), ("a", 1, 5), ("a", None, 3), (None, 2, 9), ("a", 2, None), ("b", 3, 20)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "g string, i int, s long, batch string, __p string")
    for work in (batching.pack_files, batching.rotate_batches):
        got = sorted((str(r["g"]), str(r["i"]), r["batch"]) for r in work(frame, "g", "i", "s", 10).collect())
        assert got == [("None", "2", 1), ("a", "1", 2 if work is batching.pack_files else 1), ("a", "1", 2 if work is batching.pack_files else 1), ("a", "2", 2), ("a", "None", 1), ("b", "3", 1)]
        assert work(frame.limit(0), "g", "i", "s", 10).count() == 0
    texts_of = frame.withColumn("text", F.expr("repeat('x', cast(s as int))")).drop("batch")
    got = sorted((str(r["g"]), str(r["i"]), r["batch"]) for r in batching.assign_batches(texts_of, 10, "g", "i").collect())
    assert got == [("None", "2", 1), ("a", "1", 1), ("a", "1", 1), ("a", "2", 2), ("a", "None", 1), ("b", "3", 1)]


def test_lines_of_files_are_merged(spark, tmp_path):
    import zstandard

    for part in ("one", "two"):
        (tmp_path / part).mkdir()
        for name, lines in (
            ("metadata", [json.dumps({"u": f"{part}{i}"}) if i != 2 else '{"u": "\ufffd"}' for i in range(40)]), ("text", [json.dumps({"t": f"{part} {i}" if i != 5 else ""}) for i in range(40)]),
            ("lang", [json.dumps({"lang": ["eng_Latn"] if i != 7 else [], "prob": [0.9 if i != 9 else 0.1]}) for i in range(40)]),
        ):
            (tmp_path / part / f"{name}.jsonl.zst").write_bytes(zstandard.ZstdCompressor().compress("\n".join(lines).encode()))
    read = lambda name, schema: readers.numbered_json(spark, f"{tmp_path}/*/{name}.jsonl.zst", schema)
    merged = ingest.merge_sources(read("metadata", "u string"), read("text", "t string"), read("lang", "lang array<string>, prob array<double>"), "c")
    got = merged.collect()
    assert len(got) == 72 and all(r["text"] == f"{r['u'][:3]} {r['line_no']}" and r["u"] == f"{r['u'][:3]}{r['line_no']}" for r in got)
    (tmp_path / "plain.txt").write_text("\n".join(map(str, range(5000))))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        lines = readers.numbered_lines(spark, f"{tmp_path}/plain.txt")
        assert lines.rdd.getNumPartitions() > 1 and all(int(r["value"]) == r["line_no"] for r in lines.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_segments_keep_their_places(spark):
    rows = spark.createDataFrame([("u1", 0, "This is a test", "en"), ("u1", 1, None, "en"), ("u1", 2, "More Sentences", "en"), ("u2", 0, "Second document", "es")], "url string, k int, text string, lang string")
    got = {r["url"]: (r["text"], r["langs"]) for r in ingest.group_segments(rows, "url", "k", "text", ("lang",)).collect()}
    assert got == {"u1": ("This is a test\n\nMore Sentences", ["en", "en", "en"]), "u2": ("Second document", ["es"])}
    docs = spark.createDataFrame([(1, None), (2, "a\ufffd"), (3, "b")], "i int, text string")
    assert sorted(r["i"] for r in ingest.take_external(docs).collect()) == [1, 3]


def test_two_letter_codes_are_those_of_the_jvm(spark):
    locale = spark._jvm.java.util.Locale
    known = {}
    for two in locale.getISOLanguages():
        found = locale.forLanguageTag(two)
        known[found.getISO3Language()] = {"iw": "he", "ji": "yi", "in": "id"}.get(two, two)  # as they were once
    assert len(langs.TWO_LETTER) > 180
    for three, two in langs.TWO_LETTER.items():
        assert known.get(three, two) == two, three


def test_components_of_a_known_graph(spark):
    edges = spark.createDataFrame([(0, 1), (1, 7), (7, 10), (15, 10), (16, 15), (17, 16), (3, 3), (None, 4), (0, 1)], "src long, dst long")
    found = {r["node"]: r["component"] for r in components.connected_components(edges).collect()}
    assert found == dict.fromkeys((0, 1, 7, 10, 15, 16, 17), 0)
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "src long, dst long")
    for few in (0, 1000):
        assert {r["component"] for r in components.connected_components(chain, few=few).collect()} == {0}
        assert {r["node"]: r["component"] for r in components.connected_components(edges, few=few).collect()} == found
    assert components.connected_components(edges.limit(0)).count() == 0


def test_tokenizers(spark):
    assert sorted(one(spark, texts.whitespace_tokens(F.lit("A  b\nA")))) == ["a", "b"]
    assert one(spark, texts.char_tokens(F.lit("abcdefg"))) == ["abc", "def", "g"]
    assert one(spark, texts.char_tokens(F.lit(""))) == []


def test_near_dedup_is_idempotent_and_counts_all(spark):
    words = [f"w{i}" for i in range(200)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words)), (3, " ".join(words[:-1])), (4, "other text here"), (5, ""), (6, None)], "doc_id long, text string")
    found = minhash.find_components(docs)
    kept = dedup.near_dedup(docs, found, add_cluster_size=True)
    sizes = {r["doc_id"]: r["cluster_size"] for r in kept.collect()}
    assert sizes == {1: 3, 4: 1, 5: 1, 6: 1}
    assert dedup.near_dedup(kept, minhash.find_components(kept)).count() == 4
    assert minhash.find_components(docs.limit(0)).count() == 0


def test_language_codes(spark):
    want = {"cmn_Hans": "zho_Hans", "pes_Arab": "fas_Arab", "zsm_Latn": "msa_Latn", "swa_Latn": "swh_Latn", "ary_Arab": "arb_Arab", "ltg_Latn": "lav_Latn", "und": "und", "fra_Latn": "fra_Latn"}
    assert {k: one(spark, langs.score_lang(F.lit(k))) for k in want} == want


def test_routing_strict(spark):
    labels = spark.createDataFrame([("a", "A")], "flores_code string, canonical string")
    docs = spark.createDataFrame([(1, ["a"], [0.9]), (2, ["a"], [0.4]), (3, ["b"], [0.9])], "i int, lang array<string>, prob array<double>")
    assert {r["i"]: r["label"] for r in routing.route_language(docs, labels).collect()} == {1: "A", 2: "unk", 3: "unk"}
    with pytest.raises(Exception, match="unknown language"):
        routing.route_language(docs, labels, strict=True).collect()


def test_fix_and_spans(spark):
    assert one(spark, texts.fix_text(F.lit("cafÃ© <b>x</b>\n“y”"))) == 'café x\n"y"'
    text = "😀 a@b.com and 10.0.0.1"
    spans = [(s["start"], s["end"]) for s in one(spark, texts.pii_spans(F.lit(text)))]
    assert [text[a:b] for a, b in spans] == ["a@b.com", "10.0.0.1"]
    for text, want in (("x1.2.3.4 1.2.3.4", [(9, 16)]), ("1.2.3.4 and 1.2.3.4", [(0, 7), (12, 19)]), ("", []), ("none", [])):
        assert [(s["start"], s["end"]) for s in one(spark, texts.pii_spans(F.lit(text)))] == want
    assert one(spark, texts.pii_spans(F.lit(None).cast("string"))) is None


def test_secrets(spark):
    docs = spark.createDataFrame([(1, 'token = "0123456789ab"'), (2, "has 0123456789ab inside"), (3, "clean"), (4, None)], "doc_id long, text string")
    secrets = annotate.list_secrets(docs)
    assert [r["secret"] for r in secrets.collect()] == ["0123456789ab"]
    assert sorted(r["doc_id"] for r in annotate.drop_secrets(docs, secrets).collect()) == [3, 4]


def test_secrets_in_turns_and_messy_rows(spark):
    docs = messy(spark)
    secrets = spark.createDataFrame([("a b",), ("w29999",), ("",), (None,), ("nowhere",), ("a b",)], "secret string")
    for most in (1, 2, 100):
        left = annotate.drop_secrets(docs, secrets, most=most)
        assert left.columns == docs.columns and [i for _, i in ids(left)] == [3, 4, 5, 6, 9, 9, None]
    assert annotate.drop_secrets(docs, secrets.limit(0)).count() == docs.count()
    assert annotate.drop_secrets(docs.limit(0), secrets).count() == 0


def test_annotation_of_messy_rows_with_a_list(spark):
    docs = messy(spark).withColumn("u", F.when(F.col("doc_id") == 1, "http://x.bad.org/").when(F.col("doc_id") == 2, "http://ok.org/sex")).withColumn("lang", F.lit("eng_Latn"))
    bad = spark.createDataFrame([("bad.org",), ("bad.org",), (None,)], "domain string")
    for extended in (False, True):
        got = annotate.annotate(docs, domains=bad, extended=extended)
        assert set(docs.columns) < set(got.columns) and got.count() == docs.count()
        reasons = {r["doc_id"]: r["filter"] for r in got.collect()}
        assert reasons[1] == "adult_ut1" and reasons[2] == ("adult_ut1" if extended else "word_avg_5") and reasons[7] == "keep" and reasons[3] == "keep"
    assert annotate.annotate(docs.limit(0), domains=bad).count() == 0
    assert annotate.clean(annotate.annotate(docs), 0.0).where("text is null").count() == 0


def test_robots_and_routing_of_messy_rows(spark):
    body = "User-agent: *\nDisallow: /a\n"
    docs = spark.createDataFrame([("http://h.org/robots.txt", body, "x"), ("http://h.org/robots.txt", body, "y"), ("http://h.org/robots.txt", body.replace("/a", "/b"), "x"), (None, body, "x"), ("http://e.org/robots.txt", None, "x"), ("http://e.org/robots.txt", "", "x")], "u string, p string, host string")
    rules = robots.parse_robots(docs)
    assert sorted(r["pattern"] for r in rules.collect()) == ["h.org/a", "h.org/b"] and robots.parse_robots(docs.limit(0)).count() == 0
    pages = spark.createDataFrame([(1, "http://h.org/a1", "x"), (1, "http://h.org/a1", "x"), (None, None, "x"), (2, "http://h.org/" + "c" * 100_000, "x")], "i int, url string, allowed string")
    gone = robots.disallowed_urls(pages, rules)
    assert [r["url"] for r in gone.collect()] == ["h.org/a1"]
    got = robots.annotate_robots(pages, gone)
    assert set(got.columns) == set(pages.columns) and sorted((str(r["i"]), r["allowed"]) for r in got.collect()) == [("1", False), ("1", False), ("2", True), ("None", True)]
    assert robots.annotate_robots(pages, gone.limit(0)).where("allowed").count() == 4 and robots.filter_disallowed(pages, gone).count() == 2
    labels = spark.createDataFrame([("a", "B"), ("a", "A"), (None, "C")], "flores_code string, canonical string")
    routed = spark.createDataFrame([(1, ["a"], [0.9], "x"), (1, ["a"], [0.9], "x"), (2, [], [], "x"), (3, None, None, "x"), (4, ["a"], None, "x")], "i int, lang array<string>, prob array<double>, label string")
    assert sorted((r["i"], r["label"]) for r in routing.route_language(routed, labels).collect()) == [(1, "A"), (1, "A"), (2, "unk"), (3, "unk"), (4, "A")]
    assert routing.route_language(routed.limit(0), labels).count() == 0 and routing.route_language(routed, labels.limit(0)).where("label = 'unk'").count() == 5


def test_registers_of_messy_rows(spark):
    docs = messy(spark).withColumn("web_register", F.lit("old"))
    got = registers.baseline_registers(docs)
    assert got.columns == docs.columns and got.count() == docs.count() and registers.baseline_registers(docs.limit(0)).count() == 0
    labelled = registers.web_registers(docs, lambda: lambda batch: [{"n": len(t) / 3} for t in batch])
    assert all(r["web_register"] == {"n": round(len(r["text"] or "") / 3, 3)} for r in labelled.collect())


def test_packing(spark):
    files = spark.createDataFrame([("a", i, s) for i, s in enumerate((6, 3, 4, 20, 1))], "g string, i int, s long")
    packed = {r["i"]: r["batch"] for r in batching.pack_files(files, "g", "i", "s", 10).collect()}
    assert packed == {0: 1, 1: 1, 2: 2, 3: 3, 4: 4}
    rotated = {r["i"]: r["batch"] for r in batching.rotate_batches(files, "g", "i", "s", 10).collect()}
    assert rotated == {0: 1, 1: 1, 2: 1, 3: 2, 4: 3}


def test_registers_with_a_model(spark):
    docs = spark.createDataFrame([("x", "eng_Latn"), ("y", "zzz_Latn")], "text string, lang string")
    got = registers.web_registers(docs, lambda: lambda batch: [{"a": 0.12345} for _ in batch], lang_col="lang").collect()
    assert [r["web_register"] for r in got] == [{"a": 0.123}, None]


def test_stats(spark):
    frame = spark.createDataFrame([("en", "keep"), ("en", "length_500"), ("en", "keep"), ("de", "keep")], "lang string, filter string")
    table = {r["lang"]: r.asDict() for r in stats.stats_table(stats.filter_stats(frame, ("lang",))).collect()}
    assert table["en"]["keep"] == "66.67%" and table["de"]["length_500"] == ""


def test_sources(spark, tmp_path):
    (tmp_path / "d.jsonl").write_text(json.dumps({"text": "t", "u": "http://a/", "openlid-v3": {"lang": ["en"], "prob": [0.9]}, "htmllang": ["x"]}) + "\n")
    row = readers.read_jsonl(spark, str(tmp_path / "d.jsonl")).first()
    assert row["openlid_v3"]["lang"] == ["en"] and row["html_lang"] == ["x"] and row["xml"] is None
    (tmp_path / "rules.tsv").write_text("e.com/a\t0\ne.com/b\t1\n")
    assert [(r["pattern"], r["allowed"]) for r in readers.read_rules(spark, str(tmp_path / "rules.tsv")).orderBy("rule_idx").collect()] == [("e.com/a", False), ("e.com/b", True)]
    (tmp_path / "c.txt").write_text("3\n0 0 2 \n3\n0 1 1 \n")
    assert {r["component"] for r in dedup.merge_clusterings(readers.read_clusters(spark, str(tmp_path / "c.txt"))).collect()} == {0}
    body = b"HTTP/1.1 200 OK\r\n\r\nUser-agent: *\nDisallow: /x"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://h.org/robots.txt\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    (tmp_path / "r.warc.gz").write_bytes(gzip.compress(record))
    rules = robots.parse_robots(readers.read_robots_warc(spark, str(tmp_path / "r.warc.gz"))).collect()
    assert [(r["pattern"], r["allowed"]) for r in rules] == [("h.org/x", False)]


def test_writers(spark, tmp_path):
    docs = spark.createDataFrame([(i, "en" if i % 3 else "de") for i in range(20)], "doc_id long, label string")
    writers.write_by_language(docs, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).where("label = 'de'").count() == 7
    writers.write_stage(docs, str(tmp_path / "stage"))
    writers.write_stage(docs.limit(0), str(tmp_path / "stage"))
    assert spark.read.parquet(str(tmp_path / "stage")).count() == 20
    (tmp_path / "stage" / "_SUCCESS").unlink()  # as after a crash
    writers.write_stage(docs.limit(3), str(tmp_path / "stage"))
    assert spark.read.parquet(str(tmp_path / "stage")).count() == 3
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_by_language(docs, str(tmp_path / "many"), task_bytes=64)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(str(tmp_path / "many")).count() == 20 and len(list((tmp_path / "many" / "label=en").glob("*.parquet"))) > 1
    writers.write_sidecar(docs.withColumn("allowed", F.col("doc_id") % 2 == 0), str(tmp_path / "side"), order="doc_id")
    assert [r["allowed"] for r in spark.read.json(str(tmp_path / "side")).collect()][:3] == [True, False, True]


def test_stream(spark, tmp_path, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.write.parquet(str(tmp_path / "in"))
    stream = records.annotate_stream(records.read_documents(spark, str(tmp_path / "in"), docs.schema))
    records.write_documents(stream.select("doc_id", "filter"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    want = annotate.clean(annotate.annotate(docs), 0.0).count()
    assert spark.read.parquet(str(tmp_path / "out")).count() == want > 0
