import datetime
import itertools
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from gristmill.llm import bpe, encoding, fingerprints, html_extract, line_dedup, mixing, ngram_join, quality, queries, token_counts, toxicity, url_filters
from gristmill.llm.words import fold, hash_words, shingles

from .conftest import LONG, ROWS, TEXT


@pytest.fixture(scope="module")
def tok():
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.parse_ranks(bpe.read_vocab()), special_tokens={})


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(name, same_as_sql):
    assert same_as_sql(queries.QUERIES[name], queries.ORACLE[name]) > 0


# 1: BPE


def test_encoding_is_exact_and_shares_chunks(documents, tok):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    got = encoding.encode_documents(documents).collect()
    assert len(got) == len(texts) and sum(r["n_shared"] for r in got) > 0
    for r in got:
        assert r["round_trip"] and r["token_ids"] == tok.encode_ordinary(texts[r["doc_id"]]) and r["n_tokens"] == len(r["token_ids"])


def test_encoding_of_messy_rows(spark, messy, nothing, tok):
    encoded = encoding.encode_documents(messy)
    assert sorted((str(r["doc_id"]), str(r["token_ids"])) for r in encoded.collect()) == sorted((str(r[0]), str(None if r[1] is None else tok.encode_ordinary(r[1]))) for r in ROWS)
    back = encoding.decode_documents(encoded)
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter((r[0], r[1]) for r in ROWS)
    assert encoding.encode_documents(nothing).count() == 0


def test_joins_are_exact_wherever_chunks_are_given(tok):
    encode = bpe.Encoder(bpe.read_vocab())
    rng = random.Random(3)
    for _ in range(150):
        text = "".join(rng.choice(["a", "b ", " the", "  ", "\n", "é", "12", "!?", "word", " word", "'s", "😀"]) for _ in range(400)).encode()
        edges = encoding.chunk_edges(text)
        shared = {encoding.chunk_key(text[a:b]): encode(text[a:b]).tobytes() for a, b in zip(edges, edges[1:]) if rng.random() < 0.7}
        assert encoding.encode_with(text, shared, encode).tolist() == tok.encode_ordinary(text.decode())


# 2: token counts


def test_counts_equal_the_tokenizer(documents, messy, nothing, tok):
    for docs in (documents, messy):
        want = Counter((r["doc_id"], None if r["text"] is None else len(tok.encode_ordinary(r["text"]))) for r in docs.select("doc_id", "text").collect())
        assert Counter((r["doc_id"], r["n_tokens"]) for r in token_counts.count_tokens(docs).collect()) == want
    assert token_counts.count_tokens(nothing).count() == 0


# 3: toxicity


def test_folding_and_exceptions():
    lexicon = toxicity.Lexicon({"idiot": 7.0, "stupid": 6.0, "loser": 6.0, "trash": 6.0}, {"reeux": 2.0})
    for text, hits in (
        ("You idiot!", 1), ("1d1ot", 1), ("ѕtuріd", 1), ("$tupid", 1), ("l0ser 1oser", 2), ("st​upid", 1), ("ídiot", 1), ("ｉｄｉｏｔ", 1), ("trash can", 0), ("trash  can trash", 1),
        ("réeuxabc", 1), ("xréeux", 0), ("idiotic", 0), ("", 0), ("sixty 101 $5", 0),
    ):
        assert lexicon.score(text)[1] == hits, text
    long = "fine words " * 5000 + "idiot"
    assert lexicon.score(long)[2] < lexicon.score("an idiot")[2]
    assert toxicity.Lexicon({}, {}, ()).score("idiot") == (1, 0, 0.0, [])


def test_exceptions_against_brute_force():
    lexicon = toxicity.Lexicon({"trash": 6.0, "clown": 5.0, "loser": 4.0}, {}, ("trash can", "class clown", "sore loser", "clown car crash"))
    rng = random.Random(2)
    for _ in range(300):
        text = " ".join(rng.choice(["trash", "can", "class", "clown", "sore", "loser", "car", "crash", "ok"]) for _ in range(12))
        words, want, at = text.split(), 0, 0
        places = []
        for w in words:
            places.append((at, at + len(w)))
            at += len(w) + 1
        safe = [(m, m + len(x)) for x in lexicon.exceptions for m in range(len(text)) if text.startswith(x, m) and (m == 0 or text[m - 1] == " ") and (m + len(x) == len(text) or text[m + len(x)] == " ")]
        for w, (a, b) in zip(words, places):
            want += w in lexicon.words and not any(x <= a and b <= y for x, y in safe)
        assert lexicon.score(text)[1] == want, text


def test_long_texts_take_linear_time():
    began = time.time()
    assert toxicity.Lexicon(toxicity.BASE_LEXICON).score("trash can " * 100_000)[1] == 0
    pages = ("<a \"" * 250_000, "<script" * 140_000, "<div>" * 200_000, "<div>x" * 100_000 + "</div>" * 100_000, "<div>" * 20_000 + "</p>" * 200_000, '<a " > " ' * 110_000, "<![CDATA[" * 110_000, "<!" * 500_000, "<!-- " * 200_000)
    for page in pages:
        html_extract.smooth_edges(html_extract.blocks_of(page))
    assert time.time() - began < 2 * (len(pages) + 1)


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    learned, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "truth")
    got = toxicity.score_toxicity(docs, toxicity.fit_lexicon(docs, learned)).join(held, "doc_id").groupBy("truth", "toxic").count().collect()
    n = {(r["truth"], r["toxic"]): r["count"] for r in got}
    assert n[1, True] / (n[1, True] + n[1, False]) >= 0.9
    assert n[0, True] / (n[0, True] + n[0, False]) <= 0.005


def test_toxicity_of_messy_rows(spark, messy, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(1, 1), (None, 1), (3, None), (2, 0), (2, 1)], "doc_id long, toxic int"), None):
        rows = toxicity.score_toxicity(messy, toxicity.fit_lexicon(messy, labels)).collect()
        assert len(rows) == len(ROWS) and not any(r["toxic"] for r in rows)
        assert all((r["score"] is None) == (r["n_words"] is None) for r in rows) and sum(r["score"] is None for r in rows) == 2
    assert toxicity.score_toxicity(nothing, toxicity.fit_lexicon(nothing, none)).count() == 0


# 4: URL filters


def brute_hit(url, day, events):
    """(entry, category) that decides, by comparing with every entry."""

    def parts_of(rest):
        host, _, path = rest.partition("/")
        return host.lower(), [x for x in path.split("/") if x]

    active = defaultdict(list)
    for entry, category, action, at in sorted(events, key=lambda e: (e[3], e[2])):
        host, parts = parts_of(entry)
        log = active[host, tuple(parts), category]
        if action == "add" and (not log or log[-1][1] is not None):
            log.append([at, None])
        elif action == "remove" and log and log[-1][1] is None:
            log[-1][1] = at
    host, parts = parts_of(url.split("://")[-1].split("?")[0].split("#")[0])
    hits = []
    for (name, prefix, category), spans in active.items():
        if (host == name or host.endswith("." + name)) and tuple(parts[: len(prefix)]) == prefix:
            entry = "/".join([name, *prefix])
            hits += [(-len(entry), [-ord(c) for c in a], category, entry) for a, b in spans if a <= day and (b is None or day < b)]
    return (min(hits)[3], min(hits)[2]) if hits else None


def test_url_filters_brute_force(spark):
    rng = random.Random(5)
    entries = ("a.com", "b.a.com", "a.com/x", "c.org/x/y", "C.org/X/", "a.com//x/y/", "org", "A.com/1/2/3/4/5/6", "z.c.org/x/y/z", "a.com/")
    events = [(e, c, a, f"2024-0{rng.randint(1, 9)}-01") for e in entries for c in ("spam", "scam", "t") for a in ("add", "remove", "add")]
    urls = [f"http://{h}{p}" for h in ("a.com", "b.A.com", "ba.com", "c.org", "z.c.org", "zip", "u@c.org:80") for p in ("", "/", "/x", "/x/y", "/X", "/xy", "//x//y/z?q#f", "/1/2/3/4/5/6", "/1/2/3/4/5/6/7/", "/1/2/3/4/5")]
    rows = [(i, u, f"2024-{m:02d}-01") for i, (u, m) in enumerate(itertools.product(urls, range(1, 13)))]
    pages = spark.createDataFrame(rows, "page_id long, url string, day string").withColumn("day", F.to_date("day"))
    log = spark.createDataFrame(events, "entry string, category string, action string, at string").withColumn("at", F.to_date("at"))
    got = {r["page_id"]: (r["entry"], r["category"]) if r["blocked"] else None for r in url_filters.filter_urls(pages, log, F.col("day")).collect()}
    assert got == {i: brute_hit(u.replace("u@", "").replace(":80", ""), d, events) for i, u, d in rows}
    assert len({x[0] for x in got.values() if x}) >= 8


def test_url_filters_of_messy_rows(spark):
    day = datetime.date(2024, 6, 2)
    rows = [(1, "http://a.com/", day, "x"), (1, "http://a.com/", day, "x"), (None, None, day, "x"), (2, "", day, "x"), (3, "http://a.com/" + "x/" * 50_000, day, "x"), (4, "http://a.com", None, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, day date, entry string")
    log = spark.createDataFrame([("a.com", "s", "add", day), ("a.com", None, "add", day), (None, "s", "add", day)], "entry string, category string, action string, at date")
    got = url_filters.filter_urls(pages, log, F.col("day")).collect()
    assert Counter((r["page_id"], r["blocked"]) for r in got) == Counter({(1, True): 2, (None, False): 1, (2, False): 1, (3, True): 1, (4, False): 1})
    assert url_filters.filter_urls(pages.limit(0), log, F.col("day")).count() == 0
    assert not any(r["blocked"] for r in url_filters.filter_urls(pages, log.limit(0), F.col("day")).collect())


# 5: mixing


def test_mixing_follows_the_schedule(spark):
    rows = [(i, "a" if i < 3000 else "b", "x" * 40) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix_sources(docs, {"a": (1000, 0)}, (0, 1000)).collect()
    assert [r["position"] for r in got] == sorted(r["position"] for r in got)
    early = [r["source"] for r in got if r["position"] < 6000]
    assert 0.85 < early.count("a") / len(early) < 0.95  # the share is 1 - x over the first tenth... of the budget
    assert abs(Counter(r["source"] for r in got)["a"] - 3000) < 5


def test_mixing_meets_targets_whatever_the_supply(spark):
    supply = {"a": 5000, "b": 600, "c": 200, "d": 200}
    rows = [(f"{s}{i}", s, "x" * 40) for s, n in supply.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id string, source string, text string")
    n = Counter(r["source"] for r in mixing.mix_sources(docs, {"b": (400, 400), "gone": (100, 100), None: (0, 0)}, (0, 1000)).collect())
    assert abs(n["b"] - 0.4 * 6000) < 5 and abs(n["a"] - 0.5 * 6000 * 5000 / 5400 * 1.0) < 0.1 * 6000  # what the absent one leaves goes to the others
    assert abs(sum(n.values()) - 6000) < 10
    n = Counter(r["source"] for r in mixing.mix_sources(docs, {None: (1000, 1000)}, (0, 1000)).collect())
    total = sum(v**0.5 for v in supply.values())
    assert all(abs(n[s] - 6000 * supply[s] ** 0.5 / total) < 5 for s in supply)
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, {"a": (900, 900), "b": (200, 200)}, (0, 1000))


def test_mixing_of_messy_rows(messy, nothing):
    got = mixing.mix_documents(messy, schedule={}, knots=(0, 1000))
    assert got.columns == messy.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, messy.collect()))
    assert mixing.mix_documents(nothing).count() == 0
    assert mixing.mix_sources(messy).count() > 0


# 6: quality rules


def test_em_by_patterns_equals_em_by_documents():
    rng = np.random.default_rng(0)
    votes = rng.integers(0, 3, (300, 4))
    patterns = (votes * 3 ** np.arange(4)).sum(1)
    kinds, counts = np.unique(patterns, return_counts=True)
    share, table = quality.fit(kinds, counts.astype(float), 4)
    share_all, table_all = quality.fit(patterns, np.ones(300), 4)
    assert np.allclose(share, share_all, atol=1e-6) and np.allclose(table, table_all, atol=1e-6)
    for p, post in zip(kinds, quality.posterior(kinds, share, table)):
        like = share.copy()
        for i in range(4):
            if (v := int(p) // 3**i % 3) != quality.ABSTAIN:
                like *= table[:, i, v]
        assert np.isclose(post, like[1] / like.sum())


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.judge(docs).join(labels, "doc_id").groupBy(labels["quality"].alias("truth"), "keep").count().collect()
    n = {(r["truth"], r["keep"]): r["count"] for r in got}
    assert n.get((1, False), 0) <= 0.005 * n[1, True]
    assert n[0, False] / (n[0, False] + n.get((0, True), 0)) >= 0.85


RUSSIAN = "Старый дом стоял на берегу широкой реки, и каждое утро над водой поднимался густой туман.\nДети бегали по саду, собирали яблоки и слушали рассказы бабушки о далёких странах.\nК вечеру вся семья собиралась за большим столом, и отец читал вслух новую книгу."
FINNISH = "Vanha talo seisoi leveän joen rannalla, ja joka aamu veden yllä nousi sakea sumu.\nLapset juoksivat puutarhassa, keräsivät omenoita ja kuuntelivat isoäidin kertomuksia kaukaisista maista.\nIllalla koko perhe kokoontui suuren pöydän ääreen, ja isä luki ääneen uutta kirjaa."
CHINESE = "老房子坐落在宽阔的河边,每天早晨水面上都会升起浓雾。\n孩子们在花园里奔跑,摘苹果,听祖母讲述遥远国度的故事。\n傍晚全家人围坐在大桌子旁,父亲大声朗读一本新书。"
JAPANESE = "古い家は広い川のほとりに立っていて、毎朝水の上に濃い霧が立ちこめた。\n子どもたちは庭を走り回り、りんごを集め、遠い国々についての祖母の話を聞いた。\n夕方になると家族全員が大きな食卓を囲み、父が新しい本を声に出して読んだ。"


def test_quality_keeps_other_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    texts = {-1: (RUSSIAN, "ru"), -2: (FINNISH, "fi"), -3: (CHINESE, "zh"), -4: (JAPANESE, "ja"), -5: (RUSSIAN, None), -6: (FINNISH, None), -7: (" ".join(CHINESE), "zh"), -8: (CHINESE.replace("\n", ""), None)}
    more = spark.createDataFrame([(i, *x) for i, x in texts.items()], "doc_id long, text string, lang string")
    got = quality.judge(docs.unionByName(more)).where("doc_id < 0").collect()
    assert {r["doc_id"] for r in got if r["keep"]} == set(texts), got


def test_a_lone_bad_vote_does_not_reject(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lone = [r for r in quality.judge(docs).collect() if r["votes"].count("b") == 1 and r["votes"].count("g") >= 8]
    assert lone and all(r["keep"] for r in lone)


def test_judge_against_brute_force(documents):
    """Votes of each document by its own rules, and EM over documents instead of patterns."""
    rows = documents.collect()
    votes = {r["doc_id"]: quality.votes_of(r["text"], r["lang"]) for r in rows}
    some = [i for i, v in votes.items() if v]
    patterns = np.array([sum(v * 3**k for k, v in enumerate(votes[i])) for i in some])
    share, table = quality.fit(patterns, np.ones(len(some)))
    want = {}
    for i in some:
        like = np.log(share)
        for k, v in enumerate(votes[i]):
            if v != quality.ABSTAIN:
                like = like + np.log(table[:, k, v])
        want[i] = 1 / (1 + np.exp(like[0] - like[1]))
    for r in quality.judge(documents).collect():
        i = r["doc_id"]
        assert r["votes"] == ("".join("bg-"[v] for v in votes[i]) if votes[i] else "-" * len(quality.RULES))
        assert (r["quality"] is None) == (i not in want) and (r["quality"] is None or abs(r["quality"] - want[i]) < 1e-4)


def test_single_rules():
    assert quality.capitals(quality.Facts("AA BB CC DD ee", "AA BB CC DD ee".split())) == quality.BAD
    assert quality.stutter(quality.Facts("a a a a b", "a a a a b".split())) == quality.BAD
    lines = "x y\nx y\nx y\nz"
    assert quality.repeated_lines(quality.Facts(lines, lines.split())) == quality.BAD
    bars = "a | b | c | d | e |"
    assert quality.bars(quality.Facts(bars, bars.split())) == quality.BAD
    plain = " ".join(["xq"] * 30)
    assert [quality.stop_words(quality.Facts(plain, plain.split(), lang)) for lang in ("en", "fi", None)] == [quality.BAD, quality.ABSTAIN, quality.ABSTAIN]
    assert quality.stop_words(quality.Facts("the of and " * 10, ("the of and " * 10).split(), None)) == quality.GOOD


def test_quality_of_messy_rows(messy, nothing):
    got = quality.judge(messy).collect()
    assert len(got) == len(ROWS) and sum(r["quality"] is None for r in got) == 4
    kept = quality.keep_good(messy)
    assert kept.columns == messy.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in got if r["keep"])
    assert quality.judge(nothing).count() == 0 and quality.keep_good(nothing).count() == 0


# 7: fingerprints


def test_sketches_merge_and_estimate(spark, documents, messy, nothing):
    a = " ".join(f"w{i}" for i in range(4000))
    docs = spark.createDataFrame([(1, a, "g"), (2, " ".join(a.split()[:1000]), "g"), (3, " ".join(f"v{i}" for i in range(50)), "g")], "doc_id long, text string, g string")
    s = fingerprints.sketch_documents(docs)
    part, whole = s.where("doc_id = 2").first(), s.where("doc_id = 1").first()
    assert set(part["sketch"]) <= set(whole["sketch"]) and abs(len(whole["sketch"]) * fingerprints.SCALE / whole["n_shingles"] - 1) < 0.3
    merged = s.agg(fingerprints.merge_sketches(F.col("sketch")).alias("m")).first()["m"]
    assert merged == sorted({x for r in s.collect() for x in r["sketch"]})
    x = s.alias("p").join(s.alias("w"), F.expr("p.doc_id = 2 and w.doc_id = 1")).select(fingerprints.containment(F.col("p.sketch"), F.col("w.sketch")).alias("c")).first()["c"]
    assert x == 1.0
    got = fingerprints.sketch_documents(messy).collect()
    assert len(got) == len(ROWS) and sum(r["sketch"] is None for r in got) == 2
    assert fingerprints.sketch_documents(nothing).count() == 0


# 8: line dedup


def brute_lines(rows):
    """Roots by comparing every pair of kinds."""
    seen, kinds = {}, {}
    for doc, text in rows:
        for no, line in line_dedup.lines_of(text or ""):
            seen.setdefault(line.decode(), []).append((doc, no))
    names = sorted(seen, key=len)
    parent = {k: k for k in names}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(names):
        letters = Counter(a)
        for b in names[i + 1 :]:
            most = int(len(b) * 0.1 + 1e-9)
            if len(b) - len(a) > most:
                break
            if (Counter(b) - letters).total() <= most and root(a) != root(b) and line_dedup.similar(a, b, 0.9):
                parent[root(a)] = root(b)
    groups = defaultdict(list)
    for k in names:
        groups[root(k)] += seen[k]
    return {place for g in groups.values() for place in sorted(g)[1:]}


def test_line_dedup_against_brute_force(documents):
    want = brute_lines([(r["doc_id"], r["text"]) for r in documents.collect()])
    got = {(r["id"], r["no"]) for r in line_dedup.removed_lines(documents).collect()}
    assert len(got & want) >= 0.95 * len(want) > 0 and len(got - want) <= 0.02 * len(want)


def fuzzy_pairs(rng, words, changes, how):
    """Pairs of lines with an edit similarity of 0.9 or more: words with a letter changed, or one word more or less."""
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 10))) for _ in range(5000)]
    while True:
        a = [rng.choice(vocabulary) for _ in range(words)]
        b = list(a)
        if how == "letters":
            for k in rng.sample(range(words), changes):
                at = rng.randrange(len(b[k]))
                b[k] = b[k][:at] + rng.choice("0123456789") + b[k][at + 1 :]
        elif how == "word":
            b[rng.randrange(words)] = "".join(rng.choice("0123456789") for _ in range(3))
        elif how == "more":
            b.insert(rng.randrange(words + 1), "x1")
        else:  # a space gone
            k = rng.randrange(words - 1)
            b[k : k + 2] = [b[k] + b[k + 1]]
        if line_dedup.similar(" ".join(a), " ".join(b), 0.9):
            yield " ".join(a), " ".join(b)


def test_line_dedup_finds_fuzzy_pairs_of_any_length(spark):
    rng = random.Random(3)
    rows, kinds = [], {}
    ways = [(w, c, "letters") for w, c in ((5, 1), (5, 2), (6, 2), (7, 2), (9, 2), (12, 2), (10, 3), (14, 3), (20, 3), (25, 3), (28, 5), (40, 6), (60, 9))]
    ways += [(w, 1, how) for how in ("word", "more", "space") for w in (6, 8, 12, 13, 18, 25)]
    for way in ways:
        for a, b in itertools.islice(fuzzy_pairs(rng, *way), 40):
            kinds[len(rows) + 1] = way
            rows += [(len(rows), a), (len(rows) + 1, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {r["id"] for r in line_dedup.removed_lines(docs).collect()}
    assert gone <= set(kinds)
    found = Counter(kinds[i] for i in gone)
    assert {way: found[way] for way in ways if found[way] < 38} == {}


def test_line_dedup_of_fuzzy_lines(spark):
    base = "the quick brown fox jumps over the lazy dog while many other animals are looking at it from afar and wonder"
    rows = [(1, base + "\nshort line"), (2, "something else entirely stands here in this line\n" + base.replace("lazy", "lazyy").upper()), (3, "short line\n" + base + "!"), (4, base.replace("dog", "cow"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: rows[0][1], 2: "something else entirely stands here in this line", 3: "", 4: ""}


def test_line_dedup_of_lines_of_few_words(spark):
    cjk = "这是一个没有空格的很长的句子我们用它来测试去重"
    rows = [(1, "Les.\nCookies and privacy\n" + cjk), (2, "les\n\ncookies and privacy!\n---"), (3, "Les.\nother\n" + cjk.replace("测试", "检试") + "\n---"), (4, "Les.\nOther things stand here")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "\n---", 3: "other\n---", 4: "Other things stand here"}


def test_line_dedup_of_messy_rows(messy, nothing):
    got = line_dedup.dedup_lines(messy)
    assert got.columns == messy.columns
    rows = Counter((r["doc_id"], r["text"]) for r in got.collect())
    assert rows == Counter({(1, TEXT): 1, (2, ""): 2, (3, ""): 1, (4, None): 1, (None, TEXT): 1, (None, None): 1, (5, LONG): 1, (6, "   \n\n "): 1, (7, "one"): 1, (7, ROWS[-1][1]): 1})
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_line_dedup_by_crowds_and_large_groups(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    rows = []
    for _ in range(4):
        base = [word() for _ in range(20)]
        for _ in range(30):
            own = list(base)
            for k in rng.sample(range(20), rng.randint(0, 3)):
                own[k] = own[k][:-1] + rng.choice("xyz")
            rows.append((len(rows), " ".join(own)))
        rows += [(len(rows) + k, " ".join(base[:10] + [word() for _ in range(10)])) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_lines(rows)
    usual = {(r["id"], r["no"]) for r in line_dedup.removed_lines(docs).collect()}
    for name, value in {"WIDE": 3, "SPARSE": 0, "PROBED": 5, "TILE": 4, "GROUP": 1}.items():
        monkeypatch.setattr(line_dedup, name, value)
    assert usual == want == {(r["id"], r["no"]) for r in line_dedup.removed_lines(docs).collect()}


def variants(rng, many, near, far=0):
    """A line of 30 words ``many`` times, of which ``near`` words at most are changed; the last ``far`` lines have seven changed."""
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    base = [word() for _ in range(30)]
    for i in range(many):
        own = list(base)
        for k in rng.sample(range(30), rng.randint(0, near) if i < many - far else 7):
            own[k] = word()
        yield " ".join(own)


def test_a_crowd_of_one_text_costs_in_proportion(monkeypatch):
    rng = random.Random(11)
    lines = list(dict.fromkeys(variants(rng, 500, 3, 4)))
    looked, usual = [], line_dedup.connecting
    monkeypatch.setattr(line_dedup, "connecting", lambda pairs, *rest: looked.extend(pairs) or usual(pairs, *rest))
    found = line_dedup.connect(lines, 0.9)
    assert len(looked) < 40 * len(lines)
    sets = line_dedup.Union()
    for pair in found:
        sets.join(*pair)
    for i, j in itertools.combinations(range(len(lines)), 2):
        if sets.root(i) != sets.root(j):
            assert line_dedup.edit_distance(lines[i], lines[j], 99) > 0.1 * max(len(lines[i]), len(lines[j]))


def test_wide_bands_are_for_many_pairs(monkeypatch):
    rng = random.Random(5)
    line = lambda n: "".join(rng.choice("abcdefg ") for _ in range(n))
    pairs = [(a, b) for n in (90, 400, 1500) for a in [line(n)] for b in (a[: n // 2] + line(n // 12) + a[n // 2 + n // 12 :], line(n))]
    most = [len(a) // 10 for a, _ in pairs]
    want = [line_dedup.edit_distance(a, b, 10**6) <= m for (a, b), m in zip(pairs, most)]
    lanes, usual = [], line_dedup._band
    monkeypatch.setattr(line_dedup, "_band", lambda pairs, *rest: lanes.append(len(pairs)) or usual(pairs, *rest))
    assert line_dedup.distances_within(pairs, most) == want and not lanes and 0 < sum(want) < len(want)
    assert line_dedup.distances_within(pairs * 40, most * 40) == want * 40 and min(lanes) >= line_dedup.FEW


@pytest.mark.parametrize("letters", ["abcdefg ", "".join(map(chr, range(0x4E00, 0x4E00 + 400)))])
def test_bands_of_few_short_pairs_among_long_ones(letters):
    """A short pair is done, but stays in the batch until its place is far outside of its window."""
    rng, pairs, most = random.Random(7), [], []
    for n, times, m in ((40, 10, 6), (310, 90, 31), (70, 10, 40), (600, 90, 60)):
        for k in range(times):
            a = "".join(rng.choice(letters) for _ in range(n))
            spots = rng.sample(range(n), m - 3 + k % 7)
            pairs.append((a, "".join(rng.choice(letters) if i in spots else c for i, c in enumerate(a)))), most.append(m)
    want = [line_dedup.edit_distance(a, b, 10**6) <= m for (a, b), m in zip(pairs, most)]
    assert line_dedup.distances_within(pairs, most) == want and 0 < sum(want) < len(want)


@pytest.mark.parametrize("kind", ["long", "string", "double"])
def test_kinds_have_their_first_places(spark, monkeypatch, kind):
    monkeypatch.setattr(line_dedup, "FOLD", 50)
    rng = random.Random(3)
    rows = [(rng.randrange(12), rng.randrange(-2, 2), rng.randrange(3), rng.randrange(-9, 9), rng.randrange(2)) for _ in range(600)]
    found = spark.createDataFrame(rows, "id int, dkey long, no int, node long, bag long").withColumn("id", F.col("id").cast(kind))
    want = found.groupBy("node", "bag").agg(F.min(F.struct("id", "dkey", "no")).alias("place"), F.count("*").alias("n"))
    assert sorted(line_dedup._kinds(found).collect()) == sorted(want.collect())


def test_lines_with_characters_of_several_bytes(spark):
    rows = [(1, "Größe und Maß der Dinge sind hier gefragt\n日本語 の 文 です\nein Ende ΟΔΟΣ"), (2, "größe und maß der dinge sind hier gefragt!\nΟΔΟΣ\n日本語の文です"), (3, "Größe und Maß der Dinge sind hier gefragx\nοδος")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "ΟΔΟΣ", 3: ""}


def test_crowds_that_share_kinds_are_verified_once(spark, monkeypatch):
    """Families of several tiles, with kinds apart; each kind is in three crowds."""
    rng = random.Random(12)
    monkeypatch.setattr(line_dedup, "TILE", 30)
    families = [list(dict.fromkeys(variants(rng, 130, 4, 12))) for _ in range(2)]
    lines = [line for own in families for line in own]
    crowds = [(f * 10 + c + 10**6, len(families[0]) * f + k) for f, own in enumerate(families) for c in range(4) for k in range(len(own)) if k % 4 != c]
    frame = spark.createDataFrame(list(enumerate(lines)), "node long, line string")
    edges = line_dedup._verify_crowds(spark.createDataFrame(crowds, "crowd long, node long"), frame, 0.9).collect()
    assert len(edges) < 2 * len(lines)
    got, want = line_dedup.Union(), line_dedup.Union()
    for x in edges:
        assert line_dedup.similar(lines[x["src"]], lines[x["dst"]], 0.9)
        got.join(x["src"], x["dst"])
    for i, j in itertools.combinations(range(len(lines)), 2):
        if want.root(i) != want.root(j) and line_dedup.similar(lines[i], lines[j], 0.9):
            want.join(i, j)
    assert len({got.root(i) for i in range(len(lines))}) == len({want.root(i) for i in range(len(lines))}) > 2


def test_distances_of_many_pairs():
    rng = random.Random(4)
    pairs, most = [], []
    for _ in range(600):
        a = [rng.choice("abcdé字") for _ in range(rng.choice([3, 40, 90, 300, 600]))]
        b = list(a)
        for _ in range(rng.randint(0, len(a) // 7 + 1)):
            k = rng.randrange(len(b))
            b[k : k + 1] = rng.choice([[], ["x"], ["y", b[k]]]) if len(b) > 1 else ["x"]
        pairs.append(("".join(a), "".join(b)) if rng.random() < 0.5 else ("".join(b), "".join(a)))
        most.append(int(max(len(a), len(b)) * 0.1) + rng.randrange(3))
    want = [line_dedup.edit_distance(a, b, 10**6) <= m for (a, b), m in zip(pairs, most)]
    assert line_dedup.distances_within(pairs, most) == want and 0 < sum(want) < len(want)


def test_edit_distance():
    rng = random.Random(1)

    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for _ in range(300):
        a, b = ("".join(rng.choice("abé") for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert line_dedup.edit_distance(a, b, 99) == slow(a, b)


# 9: n-gram Jaccard join


def check_classes(docs, rows, threshold=ngram_join.THRESHOLD):
    """Classes, copies and links of every id, and the pairs of sets, against all pairs of rows."""
    sets = [(i, frozenset(shingles(*hash_words([fold(t)]), ngram_join.N)[0].tolist())) for i, t in rows if i is not None and t]
    sets = [(i, s) for i, s in sets if s]
    ids = {i for i, _ in rows if i is not None}
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    near = defaultdict(set)
    kinds, lowest = Counter(s for _, s in sets), {}
    for i, s in sets:
        lowest[s] = min(i, lowest.get(s, i))
    for s, t in itertools.combinations(kinds, 2):
        if min(len(s), len(t)) >= threshold * max(len(s), len(t)) and len(s & t) / len(s | t) >= threshold - 1e-12:
            near[s].add(t), near[t].add(s)
    for i, s in sets:
        for j in [lowest[s], *(lowest[t] for t in near[s])]:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    # rows under one id don't connect classes of their own accord
    copies, links, classes = Counter(), Counter(), defaultdict(list)
    of_set = {}
    for s in kinds:
        seen, stack = {s}, [s]
        while stack:
            for t in near[stack.pop()] - seen:
                seen.add(t), stack.append(t)
        of_set[s] = min(lowest[t] for t in seen)
    for i, s in set(sets):
        copies[i] += kinds[s] - 1
        links[i] += sum(kinds[t] for t in near[s])
        classes[i].append(of_set[s])
    got = {r[0]: tuple(r)[1:] for r in ngram_join.ngram_classes(docs).collect()}
    assert got == {i: (min(classes[i], default=i), copies[i], links[i]) for i in ids}
    pairs = Counter((r["doc_a"], r["doc_b"]) for r in ngram_join.ngram_join(docs).collect())
    assert pairs == Counter(tuple(sorted((lowest[s], lowest[t]))) for s in near for t in near[s] if id(s) < id(t))
    return sum(links.values())


def test_ngram_join_against_brute_force(documents):
    assert check_classes(documents, [(r["doc_id"], r["text"]) for r in documents.collect()]) > 0


def test_ngram_join_of_hot_ngrams(spark):
    """A passage that all documents share, in texts of many lengths; many more than a hot n-gram needs."""
    rng = random.Random(9)
    shared = [f"s{i}" for i in range(30)]
    rows = [(k, " ".join([f"w{rng.randrange(10**6)}" for _ in range(rng.choice([0, 0, 1, 5, 20, 40, 80]))] + shared)) for k in range(150)]
    assert check_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), rows) > 0


def test_thinning_keeps_what_connects():
    rng = np.random.default_rng(3)
    for _ in range(50):
        size = np.sort(rng.integers(1, 2000, 300) ** rng.integers(1, 3))
        sent, joined = ngram_join.thin(np.zeros(300, np.uint64), size, 0.4, 5)
        assert {0, 299} <= set(sent.tolist()) and len(sent) < 150
        for other in rng.integers(1, size[-1] + 1, 50):  # a row that may meet some may meet one that is sent
            if ((np.minimum(size, other) >= 0.4 * np.maximum(size, other))).any() and size[0] <= other:
                below = size[sent][size[sent] <= other][-1]
                above = size[sent][size[sent] >= other][:1]
                assert below >= 0.4 * other or (len(above) and other >= 0.4 * above[0])


def test_ngram_join_keeps_one(spark):
    text = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(4, text), (2, text), (9, text + " end"), (3, "quite another text that stands alone"), (5, None), (6, ""), (None, text)], "doc_id long, text string")
    kept = ngram_join.keep_one(docs)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "5", "6", "None"]


def test_ngram_join_of_messy_rows(messy, nothing):
    check_classes(messy, [(r[0], r[1]) for r in ROWS])
    kept = ngram_join.keep_one(messy)
    assert kept.columns == messy.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "3", "4", "5", "6", "7", "7", "None", "None"])
    assert ngram_join.ngram_join(nothing).count() == 0 and ngram_join.ngram_classes(nothing).count() == 0 and ngram_join.keep_one(nothing).count() == 0


# 10: HTML extraction


def test_min_cut_is_minimal():
    rng = random.Random(7)
    for _ in range(60):
        n = rng.randint(1, 8)
        gain = [rng.choice([-2, -1, -0.5, 0, 0.5, 1, 2]) for _ in range(n)]
        edges = [(i, j, rng.choice([0.3, 1, 2.5])) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        cost = lambda side: sum(abs(g) for g, s in zip(gain, side) if (g > 0) != s and g) + sum(c for i, j, c in edges if side[i] != side[j])
        assert cost(html_extract.min_cut(gain, edges)) == pytest.approx(min(map(cost, itertools.product([False, True], repeat=n))))


def test_settled_blocks_dont_change_the_cut():
    rng = np.random.default_rng(2)
    page = "<div>" + "".join(f"<{t}>{'word ' * int(k)}</{t}>" for t, k in zip(rng.choice(["p", "li", "div", "h2"], 12), rng.integers(1, 30, 12))) + "</div>"
    blocks = html_extract.blocks_of(page)
    model = rng.normal(size=len(html_extract.FEATURES)) / 3
    label, gain, edges = html_extract.label_blocks(blocks, model)
    cost = lambda side: sum(abs(g) for g, s in zip(gain, side) if (g > 0) != s) + sum(c for i, j, c in edges if side[i] != side[j])
    assert cost(label) == pytest.approx(cost(html_extract.min_cut(gain.tolist(), edges)))


PAGE = """<html><head><title>T</title><script>var t="</p><p>no";</script></head><body><nav><ul><li><a href="/x">Home</a><li><a href="/y">News</a></ul></nav>
<div class="ad">Buy this now, it is cheap.</div><article><h1>The title of it</h1><p>This is the first paragraph of the article, and it is long enough.<p>A second &amp; last one &lt;here&gt;, with <b>bold</b> words.
<!-- <p>hidden</p> --></article><footer>&copy; example.org 2024</footer></body>"""


def test_extraction_of_a_page(spark, sf_dir):
    model = html_extract.train(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    text, blocks, content, _ = html_extract.extract(PAGE, model)
    assert text.split("\n") == ["The title of it", "This is the first paragraph of the article, and it is long enough.", "A second & last one <here>, with bold words."]
    assert (blocks, content) == (7, 3)


def test_extraction_held_out(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = html_extract.train(pages.where("page_id % 2 = 0"))
    right = total = 0
    for r in pages.where("page_id % 2 = 1").collect():
        blocks = html_extract.blocks_of(r["html"])
        label, _, _ = html_extract.label_blocks(blocks, model)
        marked = [(b.side > 0, own) for b, own in zip(blocks, label) if b.side]
        right, total = right + sum(a == b for a, b in marked), total + len(marked)
    assert right / total > 0.97


def test_extraction_of_messy_rows(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, PAGE, "x"), (1, PAGE, "x"), (2, None, "x"), (3, "", "x"), (None, "<p>Some text, with no id.", "x"), (4, "<<<p>>> & <a href='", "x"), (5, deep, "x"), (6, "<p>word and more.</p>" * 20_000, "x"), (7, "<script>only", "x")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_extract.extract_pages(pages, html_extract.train(pages)).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[2]["text"] is None and by[3]["text"] == "" and by[3]["n_blocks"] == 0 and by[6]["n_blocks"] == 20_000 and by[7]["n_blocks"] == 0
    assert html_extract.extract_pages(pages.limit(0), html_extract.train(pages.limit(0))).count() == 0
