"""Queries of the corpus operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import langs, texts, urls
from gristmill.operators import annotate, batching, dedup, ingest, minhash, registers, robots, routing, stats
from gristmill.plans import inline
from gristmill.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
BATCH_BYTES = 20_000


def query(work):
    """Registers ``work(spark, read)`` under its name; ``read`` reads a table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return work(spark, lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

    QUERIES[work.__name__] = run
    return work


def _reasoned(docs: DataFrame) -> DataFrame:
    return docs.withColumn("filter", annotate.filter_reason(F.col("text"), langs.is_cjk(F.col("lang"))))


@query
def segment_stats(spark, read):
    n = texts.segment_count(F.col("text"))
    return read("documents").select("doc_id", n.alias("segments"), texts.words_total(F.col("text")).alias("words"), texts.chars_total(F.col("text")).alias("chars"), (texts.words_total(F.col("text")) / n).alias("word_avg"))


@query
def length_filter(spark, read):
    return read("documents").where(F.length("text") > annotate.MIN_LENGTH).select("doc_id")


@query
def word_avg_filter(spark, read):
    return read("documents").where(texts.words_total(F.col("text")) > annotate.MIN_AVG_WORDS * texts.segment_count(F.col("text"))).select("doc_id")


@query
def char_avg_filter(spark, read):
    return read("documents").where(texts.chars_total(F.col("text")) > annotate.MIN_AVG_CHARS * texts.segment_count(F.col("text"))).select("doc_id")


@query
def filter_reason(spark, read):
    return _reasoned(read("documents")).select("doc_id", "filter")


@query
def filter_reason_stats(spark, read):
    return stats.filter_stats(_reasoned(read("documents")))


@query
def stats_pivot(spark, read):
    return stats.stats_table(stats.filter_stats(_reasoned(read("documents")), ("lang",)), reasons=("keep", "length_500", "word_avg_5"))


@query
def run_counters(spark, read):
    docs = read("documents")
    return stats.run_counters(docs, docs.where(F.length("text") > annotate.MIN_LENGTH))


@query
def size_totals(spark, read):
    return stats.size_totals(read("documents"), "lang", "source")


@query
def url_strip_prefix(spark, read):
    return read("pages").select("page_id", urls.strip_prefix(F.col("url")).alias("key"))


@query
def url_host(spark, read):
    return read("pages").select("page_id", urls.host(F.col("url")).alias("host"))


@query
def host_shorten(spark, read):
    once = urls.drop_label(urls.host(F.col("url")))
    return read("pages").select("page_id", once.alias("shorter1"), urls.drop_label(once).alias("shorter2"))


@query
def adult_filter(spark, read):
    return annotate.mark_adult(read("pages"), inline.frame(spark, inline.DOMAINS, "domain")).select("page_id", "is_adult")


@query
def adult_filter_extended(spark, read):
    return annotate.mark_adult(read("pages"), inline.frame(spark, inline.DOMAINS, "domain"), extended=True).select("page_id", "is_adult")


@query
def batch_names(spark, read):
    return inline.frame(spark, inline.PATHS, "path").select("path", urls.strip_zeros(F.col("path")).alias("name"))


@query
def crawl_names(spark, read):
    return inline.frame(spark, inline.FILES, "file").select("file", urls.crawl_name(F.col("file")).alias("crawl"))


@query
def robots_parse(spark, read):
    return robots.parse_robots(inline.frame(spark, inline.ROBOTS, "u, p")).select("u", "pattern", "allowed")


def _disallowed(spark, read):
    return robots.disallowed_urls(read("pages"), inline.frame(spark, inline.RULES, "u, rule_idx, pattern, allowed"))


@query
def robots_disallowed(spark, read):
    return _disallowed(spark, read)


@query
def robots_annotate(spark, read):
    return robots.annotate_robots(read("pages"), _disallowed(spark, read)).select("page_id", "allowed")


@query
def robots_filter(spark, read):
    return robots.filter_disallowed(read("pages"), _disallowed(spark, read)).select("page_id", "url")


@query
def exact_dedup(spark, read):
    return dedup.exact_dedup(read("documents")).select("doc_id", "lang", "source")


@query
def exact_dup_report(spark, read):
    return dedup.exact_dup_report(read("documents"))


@query
def minhash_signature(spark, read):
    return minhash.minhash_signature(read("documents"))


@query
def lsh_params(spark, read):
    """Bands and rows for some thresholds; a function of numbers, not of a table."""
    return spark.createDataFrame([(t, *minhash.lsh_params(t)) for t in (0.5, 0.7, 0.8, 0.9)], "threshold double, bands long, rows long")


@query
def lsh_bands(spark, read):
    return minhash.lsh_bands(minhash.minhash_signature(read("documents")))


@query
def lsh_single_band(spark, read):
    return minhash.lsh_bands(minhash.minhash_signature(read("documents")), band_id=3)


@query
def near_dup_edges(spark, read):
    return minhash.near_dup_edges(minhash.band_keys(read("documents")))


@query
def near_dup_components(spark, read):
    return minhash.find_components(read("documents"))


def _components(read, **how):
    docs = read("documents")
    return docs, materialize(minhash.find_components(docs, **how), "components")


@query
def near_dedup(spark, read):
    return dedup.near_dedup(*_components(read), add_cluster_size=True).select("doc_id", "lang", "cluster_size")


@query
def near_dups_only(spark, read):
    return dedup.near_dedup(*_components(read), duplicates_only=True).select("doc_id", "lang")


@query
def cluster_sizes(spark, read):
    return dedup.cluster_sizes(_components(read)[1])


@query
def near_dedup_by_scope(spark, read):
    docs = read("documents").withColumn("scope", F.when(F.col("lang") == "en", F.col("source")).otherwise("global"))
    return dedup.near_dedup(docs, materialize(minhash.find_components(docs, scope="scope"), "components")).select("doc_id", "scope")


@query
def near_dedup_char(spark, read):
    return dedup.near_dedup(*_components(read, tokenizer="char")).select("doc_id")


@query
def near_dedup_vectorizer(spark, read):
    return dedup.near_dedup(*_components(read, tokenizer="vectorizer")).select("doc_id")


@query
def near_dedup_verified(spark, read):
    return dedup.near_dedup(*_components(read, threshold=0.8)).select("doc_id")


@query
def lang_map_join(spark, read):
    docs = read("documents").select("doc_id", F.array("lang").alias("lang"), F.array(F.col("doc_id") % 100 / 100).alias("prob"))
    return routing.route_language(docs, inline.frame(spark, inline.LANG_MAP, "flores_code, canonical, script")).select("doc_id", "label")


@query
def lang_partition(spark, read):
    docs = read("documents").select("doc_id", "text", F.array("lang").alias("lang"), F.array(F.lit(0.9)).alias("prob"))
    routed = routing.route_language(docs, inline.frame(spark, inline.LANG_MAP, "flores_code, canonical, script"))
    return stats.size_totals(routed, "label")


@query
def lang_wds_map(spark, read):
    code = F.col("code")
    return inline.frame(spark, inline.CODES, "code").select("code", langs.score_lang(code).alias("score_lang"), langs.fixing_lang(code).alias("fixing_lang"), langs.pii_lang(code).alias("pii_lang"), langs.is_cjk(code).alias("cjk"))


@query
def register_lang_gate(spark, read):
    return inline.frame(spark, inline.CODES, "code").select("code", langs.has_registers(F.col("code")).alias("supported"), langs.dedup_scope(F.col("code"), F.lit("c1")).alias("scope"))


@query
def positional_merge(spark, read):
    docs = read("documents").withColumn("line_no", F.col("doc_id"))
    meta = docs.select("line_no", "source")
    text = docs.select("line_no", F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("text")).alias("t"))
    lang = docs.select("line_no", F.when(F.col("doc_id") % 11 == 0, F.array().cast("array<string>")).otherwise(F.array("lang")).alias("lang"), F.array(F.col("doc_id") % 100 / 100).alias("prob"))
    return ingest.merge_sources(meta, text, lang, F.col("source")).select("line_no", "crawl_id", F.get("lang", F.lit(0)).alias("lang"), F.length("text").alias("chars"))


@query
def tsv_group(spark, read):
    return ingest.group_segments(read("conversations"), "conv_id", "turn", "text", ("role",))


@query
def secrets_list(spark, read):
    return annotate.list_secrets(read("documents"))


@query
def secrets_filter(spark, read):
    docs = read("documents")
    return annotate.drop_secrets(docs.select("doc_id", "text"), annotate.list_secrets(docs)).select("doc_id")


@query
def pii_spans(spark, read):
    """Kind, place and text of each span; the text is cut out by its span."""
    docs = read("documents").select("doc_id", "text", *[texts.spans_of(F.col("text"), p).alias(k) for k, p in texts.PII.items()])
    begin, end = F.col("s.start"), F.col("s.end")
    parts = [
        docs.select("doc_id", F.lit(k).alias("kind"), "text", F.explode(k).alias("s")).select("doc_id", "kind", F.substr("text", begin + 1, end - begin).alias("value"), begin.alias("span_start"), end.alias("span_end"))
        for k in texts.PII
    ]
    return ingest.union_collections(*parts)


@query
def text_fix(spark, read):
    return read("documents").select("doc_id", F.md5(texts.fix_text(F.col("text")).cast("binary")).alias("digest"))


@query
def replacement_char_filter(spark, read):
    docs = read("documents").withColumn("id", F.concat(F.when(F.col("doc_id") % 5 == 0, "own-").otherwise("x-"), F.col("doc_id").cast("string")))
    marked = docs.withColumn("text", F.when(F.col("doc_id") % 9 == 0, F.concat("text", F.lit(ingest.REPLACEMENT))).otherwise(F.col("text")))
    return ingest.take_external(marked).select("doc_id")


@query
def clean(spark, read):
    docs = _reasoned(read("documents")).join(read("labels").select("doc_id", F.array(F.col("quality") * 10.0).alias("doc_scores")), "doc_id", "left")
    return annotate.clean(docs.withColumn("allowed", F.when(F.col("doc_id") % 3 == 0, F.col("doc_id") % 2 == 0))).select("doc_id")


@query
def clean_pipeline(spark, read):
    """Exact dedup, reasons, robots and scores, cleaning, and the counts by language."""
    docs = _reasoned(dedup.exact_dedup(read("documents"))).withColumn("doc_scores", F.array(annotate.baseline_score(F.col("text"))))
    return annotate.clean(docs).groupBy("lang").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"))


@query
def collection_union(spark, read):
    docs = read("documents")
    return ingest.union_collections(docs.select("doc_id", "lang").where("source = 'src1'"), docs.select("doc_id", "source").where("source <> 'src1'"))


@query
def size_batches(spark, read):
    return batching.assign_batches(read("documents"), BATCH_BYTES, "source").select("doc_id", "source", "batch")


@query
def pack_files(spark, read):
    return batching.pack_files(read("documents").select("source", "doc_id", "n_chars"), "source", "doc_id", "n_chars", BATCH_BYTES).select("doc_id", "batch")


@query
def rotate_batches(spark, read):
    return batching.rotate_batches(read("documents").select("source", "doc_id", "n_chars"), "source", "doc_id", "n_chars", BATCH_BYTES).select("doc_id", "batch")


@query
def status_matrix(spark, read):
    counts = read("documents").groupBy("source").agg(
        F.count("*").alias("a"), F.count_if(F.col("n_chars") > 500).alias("b"), F.count_if(F.col("n_chars") < 5).alias("c"), F.count_if(F.col("n_chars") > 9000).alias("d"), F.count_if(F.col("n_chars") < 8).alias("e")
    )
    return counts.select("source", stats.status(*[F.col(x) for x in "abcde"]).alias("status"))


@query
def doc_id_hash(spark, read):
    return read("pages").select("page_id", texts.document_id(F.lit("f"), F.col("url"), F.col("page_id").cast("string")).alias("id"))


@query
def seeded_sample(spark, read):
    """The sampling operator: 200 rows in a seeded order."""
    return ingest.seeded_sample(read("documents").select("doc_id", "lang"), 200)


@query
def first_per_key(spark, read):
    return ingest.first_per_key(read("documents").select("doc_id", "lang"), "lang", "doc_id")


@query
def document_numbers(spark, read):
    return ingest.number_documents(read("documents").select("doc_id", "source"), "source", "doc_id").select("doc_id", "line_no")


@query
def seg_langid(spark, read):
    return read("documents").select("doc_id", annotate.segment_langs(F.col("text")).alias("seg_langs"))


@query
def doc_scores(spark, read):
    return read("documents").select("doc_id", annotate.baseline_score(F.col("text")).alias("score"))


@query
def web_registers(spark, read):
    docs = registers.baseline_registers(read("documents"))
    return docs.select("doc_id", *[F.element_at("web_register", F.lit(k)).alias(k) for k in registers.BASELINE])


@query
def char_tokens(spark, read):
    return read("documents").select("doc_id", F.size(texts.char_tokens(F.col("text"))).alias("windows"), F.size(texts.whitespace_tokens(F.col("text"))).alias("words"))
