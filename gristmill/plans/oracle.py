"""DuckDB SQL of the corpus queries."""

from __future__ import annotations

from gristmill.functions import langs, texts
from gristmill.operators.annotate import MARKERS
from gristmill.operators.minhash import BANDS, BUCKETS, PRIME, ROWS, coefficients
from gristmill.operators.registers import BASELINE
from gristmill.plans import inline

BATCH_BYTES = 20_000
N = "(length(text) - length(replace(text, chr(10), '')) + 1)"
WORDS = f"(length(text) - length(replace(text, ' ', '')) + {N})"
CHARS = f"(length(text) - ({N} - 1))"
REASON = f"CASE WHEN {WORDS} <= 5 * {N} THEN 'word_avg_5' WHEN length(text) <= 500 THEN 'length_500' ELSE 'keep' END"
KEY = r"regexp_replace(url, '^(https?://)?(www\.)?', '')"
HOST = r"regexp_replace(url, '(?i)^(?:https?://)?(?:[^@/\n]+@)?(?:www\.)?([^:/\n]+).*$', '\1')"
SHORT = lambda h: rf"regexp_replace({h}, '^[^.]*\.', '')"
STATS = lambda by: f"SELECT {by}{REASON} AS filter, count(*) AS n FROM documents GROUP BY ALL"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def adult(extended: bool) -> str:
    names = f"(SELECT domain FROM ({inline.values(inline.DOMAINS, 'domain')}))"
    host = f"{HOST} IN {names} OR {SHORT(HOST)} IN {names} OR {SHORT(SHORT(HOST))} IN {names}"
    more = " OR ".join(f"contains(url, '{x}')" for x in ("porn", "sex", "tube", "cams", "camgirls", "mature"))
    return f"SELECT page_id, ({host}{' OR ' + more if extended else ''}) AS is_adult FROM pages"


DISALLOWED = rf"""
  keys AS (SELECT DISTINCT {KEY} AS url FROM pages),
  rules AS (
    SELECT u, rule_idx, allowed, split_part(pattern, '/', 1) AS host,
           '^(?:' || replace(regexp_replace(regexp_replace(pattern, '[\^$]', '', 'g'), '([\\.+?()|\[\]{{}}#&~-])', '\\\1', 'g'), '*', '.*')
           || CASE WHEN regexp_matches(pattern, '[$*]$') THEN '' ELSE '.*' END || ')\z' AS rx
    FROM ({inline.values(inline.RULES, 'u, rule_idx, pattern, allowed')})),
  last AS (
    SELECT url, u, arg_max(allowed, rule_idx) AS allowed FROM keys JOIN rules ON split_part(url, '/', 1) = host AND regexp_matches(url, rx) GROUP BY ALL),
  gone AS (SELECT DISTINCT url FROM last WHERE NOT allowed)"""


def minhash(tokenizer: str = "whitespace") -> str:
    """CTEs ``tok`` and ``sig``."""
    words = (
        "list_transform(range(1, length(text) + 1, 3), lambda i: substr(text, i, 3))" if tokenizer == "char"
        else r"list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '')"
    )
    h = f"CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {PRIME}" + (f" % {BUCKETS}" if tokenizer == "vectorizer" else "")
    rows = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(coefficients(BANDS * ROWS)))
    return f"""
  co(i, a, b) AS (VALUES {rows}),
  tok AS (SELECT DISTINCT doc_id, {h} AS h FROM (SELECT doc_id, unnest({words}) AS w FROM documents)),
  mins AS (SELECT doc_id, i, min((CAST(a AS BIGINT) * h + b) % {PRIME}) AS m FROM tok, co GROUP BY doc_id, i),
  sig AS (SELECT doc_id, list(m ORDER BY i) AS sig FROM mins GROUP BY doc_id)"""


def bands(which: str = f"range({BANDS})") -> str:
    return f"""
  band AS (SELECT doc_id, k AS band, md5(array_to_string(list_slice(sig, k * {ROWS} + 1, k * {ROWS} + {ROWS}), ',')) AS key
           FROM sig, (SELECT CAST(unnest({which}) AS INTEGER) AS k))"""


def edges(scope: str = "''") -> str:
    return f"""
  scoped AS (SELECT b.*, {scope} AS scope FROM band b JOIN documents d USING (doc_id)),
  edge AS (SELECT DISTINCT doc_id AS src, low AS dst FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY scope, band, key) AS low FROM scoped) WHERE doc_id <> low)"""


COMPONENTS = """
  both_ways AS (SELECT src AS a, dst AS b FROM edge UNION SELECT dst, src FROM edge),
  reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
  comp AS (SELECT doc_id, least(doc_id, coalesce(min(b), doc_id)) AS component FROM documents LEFT JOIN reach ON a = doc_id GROUP BY doc_id)"""


def clusters(select: str, tokenizer: str = "whitespace", scope: str = "''", more: str = "") -> str:
    return f"WITH RECURSIVE {minhash(tokenizer)}, {bands()}, {edges(scope)}{more}, {COMPONENTS} {select}"


KEPT = "SELECT {} FROM documents JOIN comp USING (doc_id) WHERE doc_id {} component"
VERIFIED = f"""
  , loose AS (SELECT * FROM edge)
  , agreed AS (SELECT src, dst FROM loose JOIN sig x ON x.doc_id = src JOIN sig y ON y.doc_id = dst
      WHERE len(list_filter(list_zip(x.sig, y.sig), lambda p: p[1] = p[2])) >= 0.8 * {BANDS * ROWS})"""
SCOPE = "CASE WHEN d.lang = 'en' THEN d.source ELSE 'global' END"


def lang_case(table: dict[str, str], key: str) -> str:
    return "CASE " + " ".join(f"WHEN {key} = '{a}' THEN '{b}'" for a, b in table.items()) + " END"


#: Written apart from the engine's table: three-letter codes of the query's languages with their two-letter ones.
ISO = dict(x.split("-") for x in (
    "afr-af ara-ar amh-am asm-as bak-ba bam-bm bel-be ben-bn bod-bo bos-bs bul-bg cat-ca ces-cs cym-cy dan-da deu-de dzo-dz ell-el eng-en epo-eo eus-eu ewe-ee fao-fo fas-fa fij-fj fin-fi fra-fr gla-gd gle-ga glg-gl guj-gu hat-ht hau-ha"
    " heb-he hin-hi hrv-hr hun-hu hye-hy ibo-ig ind-id isl-is ita-it jav-jv jpn-ja kan-kn kas-ks kat-ka kaz-kk khm-km kik-ki kin-rw kir-ky kor-ko lat-la lao-lo lim-li lin-ln lit-lt ltz-lb lug-lg mal-ml mar-mr mkd-mk mlt-mt mri-mi mya-my"
    " nld-nl nno-nn nob-nb nya-ny oci-oc pan-pa pol-pl por-pt ron-ro run-rn rus-ru sag-sg san-sa sin-si slk-sk slv-sl smo-sm sna-sn snd-sd som-so sot-st spa-es srd-sc srp-sr ssw-ss sun-su swa-sw swe-sv tam-ta tat-tt tel-te tgk-tg"
    " tha-th tir-ti tsn-tn tso-ts tuk-tk tur-tr twi-tw uig-ug ukr-uk urd-ur vie-vi wol-wo xho-xh yor-yo zho-zh zul-zu"
).split())
OF_MACRO = dict(x.split("-") for x in (
    "acm-ar aeb-ar arb-ar ary-ar als-sq ayr-ay azb-az azj-az bjn-ms min-ms zsm-ms ckb-ku kmr-ku cmn-zh yue-zh ekk-et fuv-ff gaz-om gug-gn khk-mn knc-kr ltg-lv lvs-lv npi-ne ory-or pbt-ps pes-fa prs-fa plt-mg quy-qu swh-sw uzn-uz ydd-yi"
).split())


def in_list(names) -> str:
    return "(" + ", ".join(f"'{x}'" for x in names) + ")"


CODE, SCRIPT = "split_part(code, '_', 1)", "split_part(code, '_', -1)"
LANG_LABEL = f"SELECT flores_code, canonical FROM ({inline.values(inline.LANG_MAP, 'flores_code, canonical, script')})"


def fixed(segment: str) -> str:
    for bad, good in texts.MOJIBAKE:
        segment = f"replace({segment}, {quoted(bad)}, {quoted(good)})"
    return f"regexp_replace(translate({segment}, {quoted(texts.PLAIN_FROM)}, {quoted(texts.PLAIN_TO)}), '</?[A-Za-z][^<>]*>', '', 'g')"


def marker_case(words: str) -> str:
    counts = [f"len(list_filter({words}, lambda w: w IN {in_list(m)}))" for m in MARKERS.values()]
    top = f"greatest({', '.join(counts)})"
    return f"CASE WHEN {top} = 0 THEN 'und' " + " ".join(f"WHEN {c} = {top} THEN '{n}'" for n, c in zip(MARKERS, counts)) + " END"


LETTERS = r"'[^\p{L}]+'"
LINES = r"string_split(regexp_replace(replace(text, chr(13) || chr(10), chr(10)), '\n\z', ''), chr(10))"
SCORE = f"round(10 * (least(1, {WORDS} / {N} / 20) * 0.4 + length(regexp_replace(text, '[^A-Za-zÀ-ÿ]', '', 'g')) / greatest(length(text), 1) * 0.3 + least(1, length(text) / 1000) * 0.3), 3)"


def fold(overshoot: bool) -> str:
    full = f"held > {BATCH_BYTES}" if overshoot else f"held + f.n_chars > {BATCH_BYTES}"
    return f"""
WITH RECURSIVE f AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
r AS (
  SELECT source, doc_id, k, CAST(1 AS BIGINT) AS batch, CAST(n_chars AS BIGINT) AS held FROM f WHERE k = 1
  UNION ALL
  SELECT f.source, f.doc_id, f.k, batch + CASE WHEN {full} THEN 1 ELSE 0 END, CASE WHEN {full} THEN 0 ELSE held END + f.n_chars
  FROM r JOIN f ON f.source = r.source AND f.k = r.k + 1)
SELECT doc_id, batch FROM r"""


PARSED = (
    ("http://ththan.example.com/robots.txt", "ththan.example.com/en/7", False), ("http://ththan.example.com/robots.txt", "ththan.example.com/en/79", True),
    ("https://www.tiontion.example.net/robots.txt", "tiontion.example.net/*utm_source=feed$", False), ("https://www.tiontion.example.net/robots.txt", "tiontion.example.net/de/", False),
    ("http://therhe.example.org/robots.txt", "therhe.example.org/en/84", True), ("http://therhe.example.org/robots.txt", "therhe.example.org/en/8", False),
)

#: The same areas by integration on the same grid; of equal costs the fewest rows.
LSH_PARAMS = """
WITH g AS (SELECT (unnest(range(1000)) + 0.5) / 1000 AS s), r AS (SELECT unnest(range(1, 256)) AS rows), t AS (SELECT unnest([0.5, 0.7, 0.8, 0.9]) AS threshold),
c AS (SELECT threshold, 255 // rows AS bands, rows, sum(CASE WHEN s >= threshold THEN pow(1 - pow(s, rows), 255 // rows) ELSE 1 - pow(1 - pow(s, rows), 255 // rows) END) AS cost FROM g, r, t GROUP BY ALL)
SELECT threshold, CAST(bands AS BIGINT) AS bands, CAST(rows AS BIGINT) AS rows FROM c QUALIFY row_number() OVER (PARTITION BY threshold ORDER BY round(cost, 8), rows) = 1"""

SQL = {
    "segment_stats": f"SELECT doc_id, {N} AS segments, {WORDS} AS words, {CHARS} AS chars, {WORDS} / {N} AS word_avg FROM documents",
    "length_filter": "SELECT doc_id FROM documents WHERE length(text) > 500",
    "word_avg_filter": f"SELECT doc_id FROM documents WHERE {WORDS} > 5 * {N}",
    "char_avg_filter": f"SELECT doc_id FROM documents WHERE {CHARS} > 10 * {N}",
    "filter_reason": f"SELECT doc_id, {REASON} AS filter FROM documents",
    "filter_reason_stats": f"SELECT filter, n AS count, printf('%.2f%%', n / sum(n) OVER () * 100) AS pct FROM ({STATS('')})",
    "stats_pivot": f"""
WITH s AS (SELECT lang, filter, printf('%.2f%%', n / sum(n) OVER (PARTITION BY lang) * 100) AS pct FROM ({STATS('lang, ')}))
SELECT lang, {', '.join(f"coalesce(max(CASE WHEN filter = '{r}' THEN pct END), '') AS {r}" for r in ('keep', 'length_500', 'word_avg_5'))} FROM s GROUP BY lang""",
    "run_counters": "SELECT total, kept, total - kept AS removed, round(kept / total * 100, 2) AS kept_pct FROM (SELECT count(*) AS total, count(*) FILTER (WHERE length(text) > 500) AS kept FROM documents)",
    "size_totals": "SELECT lang, source, CAST(sum(strlen(text)) AS BIGINT) AS bytes, count(*) AS docs FROM documents GROUP BY ALL",
    "url_strip_prefix": f"SELECT page_id, {KEY} AS key FROM pages",
    "url_host": f"SELECT page_id, {HOST} AS host FROM pages",
    "host_shorten": f"SELECT page_id, {SHORT(HOST)} AS shorter1, {SHORT(SHORT(HOST))} AS shorter2 FROM pages",
    "adult_filter": adult(False),
    "adult_filter_extended": adult(True),
    "batch_names": f"SELECT path, replace(regexp_replace(regexp_replace(path, '_0+', '_', 'g'), '/0+', '/', 'g'), 'batch_', '') AS name FROM ({inline.values(inline.PATHS, 'path')})",
    "crawl_names": f"""SELECT file, CASE WHEN regexp_matches(file, '^(GO_JP|GOV_AR)') THEN 'wide00006' WHEN starts_with(file, 'WIDE') THEN 'wide'
WHEN regexp_matches(file, '^CC-MAIN-[0-9]{{4}}') THEN substr(file, 1, 12) WHEN starts_with(file, 'archivebot') THEN 'archivebot' END AS crawl FROM ({inline.values(inline.FILES, 'file')})""",
    "robots_parse": inline.values(PARSED, "u, pattern, allowed"),
    "robots_disallowed": f"WITH {DISALLOWED} SELECT url FROM gone",
    "robots_annotate": f"WITH {DISALLOWED} SELECT page_id, {KEY} NOT IN (SELECT url FROM gone) AS allowed FROM pages",
    "robots_filter": f"WITH {DISALLOWED} SELECT page_id, url FROM pages WHERE {KEY} NOT IN (SELECT url FROM gone)",
    "exact_dedup": "SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
    "exact_dup_report": r"SELECT sha256(regexp_replace(text, '\s+$', '')) AS digest, count(*) AS copies FROM documents GROUP BY 1 HAVING count(*) > 1",
    "minhash_signature": f"WITH {minhash()} SELECT doc_id, sig FROM documents LEFT JOIN sig USING (doc_id)",
    "lsh_params": LSH_PARAMS,
    "lsh_bands": f"WITH {minhash()}, {bands()} SELECT * FROM band",
    "lsh_single_band": f"WITH {minhash()}, {bands('[3]')} SELECT * FROM band",
    "near_dup_edges": f"WITH {minhash()}, {bands()}, {edges()} SELECT * FROM edge",
    "near_dup_components": clusters("SELECT doc_id, component FROM comp"),
    "near_dedup": clusters("SELECT d.doc_id, d.lang, n AS cluster_size FROM documents d JOIN comp USING (doc_id) JOIN (SELECT component, count(*) AS n FROM comp GROUP BY 1) USING (component) WHERE d.doc_id = component"),
    "near_dups_only": clusters(KEPT.format("doc_id, lang", "<>")),
    "cluster_sizes": clusters("SELECT component, count(*) AS cluster_size FROM comp GROUP BY component"),
    "near_dedup_by_scope": clusters(f"SELECT d.doc_id, {SCOPE} AS scope FROM documents d JOIN comp USING (doc_id) WHERE d.doc_id = component", scope=SCOPE),
    "near_dedup_char": clusters(KEPT.format("doc_id", "="), "char"),
    "near_dedup_vectorizer": clusters(KEPT.format("doc_id", "="), "vectorizer"),
    "near_dedup_verified": clusters(KEPT.format("doc_id", "="), more=VERIFIED).replace("FROM edge UNION SELECT dst, src FROM edge", "FROM agreed UNION SELECT dst, src FROM agreed"),
    "lang_map_join": f"SELECT doc_id, CASE WHEN doc_id % 100 / 100 < 0.5 THEN 'unk' ELSE coalesce(canonical, 'unk') END AS label FROM documents LEFT JOIN ({LANG_LABEL}) ON lang = flores_code",
    "lang_partition": f"SELECT coalesce(canonical, 'unk') AS label, CAST(sum(strlen(text)) AS BIGINT) AS bytes, count(*) AS docs FROM documents LEFT JOIN ({LANG_LABEL}) ON lang = flores_code GROUP BY 1",
    "lang_wds_map": f"""
SELECT code,
  CASE WHEN code IN ('und', 'unk') THEN code WHEN {CODE} IN ('prs', 'pes') THEN 'fas_' || {SCRIPT} WHEN {CODE} IN ('cmn', 'yue') THEN 'zho_' || {SCRIPT}
       WHEN code = 'zsm_Latn' THEN 'msa_Latn' WHEN code = 'swa_Latn' THEN 'swh_Latn' WHEN {CODE} IN {in_list(langs.ARABIC)} THEN 'arb_' || {SCRIPT}
       WHEN {CODE} IN ('lvs', 'ltg') THEN 'lav_Latn' ELSE code END AS score_lang,
  CASE WHEN {SCRIPT} IN ('Hans', 'Hant') THEN 'zh' ELSE coalesce({lang_case(ISO, CODE)}, CASE WHEN {CODE} = 'hbs' THEN 'hbs' END, {lang_case(OF_MACRO, CODE)}, 'any') END AS fixing_lang,
  CASE WHEN {CODE} = 'hbs' THEN 'hbs' ELSE coalesce({lang_case(ISO, CODE)}, 'any') END AS pii_lang,
  {CODE} IN {in_list(langs.CJK)} AS cjk
FROM ({inline.values(inline.CODES, 'code')})""",
    "register_lang_gate": f"SELECT code, substr(code, 1, 3) IN {in_list(langs.REGISTER_LANGS)} AS supported, CASE WHEN code IN {in_list(langs.OWN_SCOPE)} THEN 'c1' ELSE 'global' END AS scope FROM ({inline.values(inline.CODES, 'code')})",
    "positional_merge": "SELECT doc_id AS line_no, source AS crawl_id, lang, length(text) AS chars FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0 AND length(text) > 0 AND doc_id % 100 / 100 > 0.5",
    "tsv_group": "SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text, list(role ORDER BY turn) AS roles FROM conversations GROUP BY conv_id",
    "secrets_list": f"SELECT DISTINCT secret FROM (SELECT unnest(regexp_extract_all(text, {quoted(texts.SECRET)}, 1)) AS secret FROM documents) WHERE length(secret) > 10",
    "secrets_filter": f"""
WITH s AS (SELECT DISTINCT secret FROM (SELECT unnest(regexp_extract_all(text, {quoted(texts.SECRET)}, 1)) AS secret FROM documents) WHERE length(secret) > 10)
SELECT doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM s WHERE contains(text, secret))""",
    "pii_spans": " UNION ALL ".join(
        f"""SELECT doc_id, '{k}' AS kind, v[i] AS value, CAST(before AS INTEGER) AS span_start, CAST(before + length(v[i]) AS INTEGER) AS span_end FROM (
  SELECT doc_id, v, i, list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(v[1:i - 1], lambda x: length(x))), 0) AS before
  FROM (SELECT doc_id, v, p, unnest(range(1, len(v) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, {quoted(p)}) AS v, string_split_regex(text, {quoted(p)}) AS p FROM documents)))""" for k, p in texts.PII.items()
    ),
    "text_fix": f"SELECT doc_id, md5(array_to_string(list_transform(string_split(text, chr(10)), lambda s: CASE WHEN length(s) < {texts.FIX_BELOW} THEN {fixed('s')} ELSE s END), chr(10))) AS digest FROM documents",
    "replacement_char_filter": "SELECT doc_id FROM documents WHERE doc_id % 9 <> 0 AND doc_id % 5 <> 0",
    "clean": f"SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE {REASON} = 'keep' AND quality * 10 >= 5 AND (doc_id % 3 <> 0 OR doc_id % 2 = 0)",
    "clean_pipeline": f"""
WITH u AS (SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1)
SELECT lang, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars FROM u WHERE {REASON} = 'keep' AND {SCORE} >= 5 GROUP BY lang""",
    "collection_union": "SELECT doc_id, CASE WHEN source = 'src1' THEN lang END AS lang, CASE WHEN source <> 'src1' THEN source END AS source FROM documents WHERE source IS NOT NULL",
    "size_batches": f"SELECT doc_id, source, CAST(floor(coalesce(sum(strlen(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / {BATCH_BYTES}) AS BIGINT) + 1 AS batch FROM documents",
    "pack_files": fold(False),
    "rotate_batches": fold(True),
    "status_matrix": """
SELECT source, CASE WHEN a = 0 THEN 'none' WHEN b = 0 OR c <> 0 THEN 'batched' WHEN d = 0 OR e <> 0 THEN 'deduped' ELSE 'annotated' END AS status
FROM (SELECT source, count(*) AS a, count(*) FILTER (WHERE n_chars > 500) AS b, count(*) FILTER (WHERE n_chars < 5) AS c,
             count(*) FILTER (WHERE n_chars > 9000) AS d, count(*) FILTER (WHERE n_chars < 8) AS e FROM documents GROUP BY source)""",
    "doc_id_hash": "SELECT page_id, md5('f' || url || CAST(page_id AS VARCHAR)) AS id FROM pages",
    "seeded_sample": "SELECT doc_id, lang FROM documents ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 200",
    "first_per_key": "SELECT min(doc_id) AS doc_id, lang FROM documents GROUP BY lang",
    "document_numbers": "SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) - 1 AS line_no FROM documents",
    "seg_langid": f"SELECT doc_id, CASE WHEN text = '' THEN [] ELSE list_transform({LINES}, lambda s: {marker_case(f'string_split_regex(lower(s), {LETTERS})')}) END AS seg_langs FROM documents",
    "doc_scores": f"SELECT doc_id, {SCORE} AS score FROM documents",
    "web_registers": "SELECT doc_id, " + ", ".join(
        f"round(1 / (1 + exp(2 - 40 * (len(list_filter(w, lambda x: x IN {in_list(m)})) / len(w)))), 3) AS {k}" for k, m in BASELINE.items()
    ) + f" FROM (SELECT doc_id, string_split_regex(lower(text), {LETTERS}) AS w FROM documents)",
    "char_tokens": r"SELECT doc_id, len(list_distinct(list_transform(range(1, length(text) + 1, 3), lambda i: substr(text, i, 3)))) AS windows, len(list_distinct(list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> ''))) AS words FROM documents",
}
