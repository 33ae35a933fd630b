"""Small tables that the driver's data lacks, the same for Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROBOTS = (
    ("http://ththan.example.com/robots.txt", "User-agent: Foo\nUser-agent: *\nDisallow: /en/7\nAllow: /en/79 # c\n\nDisallow: /ignored\nUser-agent: Other\nDisallow: /other"),
    ("https://www.tiontion.example.net/robots.txt", "# all\nUser-agent: CCBot\r\nDisallow: /*utm_source=feed$\nDisallow: /de/\n"),
    ("http://therhe.example.org/robots.txt", "User-agent: ia_archiver\nAllow: /en/84\nDisallow: /en/8\n"),
    ("http://nothing.example.org/robots.txt", "User-agent: *\nAllow: /\n"),
)
#: (robots.txt, rule_idx, pattern, allowed)
RULES = (
    ("a", 1, "blog.tionsh.example.net/", False), ("a", 2, "blog.tionsh.example.net/fr/", True), ("a", 3, "blog.tionsh.example.net/*#top$", False),
    ("b", 1, "thther.example.org/*page=2", False), ("b", 2, "thther.example.org/en/7", True), ("b", 3, "thther.example.org/en/76", False),
    ("c", 1, "blog.ththan.example.net/fr", True), ("c", 2, "blog.ththan.example.net/*", False), ("d", 1, "m.ththth.example.net/en/25", False),
    ("e", 1, "ththhe.example.com/*.html$", False), ("f", 1, "ththhe.example.com/", True),
)
DOMAINS = (("adult-x.example.net",), ("cheap-pills.example.com",), ("free-bets.example.com",), ("example.org",))
#: (flores_code, canonical, script)
LANG_MAP = (("en", "eng_Latn", "Latn"), ("de", "deu_Latn", "Latn"), ("fr", "fra_Latn", "Latn"))
#: The codes of a web corpus by script, and some that need care.
SCRIPTS = {
    "Latn": "ace afr als ast ayr azj bam ban bem bjn bos bug cat ceb ces cjk crh cym dan deu dik ekk eng epo eus ewe fao fij fil fin fon fra frp fur fuv gaz gla gle glg gug hat hau hrv hun ibo ilo ind isl ita"
    " jav kab kac kam kbp kea kik kin kmb kmr knc ktu lat lij lim lin lit lmo ltg ltz lua lug luo lus lvs min mlt mos mri nld nno nob nso nus nya oci pag pap plt pol por quy ron run sag scn slk slv smo sna som sot spa"
    " srd ssw sun swe swh szl taq tpi tsn tso tuk tum tur twi umb uzn vec vie war wol xho yor zsm zul",
    "Cyrl": "bak bel bul kaz khk kir mkd rus srp tat tgk ukr hbs", "Arab": "ace ara fas arb azb bjn ckb kas knc min pbt prs pes snd uig urd ary acm aeb", "Deva": "awa bho hin hne kas mag mai mar npi san",
    "Hans": "cmn zho", "Hant": "cmn yue", "Beng": "asm ben mni", "Ethi": "amh tir", "Hebr": "heb ydd", "Tibt": "bod dzo", "Tfng": "taq zgh", "Mymr": "mya shn", "Grek": "ell", "Armn": "hye", "Geor": "kat", "Gujr": "guj",
    "Guru": "pan", "Hang": "kor", "Jpan": "jpn", "Khmr": "khm", "Knda": "kan", "Laoo": "lao", "Mlym": "mal", "Olck": "sat", "Orya": "ory", "Sinh": "sin", "Taml": "tam", "Telu": "tel", "Thai": "tha", "Zxxx": "zxx",
}
CODES = tuple((f"{c}_{s}",) for s, codes in SCRIPTS.items() for c in codes.split()) + (("und",), ("unk",), ("swa_Latn",))
PATHS = (("batch_0007",), ("a/007/batch_010",), ("x_0_00",), ("plain",))
FILES = (("CC-MAIN-2019-35-x.warc.gz",), ("GOV_AR-1.warc",), ("WIDE-2015.warc",), ("archivebot-3.warc",), ("other.warc",))


def _literal(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value) if isinstance(value, (int, float)) else "'" + value.replace("'", "''") + "'"


def values(rows: tuple, names: str) -> str:
    """A query of literal rows, for either engine."""
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(_literal, r)) + ')' for r in rows)}) AS t({names})"


def frame(spark: SparkSession, rows: tuple, names: str) -> DataFrame:
    return spark.sql(values(tuple(tuple(x.replace("\\", "\\\\") if isinstance(x, str) else x for x in r) for r in rows), names))
