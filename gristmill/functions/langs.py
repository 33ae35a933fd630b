"""Language codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CJK = ("jpn", "kor", "yue", "zho", "cmn")
ARABIC = ("ara", "acm", "acq", "aeb", "apc", "arb", "ars", "ary", "arz")
#: ISO 639: two-letter code and three-letter code of each language that has both.
_PAIRS = (
    "aa:aar ab:abk ae:ave af:afr ak:aka am:amh an:arg ar:ara as:asm av:ava ay:aym az:aze ba:bak be:bel bg:bul bi:bis bm:bam bn:ben bo:bod br:bre bs:bos ca:cat ce:che ch:cha co:cos cr:cre"
    " cs:ces cu:chu cv:chv cy:cym da:dan de:deu dv:div dz:dzo ee:ewe el:ell en:eng eo:epo es:spa et:est eu:eus fa:fas ff:ful fi:fin fj:fij fo:fao fr:fra fy:fry ga:gle gd:gla gl:glg gn:grn"
    " gu:guj gv:glv ha:hau he:heb hi:hin ho:hmo hr:hrv ht:hat hu:hun hy:hye hz:her ia:ina id:ind ie:ile ig:ibo ii:iii ik:ipk io:ido is:isl it:ita iu:iku ja:jpn jv:jav ka:kat kg:kon ki:kik"
    " kj:kua kk:kaz kl:kal km:khm kn:kan ko:kor kr:kau ks:kas ku:kur kv:kom kw:cor ky:kir la:lat lb:ltz lg:lug li:lim ln:lin lo:lao lt:lit lu:lub lv:lav mg:mlg mh:mah mi:mri mk:mkd ml:mal"
    " mn:mon mr:mar ms:msa mt:mlt my:mya na:nau nb:nob nd:nde ne:nep ng:ndo nl:nld nn:nno no:nor nr:nbl nv:nav ny:nya oc:oci oj:oji om:orm or:ori os:oss pa:pan pi:pli pl:pol ps:pus pt:por"
    " qu:que rm:roh rn:run ro:ron ru:rus rw:kin sa:san sc:srd sd:snd se:sme sg:sag si:sin sk:slk sl:slv sm:smo sn:sna so:som sq:sqi sr:srp ss:ssw st:sot su:sun sv:swe sw:swa ta:tam te:tel"
    " tg:tgk th:tha ti:tir tk:tuk tl:tgl tn:tsn to:ton tr:tur ts:tso tt:tat tw:twi ty:tah ug:uig uk:ukr ur:urd uz:uzb ve:ven vi:vie vo:vol wa:wln wo:wol xh:xho yi:yid yo:yor za:zha zh:zho zu:zul"
)
TWO_LETTER = {pair[3:]: pair[:2] for pair in _PAIRS.split()}
#: Languages that belong to a macro language, under its two-letter code.
MACRO = {
    code: macro
    for macro, codes in {
        "ar": "acm acq aeb apc arb ars ary arz", "ay": "ayc ayr", "az": "azb azj", "et": "ekk vro", "fa": "pes prs", "ff": "fub fuc fuf fuv", "gn": "gug", "kr": "knc", "ku": "ckb kmr sdh", "lv": "ltg lvs",
        "mg": "plt", "mn": "khk", "ms": "bjn min zsm", "ne": "dty npi", "om": "gaz hae", "or": "ory spv", "ps": "pbt pbu pst", "qu": "quy quz", "sq": "aln als", "sw": "swc swh", "uz": "uzn uzs", "yi": "ydd yih",
        "zh": "cmn hak nan wuu yue",
    }.items()
    for code in codes.split()
}
REGISTER_LANGS = (
    "afr als amh ara asm azb azj bel ben bul cat ces ckb cmn cym dan deu ekk ell eng epo eus fas fil fin fra gaz gla gle glg guj hau hbs heb hin hun hye ind isl"
    " ita jav jpn kan kat kaz khk khm kir kmr kor lao lit lvs mal mar mkd mya nld nno nob npi ory pan pbt plt pol por ron rus san sin slk slv snd som spa sun swe"
    " swh tam tel tha tur uig ukr urd uzn vie xho ydd yue zsm"
).split()
#: Languages whose collections are deduplicated one by one.
OWN_SCOPE = ("eng_Latn", "rus_Cyrl", "cmn_Hans")


def code(lang: Column) -> Column:
    return F.substring_index(lang, "_", 1)


def script(lang: Column) -> Column:
    return F.substring_index(lang, "_", -1)


def is_cjk(lang: Column) -> Column:
    return code(lang).isin(*CJK)


def score_lang(lang: Column) -> Column:
    """The code under which the quality scorer knows a language."""
    c, s = code(lang), script(lang)
    return (
        F.when(lang.isin("und", "unk"), lang)
        .when(c.isin("prs", "pes"), F.concat(F.lit("fas_"), s))
        .when(c.isin("cmn", "yue"), F.concat(F.lit("zho_"), s))
        .when(lang == "zsm_Latn", "msa_Latn")
        .when(lang == "swa_Latn", "swh_Latn")
        .when(c.isin(*ARABIC), F.concat(F.lit("arb_"), s))
        .when(c.isin("lvs", "ltg"), "lav_Latn")
        .otherwise(lang)
    )


def _look_up(key: Column, table: dict[str, str]) -> Column:
    """By a literal map, however long the table is."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def fixing_lang(lang: Column) -> Column:
    """The code by which characters are fixed: script, two letters, macro language, or ``any``."""
    c = code(lang)
    return F.when(script(lang).isin("Hans", "Hant"), "zh").otherwise(F.coalesce(_look_up(c, TWO_LETTER), F.when(c == "hbs", "hbs"), _look_up(c, MACRO), F.lit("any")))


def pii_lang(lang: Column) -> Column:
    c = code(lang)
    return F.when(c == "hbs", "hbs").otherwise(F.coalesce(_look_up(c, TWO_LETTER), F.lit("any")))


def has_registers(lang: Column) -> Column:
    return F.substring(lang, 1, 3).isin(*REGISTER_LANGS)


def dedup_scope(lang: Column, collection: Column) -> Column:
    return F.when(lang.isin(*OWN_SCOPE), collection).otherwise("global")
