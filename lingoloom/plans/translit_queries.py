"""Queries of the transliteration over the words of the shared tables, with SQL that spells every letter by the same rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingoloom.functions import text as T
from lingoloom.functions.dsl import RULES, choice
from lingoloom.functions.profile import LATIN_ALPHABET
from lingoloom.functions.translit import AFTER_TS, MONTHS, NATIVE_FRAGMENTS, NATIVE_PREFIXES, PLAIN, convert, word_dimension
from lingoloom.operators import dictionary
from lingoloom.operators.kept import Kept
from lingoloom.operators.training import training_pairs
from lingoloom.sources.tables import spread

from . import bridge
from .registry import query

#: Stems that rules name, beside those of the tables.
STEMS = ("закончалык", "интриг", "музы", "посыл", "выш", "сыр", "европ", "евраз", "епископ", "ефәк", "проект", "металл", "фигыль", "кәгаз", "мәшгуль", "коръән", "шигыр", "җилкуар", "гади", "гадиләштер", "әдәбия", "әүлия", "риялы", "ящик", "яшь", "щё", "бю", "кц", "оу", "ие", "ия", "ье", "ьо", "ья", "ъю", "лау", "кубка", "шия", "ткан", "эч", "йөр", "чия")
LEXICON = tuple(dict.fromkeys([r[0] for r in (*NATIVE_PREFIXES, *NATIVE_FRAGMENTS, *MONTHS)] + list(STEMS)))
W = "[А-Яа-яЁёӘәӨөҮүҖҗҢңҺһ]+"


def stemmed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word): every distinct word of the documents, half of them behind a stem of the lexicon that their hashes name, and the stems."""
    words = bridge.lines(spark, sf_dir).select(F.explode(T.words_in(F.col("sentence"))).alias("word")).distinct()
    nth = (F.conv(F.substring(F.md5("word"), 1, 6), 16, 10).cast("int") % len(LEXICON)) + 1
    stem = F.element_at(F.array(*map(F.lit, LEXICON)), nth)
    own = F.when(F.substring(F.md5("word"), 7, 1) < "8", F.concat(stem, "word")).otherwise(F.col("word"))
    return words.select(F.explode(F.array(own, stem)).alias("word")).distinct()


def _list(values: tuple) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _rows(rows: tuple) -> str:
    return "[" + ", ".join(f"{{'c': '{c}', 'a': '{a}', 'b': '{b}'}}" for c, a, b in rows) + "]"


def _case(subject: str, pairs: dict[str, str]) -> str:
    return f"CASE {subject} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + " END"


FRONT, BACK = "әеөүи", "аоуы"
_V = f"{FRONT}э{BACK}юя"
_FIRST_E = "CASE WHEN regexp_matches(word, '^(европ|евраз|епископ|ефәк)') OR others = 'front_only' THEN 'ye' WHEN others = 'mixed' THEN '' ELSE 'yı' END"
_TS = f"CASE WHEN ends_with(b, 'ц') THEN '' WHEN starts_with(a, 'ц') THEN 'ts' WHEN a = '' THEN 's' WHEN regexp_matches(b, '[{FRONT}{BACK}еёюя]$') THEN 'ts' ELSE 's' END"
_HARMONIC = "CASE harmony WHEN 'front_only' THEN '{0}' WHEN 'back_only' THEN '{1}' ELSE '' END"
_BY = "CASE beside WHEN 'front' THEN '{0}' WHEN 'back' THEN '{1}' ELSE CASE near WHEN 'front' THEN '{0}' WHEN 'back' THEN '{1}' ELSE " + _HARMONIC + " END END"
_YA_END = "CASE near WHEN 'front' THEN 'yä' WHEN 'back' THEN 'ya' ELSE CASE others WHEN 'front_only' THEN 'yä' WHEN 'mixed' THEN '' ELSE 'ya' END END"
_YA = "CASE WHEN ends_with(b, 'и') THEN 'ä' WHEN regexp_matches(b, '[ьъ]$') THEN 'ya' {0} WHEN b = '' AND (word = 'я' OR starts_with(word, 'яшь')) THEN 'yä' WHEN word = 'ящик' THEN 'ya' ELSE " + _YA_END + " END"
_GLIDE = "CASE WHEN regexp_matches(b, '[аәя]$') THEN 'w' ELSE '{0}' END"

_NATIVE = f"""CASE c
  WHEN 'в' THEN CASE WHEN regexp_matches(b, '[иә]е$') THEN 'v' ELSE 'w' END
  WHEN 'г' THEN CASE WHEN starts_with(a, 'ъ') THEN 'ğ' ELSE {_BY.format('g', 'ğ')} END
  WHEN 'к' THEN CASE WHEN starts_with(a, 'ъ') OR starts_with(a, 'ыч') THEN 'q' WHEN starts_with(a, 'еч') THEN 'k' ELSE {_BY.format('k', 'q')} END
  WHEN 'у' THEN {_GLIDE.format('u')} WHEN 'ү' THEN {_GLIDE.format('ü')}
  WHEN 'ю' THEN CASE WHEN word = 'ю' OR ends_with(b, 'и') THEN 'yü' ELSE CASE near WHEN 'front' THEN 'yü' WHEN 'back' THEN 'yu' ELSE CASE harmony WHEN 'no_vowels' THEN 'yu' WHEN 'front_only' THEN 'yü' WHEN 'back_only' THEN 'yu' ELSE '' END END END
  WHEN 'я' THEN {_YA.format('')}
  WHEN 'е' THEN CASE WHEN regexp_matches(b, '[иү]$') THEN 'e' WHEN regexp_matches(b, '[ьъ]$') THEN CASE WHEN starts_with(a, 'л') THEN 'yı' ELSE 'ye' END WHEN b = '' THEN {_FIRST_E} WHEN regexp_matches(b, '[аоуы]$') THEN 'yı' WHEN regexp_matches(b, '[әө]$') THEN 'ye' ELSE 'e' END
  WHEN 'ц' THEN {_TS}
  ELSE coalesce({_case('c', PLAIN)}, '') END"""

_LOAN_GK = r"""CASE WHEN length(b) >= 5 AND c || a IN ('га', 'ган', 'гын') THEN 'ğ' WHEN length(b) >= 5 AND c || a IN ('гә', 'гән', 'ген') THEN 'g'
  WHEN length(b) >= 7 AND c || a = 'гы' AND regexp_matches(b, '[дт]а$') THEN 'ğ' WHEN length(b) >= 7 AND c || a = 'ге' AND regexp_matches(b, '[дт]ә$') THEN 'g'
  WHEN length(b) >= 5 AND c || a IN ('ка', 'кә') AND ends_with(b, 'л') THEN 'k' WHEN length(b) >= 5 AND c || a = 'ка' THEN 'q' WHEN length(b) >= 5 AND c || a = 'кә' THEN 'k'
  WHEN c || a = 'к' AND ends_with(b, 'лы') AND length(b) >= 6 THEN 'q' WHEN c || a = 'к' AND ends_with(b, 'ле') AND length(b) >= 6 THEN 'k' WHEN c = 'г' THEN 'g' ELSE 'k' END"""

_LOAN = f"""CASE c
  WHEN 'в' THEN 'v' WHEN 'г' THEN {_LOAN_GK} WHEN 'к' THEN {_LOAN_GK} WHEN 'у' THEN 'u' WHEN 'ү' THEN 'ü' WHEN 'ю' THEN 'yu'
  WHEN 'я' THEN {_YA.format("WHEN b <> '' THEN 'ya'")}
  WHEN 'е' THEN CASE WHEN a = 'ц' AND ends_with(b, 'е') THEN 'ye' WHEN a IN ('ц', 'ец') THEN 'e' WHEN regexp_matches(b, '[иү]$') THEN 'e' WHEN regexp_matches(b, '[ьъ]$') THEN 'ye' WHEN b = '' THEN {_FIRST_E}
    WHEN ends_with(b, 'ә') AND starts_with(a, 'в') THEN 'ye' WHEN ends_with(b, 'у') THEN 'e' WHEN regexp_matches(b, '[{BACK}]$') AND a = '' THEN 'yı' WHEN regexp_matches(b, '[{FRONT}{BACK}]$') THEN 'ye' ELSE 'e' END
  WHEN 'ц' THEN CASE WHEN a = '' AND ends_with(b, 'е') THEN 'ts' ELSE {_TS} END
  WHEN 'ы' THEN CASE WHEN regexp_matches(word, '^(музы|посыл|выш|сыр)') THEN 'ıy' ELSE 'ı' END
  WHEN 'ь' THEN CASE WHEN starts_with(a, 'е') THEN '' ELSE 'ʼ' END WHEN 'ъ' THEN CASE WHEN starts_with(a, 'е') THEN '' ELSE 'ʼ' END
  ELSE coalesce({_case('c', PLAIN)}, '') END"""

WORDS_SQL = f"""{bridge.LINES_SQL},
plain_words AS (SELECT DISTINCT unnest(list_transform(regexp_extract_all(sentence, '{W}'), lambda w: replace(lower(w), 'ё', 'е'))) AS word FROM lines),
stems AS (SELECT word, {_list(LEXICON)}[1 + ('0x' || substr(md5(word), 1, 6))::INT % {len(LEXICON)}] AS stem FROM plain_words),
w AS (SELECT CASE WHEN substr(md5(word), 7, 1) < '8' THEN stem || word ELSE word END AS word FROM stems UNION SELECT stem FROM stems)"""
CONVERTED_SQL = f"""harmonies AS (SELECT word, CASE WHEN regexp_matches(word, '[{FRONT}]') AND regexp_matches(word, '[{BACK}]') THEN 'mixed_front_back' WHEN regexp_matches(word, '[{FRONT}]') THEN 'front_only' WHEN regexp_matches(word, '[{BACK}]') THEN 'back_only' ELSE 'no_vowels' END AS harmony FROM w),
letters AS (SELECT word, harmony, i, substr(word, i, 1) AS c, substr(word, 1, i - 1) AS b, substr(word, i + 1) AS a FROM (SELECT *, unnest(generate_series(1, length(word))) AS i FROM harmonies)),
vowels AS (SELECT *, coalesce(nullif(regexp_extract(b, '([{_V}])[^{_V}-]*$', 1), ''), regexp_extract(a, '^[^{_V}-]*([{_V}])', 1)) AS v FROM letters),
contexts AS (SELECT *, CASE WHEN v = '' THEN '' WHEN contains('{FRONT}э', v) THEN 'front' ELSE 'back' END AS near,
  CASE WHEN regexp_matches(a, '^[{FRONT}э]') THEN 'front' WHEN regexp_matches(a, '^[{BACK}я]') THEN 'back' ELSE '' END AS beside,
  CASE WHEN regexp_matches(b || a, '[{FRONT}э]') AND regexp_matches(b || a, '[{BACK}]') THEN 'mixed' WHEN regexp_matches(b || a, '[{FRONT}э]') THEN 'front_only' WHEN regexp_matches(b || a, '[{BACK}]') THEN 'back_only' ELSE 'none' END AS others FROM vowels),
pieces AS (SELECT word, i, c, a, b, {_NATIVE} AS n_piece, {_LOAN} AS l_piece FROM contexts),
spelt AS (SELECT word, string_agg(n_piece, '' ORDER BY i) AS n_bare, string_agg(l_piece, '' ORDER BY i) AS l_bare FROM pieces GROUP BY word),
found AS (SELECT *, list_filter({_rows(NATIVE_PREFIXES)}, lambda r: starts_with(word, r.c) AND starts_with(n_bare, r.a))[1] AS p, list_filter({_rows(NATIVE_FRAGMENTS)}, lambda r: contains(word, r.c) AND contains(n_bare, r.a))[1] AS f FROM spelt),
lexical AS (SELECT *, CASE WHEN p IS NOT NULL THEN p.b || substr(n_bare, length(p.a) + 1) WHEN f IS NOT NULL THEN substr(n_bare, 1, instr(n_bare, f.a) - 1) || f.b || substr(n_bare, instr(n_bare, f.a) + length(f.a)) ELSE n_bare END AS n_lex,
  CASE WHEN starts_with(word, 'закончалык') AND starts_with(l_bare, 'zakonçalık') THEN 'zakonçalıq' || substr(l_bare, 11) WHEN starts_with(word, 'интриг') AND starts_with(l_bare, 'intriğ') THEN 'intrig' || substr(l_bare, 7)
    WHEN ends_with(word, 'лау') AND ends_with(l_bare, 'lau') THEN regexp_replace(l_bare, 'u$', 'w') WHEN ends_with(word, 'ләү') AND ends_with(l_bare, 'läü') THEN regexp_replace(l_bare, 'ü$', 'w') ELSE l_bare END AS l_lex FROM found),
surnames AS (SELECT *, CASE WHEN regexp_matches(word, '^(гәлим|гилем)') AND ends_with(word, 'ова') THEN regexp_replace(n_lex, 'owa$', 'ova') WHEN regexp_matches(word, '^(гәлим|гилем)') AND ends_with(word, 'ов') THEN regexp_replace(n_lex, 'ow$', 'ov') ELSE n_lex END AS n_full FROM lexical),
converted AS (SELECT word, n_bare, l_bare, CASE WHEN regexp_full_match(n_full, '[{LATIN_ALPHABET.replace("-", "")}—-]+') THEN n_full ELSE '' END AS native, CASE WHEN regexp_full_match(l_lex, '[{LATIN_ALPHABET.replace("-", "")}—-]+') THEN l_lex ELSE '' END AS loan FROM surnames)"""


@query(f"WITH {WORDS_SQL}, {CONVERTED_SQL} SELECT word, native, loan FROM converted")
def converted_words(spark, sf_dir):
    """Native and loan conversions of every word, letter by letter and by the lexical conventions."""
    w = F.col("word")
    return stemmed_words(spark, sf_dir).select("word", convert(w, "N").alias("native"), convert(w, "RL").alias("loan"))


#: A character that stands for each choice until the end, so that no later step reads its text.
_CHOICES: dict[str, str] = {}
#: What each choice resolves to by default.
_PREFERRED: dict[str, str] = {}


def _mark(rule: str, options: tuple[tuple[str, str], ...] | None = None) -> str:
    text = choice(rule, options)
    _PREFERRED[text] = dict(options or RULES[rule].options)[RULES[rule].default]
    return _CHOICES.setdefault(text, chr(0xE000 + len(_CHOICES)))


def _count(text: str, what: str) -> str:
    return f"((length({text}) - length(replace({text}, '{what}', ''))) // {len(what)})"


def _equally_often(cyrillic: str, latin: str, text: str) -> str:
    return f"({_count('word', cyrillic)} > 0 AND {_count('word', cyrillic)} = {_count(text, latin)})"


def _months(o: str) -> str:
    tests = " ".join(f"WHEN starts_with(word, '{c}') AND starts_with({o}, '{a}') THEN regexp_replace({o}, '^{a}', '{_mark('MONTH_NAME', (('ordinary', a), ('pdf', b)))}')" for c, a, b in MONTHS)
    return f"CASE {tests} ELSE {o} END"


_STEMMED = (("металл", "metall", "meta" + _mark("FINAL_DOUBLE_L")), ("фигыль", "fiğıl", _mark("FIGYL_STEM")), ("иҗтимагый", "ictimaği", _mark("IJTIMAGIY_STEM")), ("кәгаз", "käğaz", _mark("KAGAZ_STEM")), ("мәшгуль", "mäşğul", _mark("MASHGUL_STEM")), ("коръән", "qorän", "qor" + _mark("HAMZA") + "än"))


def _stem(o: str) -> str:
    tests = " ".join(f"WHEN starts_with(word, '{c}') THEN regexp_replace({o}, '^{a}', '{b}')" for c, a, b in _STEMMED)
    return f"CASE WHEN contains(word, 'шигыр') THEN replace({o}, 'şiğır', '{_mark('SHIGYR_STEM')}') WHEN contains(word, 'ерзя') THEN regexp_replace({o}, '^(.*?)erzya', '\\1erz{_mark('YA')}') {tests} ELSE {o} END"


def _iya(o: str) -> str:
    special = f"CASE WHEN regexp_matches(word, '^(әдәбия|әүлия|риялы)') THEN 'i{_mark('IYA', (('compact', 'a'), ('explicit', 'ya')))}' ELSE 'i{_mark('IYA')}' END"
    return f"CASE WHEN {_equally_often('ия', 'iä', o)} THEN replace({o}, 'iä', {special}) ELSE {o} END"


def _ie(o: str) -> str:
    return f"CASE WHEN {_equally_often('ие', 'ie', o)} AND NOT regexp_matches(word, '(ие|әе)ва?$') THEN replace({o}, 'ie', 'i{_mark('IE_GLIDE')}') ELSE {o} END"


def _swap(o: str, test: str, what: str, to: str) -> str:
    return f"CASE WHEN {test} THEN replace({o}, '{what}', '{to}') ELSE {o} END"


def _final_ka(o: str) -> str:
    mark = _mark("RL_FINAL_KA") + "a"
    return f"CASE WHEN word = 'кубка' THEN regexp_replace({o}, 'ka$', '{mark}') WHEN ends_with(word, 'ка') THEN regexp_replace({o}, 'qa$', '{mark}') ELSE {o} END"


def _final_ts(o: str) -> str:
    mark = _mark("FINAL_TS_SUFFIX")
    return f"CASE WHEN n_ts = 0 OR n_ts > {_count(o, 'ts')} THEN {o} WHEN n_ts = {_count(o, 'ts')} THEN replace({o}, 'ts', '{mark}') ELSE regexp_replace({o}, '^(.*?)ts', '\\1{mark}') END"


def _jotated(o: str) -> str:
    """Each y that a consonant softens, in order: the state runs through the list of (find, keep) as its first element."""
    mark = _mark("RUS_JOTATED_SOFTENING")
    pos = "instr(substr(s.text, s.at), x.find)"
    go = f"{{'text': substr(s.text, 1, s.at + {pos} + x.keep - 2) || '{mark}' || substr(s.text, s.at + {pos} + x.keep), 'at': s.at + {pos} + x.keep, 'find': '', 'keep': 0::BIGINT}}"
    stay = "{'text': s.text, 'at': 1000000::BIGINT, 'find': '', 'keep': 0::BIGINT}"
    return f"CASE WHEN regexp_matches(word, '[яюё]') AND NOT contains(word, 'ерзя') THEN list_reduce(list_prepend({{'text': {o}, 'at': 1::BIGINT, 'find': '', 'keep': 0::BIGINT}}, pairs), lambda s, x: CASE WHEN {pos} = 0 THEN {stay} ELSE {go} END).text ELSE {o} END"


def _music(o: str) -> str:
    return _swap(o, "starts_with(word, 'музык')", "ıy", _mark("MUSIC_Y"))


def _steps(name: str, start: str, source: str, *steps) -> str:
    """A chain of tables that applies one step each."""
    out, value, table = [], start, source
    for k, step in enumerate(steps):
        out.append(f"{name}_{k} AS (SELECT * REPLACE ({step(value)} AS {value}) FROM {table})")
        table = f"{name}_{k}"
    return ",\n".join(out)


_ARABIC = " ".join(f"WHEN word = '{c}' OR starts_with(word, '{c}ергә') THEN regexp_replace(other, '^{a}', '{_mark('ARABIC_INITIAL_GA', (('plain', a), ('front', b)))}')" for c, a, b in (("гадиләштер", "ğadiläşter", "ğädiläşter"), ("гади", "ğadi", "ğädi")))
_MOSTAQIL = f"CASE WHEN starts_with(word, 'мөстәкыйль') THEN regexp_replace(regexp_replace(other, '^möstä[kq]ıyl(.)', 'möstä{_mark('MOSTAQIL', (('pdf', 'qil'), ('antat', 'qıylʼ')))}\\1'), '^möstä[kq]ıyl$', 'möstä{_mark('MOSTAQIL')}') ELSE other END"
_SIGN_MARKS = f"""CASE WHEN c IN ('ь', 'ъ') AND following = 'е' THEN '{_mark('RUS_SIGN_E')}' WHEN c IN ('ь', 'ъ') AND following = 'о' THEN '{_mark('RUS_SOFT_SIGN_O')}' WHEN c IN ('ь', 'ъ') AND following IN ('я', 'ю') THEN '{_mark('RUS_SIGN_GLIDE')}'
  WHEN c = 'е' AND before_c IN ('ь', 'ъ') THEN 'e' ELSE l_piece END"""
_VOWEL = f"regexp_matches(following, '^[{FRONT}{BACK}]')"

CHOICES_SQL = f"""{CONVERTED_SQL},
neighbours AS (SELECT *, substr(a, 1, 1) AS following, right(b, 1) AS before_c, lag(l_piece) OVER (PARTITION BY word ORDER BY i) AS before_l FROM pieces),
marked_letters AS (SELECT word,
  string_agg(n_piece || CASE WHEN (c = 'у' AND {_VOWEL} AND following <> 'е') OR (c IN ('ү', 'ю') AND {_VOWEL}) THEN '{_mark('NATIVE_UW')}' ELSE '' END, '' ORDER BY i) AS uw,
  string_agg({_SIGN_MARKS}, '' ORDER BY i) AS signs,
  string_agg(CASE WHEN c IN ('ь', 'ъ') AND l_piece = 'ʼ' THEN '{_mark('RUS_SOFT_SIGN')}' ELSE l_piece END, '' ORDER BY i) AS soft,
  bool_or(l_piece = '' AND c NOT IN ('ь', 'ъ')) AS holes,
  count(*) FILTER (c = 'ц' AND regexp_matches(a, '^({"|".join(AFTER_TS)})')) AS n_ts,
  coalesce(list({{'text': '', 'at': 1::BIGINT, 'find': before_l || l_piece, 'keep': length(before_l)::BIGINT}} ORDER BY i) FILTER (c IN ('я', 'ю', 'ё') AND before_c <> '' AND NOT regexp_matches(before_c, '[{FRONT}{BACK}еёюяьъ]') AND NOT (c = 'ё' AND before_c = 'щ') AND before_l <> '' AND starts_with(l_piece, 'y')), []) AS pairs
  FROM neighbours GROUP BY word),
start AS (SELECT *, native AS other, loan AS loan_other FROM converted JOIN marked_letters USING (word)),
{_steps('u', 'uw', 'start', _iya, _ie)},
{_steps('o', 'other', 'u_1', _months, _stem, _iya, _ie, lambda o: f"CASE {_ARABIC} ELSE {o} END", lambda o: _swap(o, "starts_with(word, 'җәмгыят')", 'iyä', 'i' + _mark('IYA')), lambda o: _MOSTAQIL)},
{_steps('g', 'signs', 'o_6', _music)},
{_steps('s', 'soft', 'g_0', _months, lambda o: _swap(o, "contains(word, 'бю')", 'byu', 'b' + _mark('RUS_BU_FRONT')), _jotated, _final_ka, _music)},
{_steps('l', 'loan_other', 's_4', _months, lambda o: _swap(o, "contains(word, 'щё')", 'şçy', 'şç' + _mark('RUS_SHCH_YO')), _jotated, _final_ka, lambda o: _swap(o, _equally_often('кц', 'ks', o), 'ks', 'k' + _mark('KTS_AFTER_K')), _final_ts, lambda o: _swap(o, _equally_often('оу', 'ou', o), 'ou', 'o' + _mark('OU_LOANWORD')), lambda o: f"CASE WHEN starts_with(word, 'проект') THEN regexp_replace({o}, '^proyekt', 'pro{_mark('PROJECT_E')}kt') ELSE {o} END", _music, _stem, _iya, _ie)},
chosen AS (SELECT word,
  CASE WHEN native = '' THEN '' WHEN starts_with(word, 'җилкуар') AND starts_with(native, 'cilquar') THEN regexp_replace(native, '^cilqu', 'cilqu{_mark('NATIVE_UW')}')
    WHEN n_bare = native AND regexp_matches(word, 'у[{FRONT.replace('е', '')}{BACK}]|[үю][{FRONT}{BACK}]') THEN uw ELSE other END AS native_marked,
  CASE WHEN loan = '' THEN '' WHEN regexp_matches(word, '[ьъ][яюео]') AND l_bare = loan AND NOT holes THEN signs
    WHEN regexp_matches(word, '[ьъ]') AND contains(loan, 'ʼ') AND NOT (contains(word, 'ия') AND contains(loan, 'iä')) AND NOT regexp_matches(word, '[ьъ][яюе]') AND l_bare = loan THEN soft ELSE loan_other END AS loan_marked FROM l_11)"""


def _written(column: str) -> str:
    for text, mark in _CHOICES.items():
        column = f"replace({column}, '{mark}', '{text}')"
    return column


CHOICES_SQL += f""",
dimension AS (SELECT word, {_written('native_marked')} AS native_dsl, {_written('loan_marked')} AS loanword_dsl FROM chosen),
states AS (SELECT *, CASE WHEN native_dsl = '' OR loanword_dsl = '' THEN 'unconvertible' WHEN native_dsl = loanword_dsl THEN 'origin_independent' ELSE 'origin_dependent' END AS state FROM dimension)"""


@query(f"WITH {WORDS_SQL}, {CHOICES_SQL} SELECT word, native_dsl, loanword_dsl, state FROM states")
def transliterated_words(spark, sf_dir):
    """Both conversions of every word in choice notation."""
    return word_dimension(stemmed_words(spark, sf_dir))


# what rests on both conversions: dispositions, review tasks, training pairs


def _resolved(column: str) -> str:
    for text, option in _PREFERRED.items():
        column = f"replace({column}, '{text}', '{option}')"
    return column


_JUDGED_SQL = f"""{bridge.LINES_SQL},
occurrences AS (SELECT unnest(list_transform(regexp_extract_all(sentence, '{W}'), lambda w: replace(lower(w), 'ё', 'е'))) AS word FROM lines),
stats AS (SELECT word, count(*) AS frequency, CASE WHEN substr(md5(word), 1, 1) < 'a' THEN 'N' WHEN substr(md5(word), 1, 1) < 'd' THEN 'RL' ELSE 'U' END AS label, substr(md5(word), 2, 1) = 'f' AND substr(md5(word), 1, 1) BETWEEN 'a' AND 'c' AS homonym FROM occurrences GROUP BY word),
w AS (SELECT word FROM stats),
{CHOICES_SQL},
judged AS (SELECT s.*, native_dsl, loanword_dsl, state, CASE WHEN homonym THEN 'homonym' WHEN substr(md5(word), 3, 1) = '0' THEN 'reviewed' WHEN substr(md5(word), 3, 1) = '1' THEN 'already_exported' WHEN label = 'N' AND harmony = 'mixed_front_back' THEN 'mixed_harmony' WHEN state = 'origin_independent' THEN 'origin_independent' ELSE 'keep' END AS disposition FROM stats s JOIN states USING (word) JOIN harmonies USING (word))"""


def _judged(spark: SparkSession, sf_dir: str, all_states: bool) -> DataFrame:
    label = bridge.label(F.col("text"))
    tokens = bridge.lines(spark, sf_dir).select(F.concat_ws(":", "id", "n").alias("sample_id"), F.posexplode(T.words_in(F.col("sentence"))).alias("position", "text"))
    stats = Kept()(dictionary.word_stats(tokens.withColumn("label", label).withColumn("homonym", (label == "RL") & (F.substring(F.md5("text"), 2, 1) == "f"))))  # a row a word; read for the lists below and the conversions
    of = lambda d: stats.where(F.substring(F.md5("word"), 3, 1) == d).select(F.col("word").alias("normalized_word"))
    return dictionary.dispositions(stats, of("0"), of("1"), all_states=all_states)


@query(f"WITH {_JUDGED_SQL} SELECT disposition, label, state, count(*) AS words, sum(frequency)::BIGINT AS tokens FROM judged GROUP BY ALL")
def word_dispositions(spark, sf_dir):
    return _judged(spark, sf_dir, True).groupBy("disposition", "label", "state").agg(F.count("*").alias("words"), F.sum("frequency").alias("tokens"))


_HINTS = "'<ul><li>origin: ' || label || '</li><li>conversions: ' || state || '</li><li>letters: ' || coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(word, '[уүгквяюецёыьъщ]'))), ', '), '') || '</li><li>frequency: ' || frequency || '</li></ul>'"


@query(f"""WITH {_JUDGED_SQL}, kept AS (SELECT *, row_number() OVER (ORDER BY frequency DESC, word) AS number FROM judged WHERE disposition = 'keep')
SELECT number, word, printf('word_%06d', number) AS id, word AS cyrl_word, CASE label WHEN 'N' THEN native_dsl WHEN 'RL' THEN loanword_dsl ELSE '' END AS auto_zamanalif, label AS origin, frequency, {_HINTS} AS hints_html FROM kept""")
def word_review_tasks(spark, sf_dir):
    """Words to review, most frequent first, numbered."""
    return dictionary.review_tasks(_judged(spark, sf_dir, False))


@query(f"""WITH turns AS (SELECT conv_id || ':' || turn AS id, translate(lower(coalesce(text, '')), '{bridge.SOURCE}', '{bridge.TARGET}') AS text FROM conversations),
cut AS (SELECT id, text, regexp_extract_all(text, '{W}') AS words, string_split_regex(text, '{W}') AS gaps FROM turns),
tokens AS (SELECT id, unnest(words) AS word, unnest(gaps[1:len(words)]) AS gap, unnest(generate_series(1, len(words))) AS k FROM cut),
w AS (SELECT DISTINCT word FROM tokens),
{CHOICES_SQL},
ready AS (SELECT id, k, gap, CASE WHEN harmony = 'mixed_front_back' THEN 'mixed_harmony_word' WHEN native_dsl <> loanword_dsl OR native_dsl = '' THEN 'unreviewed_word' END AS reason, {_resolved('native_dsl')} AS latin FROM tokens JOIN states USING (word) JOIN harmonies USING (word)),
built AS (SELECT id, arg_min(reason, k) FILTER (reason IS NOT NULL) AS reason, string_agg(gap || latin, '' ORDER BY k) AS latin FROM ready GROUP BY id)
SELECT c.id, c.text AS cyrillic, CASE WHEN b.reason IS NULL THEN coalesce(b.latin, '') || gaps[len(gaps)] END AS zamanalif, b.reason, NULL::VARCHAR AS error FROM cut c LEFT JOIN built b USING (id)""")
def training_pairs_of_turns(spark, sf_dir):
    """Conversation turns as annotated samples, words that convert one way only."""
    turns = spread(spark.read.parquet(f"{sf_dir}/conversations.parquet")).select(F.concat_ws(":", "conv_id", "turn").alias("id"), bridge.bridged(F.col("text")).alias("text"))
    words = F.regexp_extract_all("text", F.lit(W), F.lit(0))
    state = turns.select(F.col("id").alias("sample_id"), F.lit("annotated").alias("status"), F.lit(1).alias("tatar"), F.to_json(F.transform(words, lambda w: F.struct(w.alias("text"), F.lit("N").alias("label")))).alias("tokens_json"))
    reviewed = spark.createDataFrame([], "normalized_word string, zamanalif_dsl string")
    return training_pairs(turns, state, reviewed)
