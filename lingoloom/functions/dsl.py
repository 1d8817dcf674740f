"""The choice notation: text with {{RULE|option=text|option=text}} where spellings compete."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .profile import LATIN_ALPHABET
from .text import canonical_apostrophes, let


@dataclass(frozen=True)
class Rule:
    options: tuple[tuple[str, str], ...]
    default: str
    compact: str
    custom: bool = False


# fixed values: options, the preferred one, the one of the printed standard, and whether texts may differ
RULES: dict[str, Rule] = {
    "IYA": Rule((("compact", "ä"), ("explicit", "yä")), "explicit", "compact", True),
    "YA": Rule((("ya", "ya"), ("ya_front", "yä"), ("a", "a"), ("ae", "ä")), "ya", "ae"),
    "ARABIC_INITIAL_GA": Rule((("plain", "a"), ("front", "ä")), "plain", "plain", True),
    "IE_GLIDE": Rule((("plain", "e"), ("glide", "ye")), "plain", "plain"),
    "PROJECT_E": Rule((("plain", "e"), ("glide", "ye")), "glide", "glide"),
    "KTS_AFTER_K": Rule((("s", "s"), ("ts", "ts")), "s", "s"),
    "FINAL_TS_SUFFIX": Rule((("stem_s", "s"), ("surface_ts", "ts")), "stem_s", "stem_s"),
    "OU_LOANWORD": Rule((("plain", "u"), ("source_w", "w")), "plain", "plain"),
    "MUSIC_Y": Rule((("short", "ı"), ("long", "ıy")), "long", "long"),
    "MOSTAQIL": Rule((("pdf", "qil"), ("antat", "qıyl")), "antat", "pdf", True),
    "FIGYL_STEM": Rule((("antat", "fiğıl"), ("pdf", "fiğel")), "antat", "pdf"),
    "SHIGYR_STEM": Rule((("antat", "şiğır"), ("pdf", "şiğer")), "antat", "pdf"),
    "IJTIMAGIY_STEM": Rule((("antat", "ictimağıy"), ("pdf", "ictimaği")), "antat", "pdf"),
    "KAGAZ_STEM": Rule((("antat", "käğaz"), ("pdf", "qäğäz")), "antat", "pdf"),
    "MASHGUL_STEM": Rule((("antat", "mäşğul"), ("pdf", "mäşğül")), "antat", "pdf"),
    "MONTH_NAME": Rule((("ordinary", "ordinary"), ("pdf", "pdf")), "ordinary", "pdf", True),
    "HAMZA": Rule((("omit", ""), ("preserve", "ʼ")), "omit", "preserve"),
    "FINAL_DOUBLE_L": Rule((("single", "l"), ("double", "ll")), "single", "double"),
    "RUS_SIGN_GLIDE": Rule((("omit", ""), ("preserve", "ʼ")), "omit", "omit"),
    "RUS_SIGN_E": Rule((("glide", "y"), ("apostrophe", "ʼ"), ("apostrophe_glide", "ʼy")), "glide", "glide"),
    "RUS_SOFT_SIGN_O": Rule((("omit", ""), ("preserve", "ʼ"), ("apostrophe_y", "ʼy")), "preserve", "preserve"),
    "RUS_SOFT_SIGN": Rule((("omit", ""), ("preserve", "ʼ")), "preserve", "omit"),
    "RUS_JOTATED_SOFTENING": Rule((("glide", "y"), ("apostrophe", "ʼ")), "glide", "glide"),
    "RUS_SHCH_YO": Rule((("glide", "y"), ("apostrophe", "ʼ"), ("plain", "")), "glide", "plain"),
    "RUS_BU_FRONT": Rule((("yu", "yu"), ("apostrophe_front", "ʼü")), "yu", "yu"),
    "RL_FINAL_KA": Rule((("suffix", "q"), ("stem", "k")), "suffix", "suffix"),
    "NATIVE_UW": Rule((("plain", ""), ("glide", "w")), "glide", "plain"),
}
PREFERRED = {k: r.default for k, r in RULES.items()}
COMPACT = {k: r.compact for k, r in RULES.items()}

CHOICE = r"\{\{([^{}]*)\}\}"
_LETTERS = LATIN_ALPHABET.replace("-", r"\-")
_GRAMMAR = rf"\A(?:[{_LETTERS}]|\{{\{{[A-Z][A-Z0-9_]*(?:\|[a-z][a-z0-9_]*=[{_LETTERS}]*){{2,}}\}}\}})+\z"


def choice(rule: str, options: tuple[tuple[str, str], ...] | None = None) -> str:
    return "{{" + "|".join([rule, *(f"{k}={v}" for k, v in options or RULES[rule].options)]) + "}}"


def rules_table(spark: SparkSession) -> DataFrame:
    """(rule_id, options, default_option, compact_option, custom_text): the registry as a dimension."""
    return spark.createDataFrame([(k, list(r.options), r.default, r.compact, r.custom) for k, r in RULES.items()], "rule_id string, options array<struct<id:string,text:string>>, default_option string, compact_option string, custom_text boolean")


def policy(base: Mapping[str, str] = PREFERRED, *overrides: str) -> dict[str, str]:
    """``base`` with RULE=OPTION overrides; unknown rules or options, and rules given twice, are errors."""
    out, seen = dict(base), set()
    for text in overrides:
        rule, sign, option = text.partition("=")
        if not sign or rule not in RULES or option not in dict(RULES[rule].options):
            raise ValueError(f"unknown rule or option: {text!r}")
        if rule in seen:
            raise ValueError(f"rule given twice: {rule}")
        seen.add(rule)
        out[rule] = option
    return out


def choices(dsl: Column) -> Column:
    """array<struct<rule_id,options array<struct<id,text>>>> of the choices in order."""

    def parsed(body: Column) -> Column:
        parts = F.split(body, r"\|")
        options = F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.struct(F.substring_index(p, "=", 1).alias("id"), F.regexp_replace(p, r"(?s)\A[^=]*=?", "").alias("text")))
        return F.struct(F.get(parts, F.lit(0)).alias("rule_id"), options.alias("options"))

    return F.transform(F.regexp_extract_all(canonical_apostrophes(dsl), F.lit(CHOICE), F.lit(1)), parsed)


def segments(dsl: Column) -> Column:
    """array<struct<text,rule_id,options>>: literals (rule_id null) and choices in order, without empty literals."""
    both = F.struct(F.split(canonical_apostrophes(dsl), CHOICE, -1).alias("literals"), choices(dsl).alias("choices"))
    no_options = F.lit(None).cast("array<struct<id:string,text:string>>")

    def woven(b: Column) -> Column:
        pair = lambda text, c: F.array(F.struct(text.alias("text"), F.lit(None).cast("string").alias("rule_id"), no_options.alias("options")), F.struct(F.lit(None).cast("string").alias("text"), c["rule_id"].alias("rule_id"), c["options"].alias("options")))
        return F.filter(F.flatten(F.zip_with(b["literals"], b["choices"], pair)), lambda s: (F.coalesce(s["text"], F.lit("")) != "") | s["rule_id"].isNotNull())

    return let(both, woven)


def serialised(parts: Column) -> Column:
    """The notation of ``segments``."""
    option = lambda o: F.concat(o["id"], F.lit("="), o["text"])
    one = lambda s: F.when(s["rule_id"].isNull(), s["text"]).otherwise(F.concat(F.lit("{{"), F.concat_ws("|", s["rule_id"], F.array_join(F.transform(s["options"], option), "|")), F.lit("}}")))
    return F.array_join(F.transform(parts, one), "")


def dsl_error(dsl: Column) -> Column:
    """Why a value isn't valid notation; null if it is. ' and ’ are read as ʼ, here as in all functions that read the notation."""
    dsl = canonical_apostrophes(dsl)
    ids = {k: [i for i, _ in r.options] for k, r in RULES.items()}
    known = F.create_map(*[x for k, v in ids.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    texts = F.create_map(*[x for k, r in RULES.items() if not r.custom for x in (F.lit(k), F.array(*[F.lit(t) for _, t in r.options]))])

    def judged(found: Column) -> Column:
        twice = F.exists(found, lambda c: F.size(F.array_distinct(c["options"]["id"])) < F.size(c["options"]))
        strange = F.exists(found, lambda c: F.element_at(known, c["rule_id"]).isNull())
        wrong = F.exists(found, lambda c: F.element_at(known, c["rule_id"]) != c["options"]["id"])
        spelled = F.exists(found, lambda c: F.element_at(texts, c["rule_id"]).isNotNull() & (F.element_at(texts, c["rule_id"]) != c["options"]["text"]))
        return F.when(strange, "unknown rule").when(twice, "duplicate option").when(wrong, "unknown or missing option").when(spelled, "option text differs")

    return F.when(dsl.isNull() | (dsl == ""), "empty").when(~dsl.rlike(_GRAMMAR), "not choice notation over the alphabet").otherwise(let(choices(dsl), judged))


def resolve(dsl: Column, chosen: Mapping[str, str] = PREFERRED) -> Column:
    """Each choice replaced by the text that the policy chooses."""
    dsl = canonical_apostrophes(dsl)
    for rule, option in chosen.items():
        dsl = F.regexp_replace(dsl, rf"\{{\{{{rule}\|(?:[^}}]*\|)?{option}=([^|}}]*)[^}}]*\}}\}}", "$1")
    return dsl


def resolutions(dsl: Column) -> Column:
    """array<string>: every spelling that some combination of options gives."""
    start = F.array(F.lit(""))
    texts = F.transform(segments(dsl), lambda s: F.when(s["rule_id"].isNull(), F.array(s["text"])).otherwise(s["options"]["text"]))
    return F.array_distinct(F.aggregate(texts, start, lambda acc, options: F.flatten(F.transform(acc, lambda a: F.transform(options, lambda o: F.concat(a, o))))))


def rule_ids(dsl: Column) -> Column:
    return F.transform(choices(dsl), lambda c: c["rule_id"])
