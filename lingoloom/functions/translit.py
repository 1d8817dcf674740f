"""Transliteration of words from Cyrillic to Latin, with choices where spellings compete.

Words are converted once per distinct form, by expressions alone. Every letter
gets its Latin text from what stands before and after it; lexical conventions
then replace parts of the joined word; competing spellings become marks that
are written out in the choice notation at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dsl import RULES, choice
from .profile import TATAR
from .text import harmony_class, is_clean_latin, let

FRONT, BACK = TATAR.front, TATAR.back

# fixed values: letters that don't depend on their neighbours
PLAIN = {"а": "a", "ә": "ä", "о": "o", "ө": "ö", "ы": "ı", "э": "e", "и": "i", "б": "b", "җ": "c", "ч": "ç", "д": "d", "ф": "f", "һ": "h", "ж": "j", "л": "l", "м": "m", "н": "n", "ң": "ñ", "п": "p", "р": "r", "с": "s", "ш": "ş", "т": "t", "х": "x", "й": "y", "з": "z", "ё": "yo", "щ": "şç"}

# fixed values: letters of either origin that do
IN_CONTEXT = {"N": "вгкуүюяец", "RL": "вгкуүюяецыьъ"}

# fixed values: native words whose conventional spelling differs, by beginning: Cyrillic, converted, conventional
NATIVE_PREFIXES = (
    ("аек", "ayık", "ayıq"),
    ("беркай", "berkay", "berqay"),
    ("беркая", "berkaya", "berqaya"),
    ("беркат", "berkat", "berqat"),
    ("берникадәр", "bernikadär", "berniqadär"),
    ("боек", "boyık", "boyıq"),
    ("вазифа", "wazifa", "wazıyfa"),
    ("вәкаләт", "wäkalät", "wäqalät"),
    ("гадел", "ğadel", "ğädel"),
    ("гадәт", "ğadät", "ğädät"),
    ("гаеп", "ğayıp", "ğäyep"),
    ("гая", "ğaya", "ğäyä"),
    ("гаск", "ğasq", "ğäsk"),
    ("гаҗ", "ğac", "ğäc"),
    ("гамә", "ğamä", "ğämä"),
    ("гарә", "ğarä", "ğärä"),
    ("гарип", "ğarip", "ğärip"),
    ("гарь", "ğar", "ğär"),
    ("гаск", "ğask", "ğäsk"),
    ("галәм", "ğaläm", "ğäläm"),
    ("гамь", "ğam", "ğäm"),
    ("ганимәт", "ğanimät", "ğänimät"),
    ("газиз", "ğaziz", "ğäziz"),
    ("гаилә", "ğailä", "ğäilä"),
    ("гай", "ğay", "ğäy"),
    ("гәлим", "gälim", "ğälim"),
    ("гәрәп", "gäräp", "ğäräp"),
    ("гилем", "gilem", "ğilem"),
    ("гилм", "gilm", "ğilm"),
    ("дикъкать", "diqkat", "diqqat"),
    ("инкыйлаб", "inkıylab", "inqıylab"),
    ("инкар", "inkar", "inqar"),
    ("иҗтимагый", "ictimağıy", "ictimaği"),
    ("игътибар", "iğtibar", "iğtibar"),
    ("каек", "qayık", "qayıq"),
    ("каракүл", "qaraqül", "qarakül"),
    ("киная", "kinaya", "kinayä"),
    ("кыек", "qıyık", "qıyıq"),
    ("кыяфәт", "qıyafät", "qıyäfät"),
    ("лаек", "layık", "layıq"),
    ("мыек", "mıyık", "mıyıq"),
    ("мөкатдәс", "mökatdäs", "möqatdäs"),
    ("маэмай", "maemay", "maʼmay"),
    ("мәкал", "mäkal", "mäqal"),
    ("мәкәлә", "mäkälä", "mäqälä"),
    ("мәхкүл", "mäxkül", "mäxqül"),
    ("мәгъсум", "mäğsum", "mäğsüm"),
    ("мәгариф", "mäğarif", "mäğärif"),
    ("мәшәкать", "mäşäkat", "mäşäqat"),
    ("мөгаллим", "möğallim", "möğällim"),
    ("мөгамәлә", "möğamälä", "möğämälä"),
    ("нәкыш", "näkış", "näqış"),
    ("оек", "oyık", "oyıq"),
    ("оеш", "oyışk", "oyışq"),
    ("пәйгамбәр", "päyğambär", "päyğämbär"),
    ("сыек", "sıyık", "sıyıq"),
    ("сөякк", "söyäqq", "söyäkk"),
    ("сөяк", "söyäq", "söyäk"),
    ("сәркатип", "särkatip", "särqatip"),
    ("таэмин", "taemin", "täʼmin"),
    ("тәкать", "täkat", "täqat"),
    ("тәрәккый", "täräkqıy", "täräqqıy"),
    ("тәэмин", "täemin", "täʼmin"),
    ("тәэсир", "täesir", "täʼsir"),
    ("тәнкыйть", "tänkıyt", "tänqıyt"),
    ("тәшрик", "täşrik", "täşriq"),
    ("вакиф", "wakif", "waqif"),
    ("фәкать", "fäkat", "fäqat"),
    ("фәкыйрь", "fäkıyr", "fäqıyr"),
    ("хыянәт", "xıyanät", "xıyänät"),
    ("әхлак", "äxlak", "äxlaq"),
    ("югыйсә", "yuğıysä", "yuğisä"),
    ("шәфкать", "şäfkat", "şäfqat"),
    ("нигмәт", "nigmät", "niğmät"),
    ("нәгим", "nägim", "näğim"),
    ("кәбәхәт", "käbäxät", "qäbäxät"),
    ("кәдер", "käder", "qäder"),
    ("кәдими", "kädimi", "qädimi"),
    ("кәдәр", "kädär", "qädär"),
    ("көдрәт", "ködrät", "qödrät"),
    ("һичкая", "hiçkaya", "hiçqaya"),
    ("һичкай", "hiçkay", "hiçqay"),
    ("һәркай", "härkay", "härqay"),
    ("юкә", "yüqä", "yükä"),
)
# fixed values: the same anywhere in a word
NATIVE_FRAGMENTS = (
    ("сөякк", "söyäqq", "söyäkk"),
    ("сөяк", "söyäq", "söyäk"),
    ("төяк", "töyäq", "töyäk"),
    ("гүяки", "güyäqi", "güyäki"),
    ("өянке", "öyänqe", "öyänke"),
    ("мияу", "miäw", "miyaw"),
    ("җилкуар", "cilkuar", "cilquar"),
    ("гыйбад", "ğıybad", "ğibäd"),
    ("гыйбар", "ğıybar", "ğibär"),
    ("гыйльм", "ğıylm", "ğilm"),
    ("зәгыйф", "zäğıyf", "zäğif"),
    ("шагыйр", "şağıyr", "şağir"),
    ("шигри", "şigri", "şiğri"),
    ("кагыйдә", "qağıydä", "qağidä"),
    ("табигый", "tabiğıy", "tabiği"),
    ("васыять", "wasıyat", "wasıyät"),
    ("елан", "elan", "yılan"),
    ("итагать", "itağat", "itağät"),
    ("канәгать", "qanäğat", "qanäğät"),
    ("риваять", "riwayat", "riwayät"),
    ("сәгать", "säğat", "säğät"),
    ("сәгәт", "sägät", "säğät"),
    ("сәнгат", "sänğat", "sänğät"),
    ("табигать", "tabiğat", "tabiğät"),
    ("җәмгыят", "cämğıyat", "cämğiyät"),
    ("җинаять", "cinayat", "cinayät"),
    ("җәмәгать", "cämäğat", "cämäğät"),
    ("мөрәҗәгать", "möräcäğat", "möräcäğät"),
)
# fixed values: month stems: Cyrillic, ordinary, printed standard
MONTHS = (
    ("гыйнвар", "ğıynwar", "ğinwar"),
    ("июнь", "iyun", "iyün"),
    ("июль", "iyul", "iyül"),
    ("сентябр", "sentyabr", "sentäbr"),
    ("октябр", "oktyabr", "oktäbr"),
    ("ноябрь", "noyabr", "noyäbr"),
    ("декабрь", "dekabr", "dekäbr"),
)
# fixed values: endings before which a loanword's final ц competes
AFTER_TS = ("лары", "ләре", "ларга", "ләргә", "ларда", "ләрдә", "лардан", "ләрдән", "ларын", "ләрен", "ларының", "ләренең", "ларны", "ләрне", "лар", "ләр", "ының", "енең", "ында", "ендә", "ыннан", "еннән", "ына", "енә", "ны", "не", "ның", "нең", "дан", "дән", "тан", "тән", "да", "дә", "та", "тә", "га", "гә", "ка", "кә")


def _nearest(before: Column, after: Column) -> Column:
    """front or back, by the last vowel before or else the first after, neither beyond a hyphen; empty if there is none."""
    front, vowels = f"{FRONT}э", f"{FRONT}э{BACK}юя"
    last = F.regexp_extract(before, rf"([{vowels}])[^{vowels}-]*\z", 1)
    first = F.regexp_extract(after, rf"\A[^{vowels}-]*([{vowels}])", 1)
    own = let(last, lambda v: F.when(v != "", v).otherwise(first))
    return let(own, lambda v: F.when(v == "", "").when(F.lit(front).contains(v), "front").otherwise("back"))


def _next_to(after: Column) -> Column:
    return F.when(after.rlike(rf"\A[{FRONT}э]"), "front").when(after.rlike(rf"\A[{BACK}я]"), "back").otherwise("")


def _others(before: Column, after: Column) -> Column:
    """front_only, back_only, mixed or none, over all other letters."""
    rest = F.concat(before, after)
    front, back = rest.rlike(f"[{FRONT}э]"), rest.rlike(f"[{BACK}]")
    return F.when(front & back, "mixed").when(front, "front_only").when(back, "back_only").otherwise("none")


def _by(context: Column, front: str, back: str, other: Column) -> Column:
    return let(context, lambda v: F.when(v == "front", front).when(v == "back", back).otherwise(other))


def _ts(before: Column, after: Column) -> Column:
    doubled = after.startswith("ц")
    return F.when(before.endswith("ц"), "").when(doubled, "ts").when(after == "", "s").when(before.rlike(rf"[{FRONT}{BACK}еёюя]\z"), "ts").otherwise("s")


def _first_e(word: Column, before: Column, after: Column) -> Column:
    others = _others(before, after)
    return F.when(word.rlike(r"\A(?:европ|евраз|епископ|ефәк)") | (others == "front_only"), "ye").when(others == "mixed", "").otherwise("yı")


def _native(word: Column, before: Column, c: Column, after: Column) -> Column:
    harmony = harmony_class(word)
    nearest, beside, others = _nearest(before, after), _next_to(after), _others(before, after)
    by_harmony = lambda front, back: F.when(harmony == "front_only", front).when(harmony == "back_only", back).otherwise("")
    surname = before.rlike(r"[иә]е\z")
    gliding = F.when(before.rlike(r"[аәя]\z"), "w")
    return (
        F.when(c == "в", F.when(surname, "v").otherwise("w"))
        .when(c == "г", F.when(after.startswith("ъ"), "ğ").otherwise(_by(beside, "g", "ğ", _by(nearest, "g", "ğ", by_harmony("g", "ğ")))))
        .when(c == "к", F.when(after.startswith("ъ") | after.startswith("ыч"), "q").when(after.startswith("еч"), "k").otherwise(_by(beside, "k", "q", _by(nearest, "k", "q", by_harmony("k", "q")))))
        .when(c == "у", F.coalesce(gliding, F.lit("u")))
        .when(c == "ү", F.coalesce(gliding, F.lit("ü")))
        .when(c == "ю", F.when((word == "ю") | before.endswith("и"), "yü").otherwise(_by(nearest, "yü", "yu", F.when(harmony == "no_vowels", "yu").otherwise(by_harmony("yü", "yu")))))
        .when(c == "я", _ya(word, before, after, nearest, others, native=True))
        .when(
            c == "е",
            F.when(before.endswith("и") | before.endswith("ү"), "e")
            .when(before.rlike("[ьъ]\\z"), F.when(after.startswith("л"), "yı").otherwise("ye"))
            .when(before == "", _first_e(word, before, after))
            .when(before.rlike("[аоуы]\\z"), "yı")
            .when(before.rlike("[әө]\\z"), "ye")
            .otherwise("e"),
        )
        .when(c == "ц", _ts(before, after))
    )


def _ya(word: Column, before: Column, after: Column, nearest: Column, others: Column, native: bool) -> Column:
    start = F.when(before.endswith("и"), "ä").when(before.rlike("[ьъ]\\z"), "ya")
    if not native:
        start = start.when(before != "", "ya")
    start = start.when((before == "") & ((word == "я") | word.startswith("яшь")), "yä").when(word == "ящик", "ya")
    return start.otherwise(_by(nearest, "yä", "ya", F.when(others == "front_only", "yä").when(others == "mixed", "").otherwise("ya")))


def _loan_gk(before: Column, c: Column, after: Column) -> Column:
    """г and к in Tatar endings of loanwords; null elsewhere."""
    long = F.length(before) >= 5
    ending = F.concat(c, after)
    # дагы and its kin: the letter is the ending's second consonant
    local = before.rlike(r"(?:да|тә|дә|та)\z") & (F.length(before) >= 7)
    return (
        F.when(long & ending.isin("га", "ган", "гын"), "ğ")
        .when(long & ending.isin("гә", "гән", "ген"), "g")
        .when(local & (ending == "гы") & before.rlike(r"[дт]а\z"), "ğ")
        .when(local & (ending == "ге") & before.rlike(r"[дт]ә\z"), "g")
        .when(long & ending.isin("ка", "кә") & before.endswith("л"), "k")
        .when(long & (ending == "ка"), "q")
        .when(long & (ending == "кә"), "k")
        .when((ending == "к") & before.endswith("лы") & (F.length(before) >= 6), "q")
        .when((ending == "к") & before.endswith("ле") & (F.length(before) >= 6), "k")
    )


def _loan(word: Column, before: Column, c: Column, after: Column) -> Column:
    return (
        F.when(c == "в", "v")
        .when(c == "г", F.coalesce(_loan_gk(before, c, after), F.lit("g")))
        .when(c == "к", F.coalesce(_loan_gk(before, c, after), F.lit("k")))
        .when(c == "у", "u")
        .when(c == "ү", "ü")
        .when(c == "ю", "yu")
        .when(c == "я", _ya(word, before, after, _nearest(before, after), _others(before, after), native=False))
        .when(
            c == "е",
            F.when((after == "ц") & before.endswith("е"), "ye")
            .when((after == "ц") | (after == "ец"), "e")
            .when(before.endswith("и") | before.endswith("ү"), "e")
            .when(before.rlike("[ьъ]\\z"), "ye")
            .when(before == "", _first_e(word, before, after))
            .when(before.endswith("ә") & after.startswith("в"), "ye")
            .when(before.endswith("у"), "e")
            .when(before.rlike(rf"[{BACK}]\z") & (after == ""), "yı")
            .when(before.rlike(rf"[{FRONT}{BACK}]\z"), "ye")
            .otherwise("e"),
        )
        .when(c == "ц", F.when((after == "") & before.endswith("е"), "ts").otherwise(_ts(before, after)))
        .when(c == "ы", F.when(word.rlike(r"\A(?:музы|посыл|выш|сыр)"), "ıy").otherwise("ı"))
        .when(c.isin("ь", "ъ"), F.when(after.startswith("е"), "").otherwise("ʼ"))
    )


def letter_pieces(word: Column, label: str) -> Column:
    """array<struct<c,latin>>: each letter with its Latin text, empty where there is none."""
    plain = F.create_map(*[F.lit(x) for kv in PLAIN.items() for x in kv])
    own = _native if label == "N" else _loan

    def piece(c: Column, i: Column) -> Column:
        # most letters stand for themselves; only the others look around
        around = F.struct(F.substring(word, F.lit(1), i).alias("before"), F.substring(word, i + 2, F.length(word)).alias("after"))
        latin = F.when(c.isin(*IN_CONTEXT[label]), let(around, lambda x: own(word, x["before"], c, x["after"]))).when(c == "-", "-").when(c.isin("'", "’", "ʼ"), "ʼ").otherwise(F.element_at(plain, c))
        return F.struct(c.alias("c"), F.coalesce(latin, F.lit("")).alias("latin"))

    return F.when(F.length(word) > 0, F.transform(F.split(word, ""), piece)).otherwise(F.array().cast("array<struct<c:string,latin:string>>"))


def _joined(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: p["latin"]), "")


def _lexical(word: Column, latin: Column, label: str) -> Column:
    """Conventional spellings; the first that fits both the word and its conversion."""
    if label == "RL":
        return (
            F.when(word.startswith("закончалык") & latin.startswith("zakonçalık"), F.concat(F.lit("zakonçalıq"), F.substring(latin, 11, 1000)))
            .when(word.startswith("интриг") & latin.startswith("intriğ"), F.concat(F.lit("intrig"), F.substring(latin, 7, 1000)))
            .when(word.endswith("лау") & latin.endswith("lau"), F.regexp_replace(latin, r"u\z", "w"))
            .when(word.endswith("ләү") & latin.endswith("läü"), F.regexp_replace(latin, r"ü\z", "w"))
            .otherwise(latin)
        )
    # two look-ups in literal arrays rather than a hundred branches
    row = lambda r: F.struct(*[F.lit(x).alias(n) for x, n in zip(r, ("c", "a", "b"), strict=True)])
    prefixes, fragments = F.array(*map(row, NATIVE_PREFIXES)), F.array(*map(row, NATIVE_FRAGMENTS))
    at_start = F.get(F.filter(prefixes, lambda r: F.startswith(word, r["c"]) & F.startswith(latin, r["a"])), F.lit(0))
    inside = F.get(F.filter(fragments, lambda r: F.contains(word, r["c"]) & F.contains(latin, r["a"])), F.lit(0))

    def replaced(found: Column) -> Column:
        p, f = found["p"], found["f"]
        place = F.instr(latin, f["a"])
        return F.when(p.isNotNull(), F.concat(p["b"], F.substring(latin, F.length(p["a"]) + 1, F.length(latin)))).when(f.isNotNull(), F.concat(F.substring(latin, F.lit(1), place - 1), f["b"], F.substring(latin, place + F.length(f["a"]), F.length(latin)))).otherwise(latin)

    named = word.rlike(rf"\A(?:{'|'.join(r[0] for r in NATIVE_PREFIXES)})|{'|'.join(r[0] for r in NATIVE_FRAGMENTS)}")  # few words are looked up
    out = F.when(named, let(F.struct(at_start.alias("p"), inside.alias("f")), replaced)).otherwise(latin)
    surname = word.rlike(r"\A(?:гәлим|гилем)")
    return F.when(surname & word.endswith("ова"), F.regexp_replace(out, r"owa\z", "ova")).when(surname & word.endswith("ов"), F.regexp_replace(out, r"ow\z", "ov")).otherwise(out)


#: The mark that stands for each rule until the end, by rule and, where texts differ, by variant.
_MARKS: dict[str, str] = {}


def _mark(rule: str, options: tuple[tuple[str, str], ...] | None = None) -> str:
    return _MARKS.setdefault(choice(rule, options), chr(0xE000 + len(_MARKS)))


for _name in RULES:
    if _name != "MONTH_NAME":
        _mark(_name)
_mark("IYA", (("compact", "a"), ("explicit", "ya")))
_mark("MOSTAQIL", (("pdf", "qil"), ("antat", "qıylʼ")))
for _plain, _front in (("ğadiläşter", "ğädiläşter"), ("ğadi", "ğädi")):
    _mark("ARABIC_INITIAL_GA", (("plain", _plain), ("front", _front)))
for _, _ordinary, _pdf in MONTHS:
    _mark("MONTH_NAME", (("ordinary", _ordinary), ("pdf", _pdf)))


def _written(marked: Column) -> Column:
    def replaced(out: Column) -> Column:
        for text, mark in _MARKS.items():
            out = F.replace(out, F.lit(mark), F.lit(text))
        return out

    return let(marked, lambda x: F.when(x.rlike("[\ue000-\uf8ff]"), replaced(x)).otherwise(x))


def _through(value: Column, *steps) -> Column:
    """The steps one after the other, each value computed once."""
    for step in steps:
        value = let(value, step)
    return value


def _swap(latin: Column, pattern: str, to: str, when: Column) -> Column:
    return F.when(when, F.regexp_replace(latin, pattern, to)).otherwise(latin)


def _counted(word: Column, latin: Column, cyrillic: str, pattern: str) -> Column:
    """As many in the word as in the conversion, and some."""
    n = F.regexp_count(word, F.lit(cyrillic))
    return (n > 0) & (n == F.regexp_count(latin, F.lit(pattern)))


def _months(word: Column, latin: Column) -> Column:
    out = latin
    for cyrillic, ordinary, pdf in MONTHS:
        out = F.when(word.startswith(cyrillic) & latin.startswith(ordinary), F.regexp_replace(latin, rf"\A{ordinary}", _mark("MONTH_NAME", (("ordinary", ordinary), ("pdf", pdf))))).otherwise(out)
    return out


def _jotated(word: Column, latin: Column, pieces: Column) -> Column:
    """A mark for the y of each я ю ё after a consonant, found in order in the conversion."""
    def pair(p: Column, i: Column) -> Column:
        before = F.get(pieces, i - 1)
        fits = p["c"].isin("я", "ю", "ё") & before["c"].isNotNull() & before["c"].rlike(rf"\A[{TATAR.letters}]\z") & ~before["c"].rlike(rf"[{FRONT}{BACK}еёюяьъ]") & ~((p["c"] == "ё") & (before["c"] == "щ")) & (before["latin"] != "") & p["latin"].startswith("y")
        return F.when(fits, F.struct(F.concat(before["latin"], p["latin"]).alias("find"), F.length(before["latin"]).alias("keep")))

    def step(acc: Column, r: Column) -> Column:
        at = F.call_function("locate", r["find"], acc["text"], acc["from"])
        spot = at + r["keep"]
        return F.when(acc["done"] | (at == 0), F.struct(acc["text"].alias("text"), acc["from"].alias("from"), F.lit(True).alias("done"))).otherwise(
            F.struct(F.concat(F.substring(acc["text"], F.lit(1), spot - 1), F.lit(_mark("RUS_JOTATED_SOFTENING")), F.substring(acc["text"], spot + 1, F.length(acc["text"]))).alias("text"), (spot + 1).alias("from"), F.lit(False).alias("done"))
        )

    pairs = F.filter(F.transform(pieces, pair), lambda x: x.isNotNull())
    marked = F.aggregate(pairs, F.struct(latin.alias("text"), F.lit(1).alias("from"), F.lit(False).alias("done")), step, lambda acc: acc["text"])
    return F.when(word.rlike("[яюё]") & ~word.contains("ерзя"), marked).otherwise(latin)


def _final_ka(word: Column, latin: Column) -> Column:
    return F.when(word == "кубка", F.regexp_replace(latin, r"ka\z", _mark("RL_FINAL_KA") + "a")).when(word.endswith("ка"), F.regexp_replace(latin, r"qa\z", _mark("RL_FINAL_KA") + "a")).otherwise(latin)


def _iya(word: Column, latin: Column) -> Column:
    special = word.rlike(r"\A(?:әдәбия|әүлия|риялы)")
    mark = F.when(special, _mark("IYA", (("compact", "a"), ("explicit", "ya")))).otherwise(_mark("IYA"))
    return F.when(_counted(word, latin, "ия", "iä"), F.replace(latin, F.lit("iä"), F.concat(F.lit("i"), mark))).otherwise(latin)


def _ie(word: Column, latin: Column) -> Column:
    return _swap(latin, "ie", "i" + _mark("IE_GLIDE"), _counted(word, latin, "ие", "ie") & ~word.rlike(r"(?:ие|әе)ва?\z"))


def _music(word: Column, latin: Column) -> Column:
    return _swap(latin, "ıy", _mark("MUSIC_Y"), word.startswith("музык"))


def _loan_choices(word: Column, latin: Column, pieces: Column) -> Column:
    """The marked conversion of a loanword."""

    def glide(p: Column, i: Column) -> Column:
        following, before = F.get(pieces, i + 1)["c"], F.get(pieces, i - 1)["c"]
        sign = p["c"].isin("ь", "ъ")
        return (
            F.when(sign & (following == "е"), _mark("RUS_SIGN_E"))
            .when(sign & (following == "о"), _mark("RUS_SOFT_SIGN_O"))
            .when(sign & following.isin("я", "ю"), _mark("RUS_SIGN_GLIDE"))
            .when((p["c"] == "е") & before.isin("ь", "ъ"), "e")
            .otherwise(p["latin"])
        )

    signs = F.array_join(F.transform(pieces, glide), "")
    aligned = _joined(pieces) == latin
    # letters without Latin text, other than signs, leave the word unmarked
    holes = F.exists(pieces, lambda p: (p["latin"] == "") & ~p["c"].isin("ь", "ъ"))
    glides = word.rlike("[ьъ][яюео]") & aligned & ~holes
    soft = F.array_join(F.transform(pieces, lambda p: F.when(p["c"].isin("ь", "ъ") & (p["latin"] == "ʼ"), _mark("RUS_SOFT_SIGN")).otherwise(p["latin"])), "")
    softs = word.rlike("[ьъ]") & latin.contains("ʼ") & ~(word.contains("ия") & latin.contains("iä")) & ~word.rlike("[ьъ][яюе]") & aligned
    months, jotated, final_ka, music = (lambda o: _months(word, o)), (lambda o: _jotated(word, o, pieces)), (lambda o: _final_ka(word, o)), (lambda o: _music(word, o))
    bu_front = lambda o: _swap(o, "byu", "b" + _mark("RUS_BU_FRONT"), word.contains("бю"))
    shch_yo = lambda o: _swap(o, "şçy", "şç" + _mark("RUS_SHCH_YO"), word.contains("щё"))
    kts = lambda o: _swap(o, "ks", "k" + _mark("KTS_AFTER_K"), _counted(word, o, "кц", "ks"))
    n_ts = F.regexp_count(word, F.lit(f"ц(?={'|'.join(AFTER_TS)})"))

    def final_ts(o: Column) -> Column:
        found = F.regexp_count(o, F.lit("ts"))
        first = F.regexp_replace(o, r"\A(.*?)ts", "$1" + _mark("FINAL_TS_SUFFIX"))
        return F.when((n_ts == 0) | (n_ts > found), o).when(n_ts == found, F.replace(o, F.lit("ts"), F.lit(_mark("FINAL_TS_SUFFIX")))).otherwise(first)

    ou = lambda o: _swap(o, "ou", "o" + _mark("OU_LOANWORD"), _counted(word, o, "оу", "ou"))
    project = lambda o: _swap(o, r"\Aproyekt", "pro" + _mark("PROJECT_E") + "kt", word.startswith("проект"))
    with_soft = lambda o: _through(o, months, bu_front, jotated, final_ka, music)
    other = lambda o: _through(o, months, shch_yo, jotated, final_ka, kts, final_ts, ou, project, music, *_common(word))
    return F.when(glides, let(signs, music)).when(softs, with_soft(soft)).otherwise(other(latin))


def _common(word: Column) -> list:
    """Steps for words of either origin."""
    stems = [("металл", r"\Ametall", "meta" + _mark("FINAL_DOUBLE_L")), ("фигыль", r"\Afiğıl", _mark("FIGYL_STEM")), ("иҗтимагый", r"\Aictimaği", _mark("IJTIMAGIY_STEM")), ("кәгаз", r"\Akäğaz", _mark("KAGAZ_STEM")), ("мәшгуль", r"\Amäşğul", _mark("MASHGUL_STEM")), ("коръән", r"\Aqorän", "qor" + _mark("HAMZA") + "än")]

    def stem(o: Column) -> Column:
        out = o
        for cyrillic, pattern, to in stems:  # no word begins with two of them
            out = F.when(word.startswith(cyrillic), F.regexp_replace(o, pattern, to)).otherwise(out)
        return F.when(word.contains("шигыр"), F.regexp_replace(o, "şiğır", _mark("SHIGYR_STEM"))).when(word.contains("ерзя"), F.regexp_replace(o, r"\A(.*?)erzya", "$1erz" + _mark("YA"))).otherwise(out)

    return [stem, lambda o: _iya(word, o), lambda o: _ie(word, o)]


def _native_choices(word: Column, latin: Column, pieces: Column) -> Column:
    def glide(p: Column, i: Column) -> Column:
        following = F.coalesce(F.get(pieces, i + 1)["c"], F.lit(""))
        vowel = (following != "") & F.lit(FRONT + BACK).contains(following)
        needs = (p["c"].isin("у") & vowel & (following != "е")) | (p["c"].isin("ү", "ю") & vowel)
        return F.concat(p["latin"], F.when(needs, _mark("NATIVE_UW")).otherwise(""))

    uw = F.array_join(F.transform(pieces, glide), "")
    marked = word.rlike("[уүю]") & (_joined(pieces) == latin) & word.rlike(f"у[{FRONT.replace('е', '')}{BACK}]|[үю][{FRONT}{BACK}]")
    cilquar = word.startswith("җилкуар") & latin.startswith("cilquar")

    def arabic_ga(o: Column) -> Column:
        out = o
        for cyrillic, plain, front in (("гади", "ğadi", "ğädi"), ("гадиләштер", "ğadiläşter", "ğädiläşter")):
            out = F.when((word == cyrillic) | word.startswith(cyrillic + "ергә"), F.regexp_replace(o, rf"\A{plain}", _mark("ARABIC_INITIAL_GA", (("plain", plain), ("front", front))))).otherwise(out)
        return out

    jamgiyat = lambda o: _swap(o, "iyä", "i" + _mark("IYA"), word.startswith("җәмгыят"))
    mostaqil = lambda o: F.when(word.startswith("мөстәкыйль"), F.regexp_replace(F.regexp_replace(o, r"\Amöstä[kq]ıyl(?=.)", "möstä" + _mark("MOSTAQIL", (("pdf", "qil"), ("antat", "qıylʼ")))), r"\Amöstä[kq]ıyl\z", "möstä" + _mark("MOSTAQIL"))).otherwise(o)
    with_uw = _through(uw, lambda o: _iya(word, o), lambda o: _ie(word, o))
    other = _through(latin, lambda o: _months(word, o), *_common(word), arabic_ga, jamgiyat, mostaqil)
    return F.when(cilquar, F.regexp_replace(latin, r"\Acilqu", "cilqu" + _mark("NATIVE_UW"))).when(marked, with_uw).otherwise(other)


def _bare(word: Column, label: str, pieces: Column | None = None) -> Column:
    """Conversion of a word in which all parts between hyphens have one label."""
    return let(_joined(letter_pieces(word, label) if pieces is None else pieces), lambda x: _lexical(word, x, label))


def convert(word: Column, label: str, pieces: Column | None = None) -> Column:
    """The plain conversion; empty where it isn't clean Latin. ``pieces`` are the word's ``letter_pieces``, if they are at hand.

    In a hyphenated loanword, parts with letters that only the native language
    has are converted as native ones.
    """
    if label == "N":
        latin = _bare(word, "N", pieces)
    else:
        parts = F.split(word, "-")
        each = F.transform(parts, lambda p: F.when(p.rlike(f"[{TATAR.specific}]"), _bare(p, "N")).otherwise(_bare(p, "RL")))
        latin = F.when(word.contains("-") & word.rlike(f"[{TATAR.specific}]"), F.array_join(each, "-")).otherwise(_bare(word, "RL", pieces))
    return let(latin, lambda x: F.when(is_clean_latin(x), x).otherwise(""))


def convert_dsl(word: Column, label: str) -> Column:
    """The conversion in choice notation; empty where there is none."""

    def marked(pair: Column) -> Column:
        choices = (_native_choices if label == "N" else _loan_choices)(word, pair["latin"], pair["pieces"])
        return F.when(pair["latin"] == "", "").otherwise(_written(choices))

    return let(letter_pieces(word, label), lambda p: let(F.struct(convert(word, label, p).alias("latin"), p.alias("pieces")), marked))


def word_dimension(words: DataFrame, col: str = "word") -> DataFrame:
    """(word, native_dsl, loanword_dsl, state) of each distinct word."""
    w = F.col("word")
    out = words.select(F.col(col).alias("word")).where("word <> ''").distinct().select("word", convert_dsl(w, "N").alias("native_dsl"), convert_dsl(w, "RL").alias("loanword_dsl"))
    state = F.when((F.col("native_dsl") == "") | (F.col("loanword_dsl") == ""), "unconvertible").when(F.col("native_dsl") == F.col("loanword_dsl"), "origin_independent").otherwise("origin_dependent")
    return out.withColumn("state", state)


def suggestion(label: Column) -> Column:
    """Of a row of ``word_dimension``."""
    return F.when(label == "N", F.col("native_dsl")).when(label == "RL", F.col("loanword_dsl")).when(F.col("state") == "origin_independent", F.col("native_dsl")).otherwise("")
