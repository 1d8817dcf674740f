import pytest
from pyspark.sql import functions as F

from lingoloom.functions.dsl import COMPACT, PREFERRED, choices, dsl_error, policy, resolutions, resolve, segments, serialised
from lingoloom.functions.translit import convert, convert_dsl, suggestion, word_dimension

# fixed values: words and the spellings that a conversion must give
PLAIN = [
    ("вакыт", "N", "waqıt"), ("китап", "N", "kitap"), ("мәктәп", "N", "mäktäp"), ("гасыр", "N", "ğasır"), ("гөл", "N", "göl"), ("сөйләү", "N", "söyläw"), ("шәһәр", "N", "şähär"),
    ("сыр", "RL", "sıyr"), ("роль", "RL", "rolʼ"), ("шофёр", "RL", "şofyor"), ("борщ", "RL", "borşç"), ("цинк", "RL", "sink"), ("пицца", "RL", "pitsa"), ("орфография", "RL", "orfografiä"),
    ("әдәбият", "N", "ädäbiät"), ("киловатт-сәгәт", "RL", "kilovatt-säğät"), ("җәмгыят", "N", "cämğiyät"), ("мияубикә", "N", "miyawbikä"), ("к", "N", ""), ("белән", "N", "belän"), ("авыл", "N", "awıl"), ("авыл", "RL", "avıl"), ("к", "RL", "k"), ("", "N", ""),
    ("немец", "RL", "nemets"), ("ташлап", "N", "taşlap"), ("китәргә", "N", "kitärgä"), ("ташларга", "N", "taşlarğa"), ("тартырга", "N", "tartırğa"), ("вакытында", "N", "waqıtında"), ("гадел", "N", "ğädel"),
]
# fixed values: words and their choices
MARKED = [
    ("орфография", "RL", "orfografi{{IYA|compact=ä|explicit=yä}}"),
    ("әдәбият", "N", "ädäbi{{IYA|compact=a|explicit=ya}}t"),
    ("ретроспекция", "RL", "retrospek{{KTS_AFTER_K|s=s|ts=ts}}i{{IYA|compact=ä|explicit=yä}}"),
    ("немецләрне", "RL", "neme{{FINAL_TS_SUFFIX|stem_s=s|surface_ts=ts}}lärne"),
    ("барьер", "RL", "bar{{RUS_SIGN_E|glide=y|apostrophe=ʼ|apostrophe_glide=ʼy}}er"),
    ("музыкасын", "RL", "muz{{MUSIC_Y|short=ı|long=ıy}}kas{{MUSIC_Y|short=ı|long=ıy}}n"),
    ("фотоплёнка", "RL", "fotopl{{RUS_JOTATED_SOFTENING|glide=y|apostrophe=ʼ}}on{{RL_FINAL_KA|suffix=q|stem=k}}a"),
    ("июнь", "RL", "{{MONTH_NAME|ordinary=iyun|pdf=iyün}}{{RUS_SOFT_SIGN|omit=|preserve=ʼ}}"),
    ("буа", "N", "bu{{NATIVE_UW|plain=|glide=w}}a"),
    ("батальон", "RL", "batal{{RUS_SOFT_SIGN_O|omit=|preserve=ʼ|apostrophe_y=ʼy}}on"),
    ("вестибюль", "RL", "vestib{{RUS_BU_FRONT|yu=yu|apostrophe_front=ʼü}}l{{RUS_SOFT_SIGN|omit=|preserve=ʼ}}"),
    ("князь", "RL", "kn{{RUS_JOTATED_SOFTENING|glide=y|apostrophe=ʼ}}az{{RUS_SOFT_SIGN|omit=|preserve=ʼ}}"),
    ("геральдика", "RL", "geral{{RUS_SOFT_SIGN|omit=|preserve=ʼ}}di{{RL_FINAL_KA|suffix=q|stem=k}}a"),
    ("изоляцияләү", "RL", "izol{{RUS_JOTATED_SOFTENING|glide=y|apostrophe=ʼ}}atsi{{IYA|compact=ä|explicit=yä}}läw"),
    ("щётка", "RL", "şç{{RUS_SHCH_YO|glide=y|apostrophe=ʼ|plain=}}otka"),
    ("җәмгыят", "N", "cämği{{IYA|compact=ä|explicit=yä}}t"),
    ("мөстәкыйльлек", "N", "möstä{{MOSTAQIL|pdf=qil|antat=qıylʼ}}lek"),
    ("гади", "N", "{{ARABIC_INITIAL_GA|plain=ğadi|front=ğädi}}"),
    ("кияү", "N", "ki{{IYA|compact=ä|explicit=yä}}w"),
    ("проект", "RL", "pro{{PROJECT_E|plain=e|glide=ye}}kt"),
    ("роль", "RL", "rol{{RUS_SOFT_SIGN|omit=|preserve=ʼ}}"),
    ("шофёр", "RL", "şof{{RUS_JOTATED_SOFTENING|glide=y|apostrophe=ʼ}}or"),
    ("щетка", "RL", "şçetka"),
]


def _by_label(spark, rows, use):
    frame = spark.createDataFrame([r[:2] for r in rows], "word string, label string")
    got = frame.select("word", "label", F.when(F.col("label") == "N", use(F.col("word"), "N")).otherwise(use(F.col("word"), "RL")).alias("out")).collect()
    return {(r.word, r.label): r.out for r in got}


def test_plain_conversion(spark):
    assert _by_label(spark, PLAIN, convert) == {r[:2]: r[2] for r in PLAIN}


def test_marked_conversion(spark):
    assert _by_label(spark, MARKED, convert_dsl) == {r[:2]: r[2] for r in MARKED}


def test_every_marked_conversion_is_valid_notation(spark):
    got = spark.createDataFrame([r[:2] for r in MARKED], "word string, label string").select(dsl_error(F.when(F.col("label") == "N", convert_dsl(F.col("word"), "N")).otherwise(convert_dsl(F.col("word"), "RL"))).alias("e")).where("e is not null")
    assert got.count() == 0


def test_branches(spark):
    rows = {r.word: r for r in word_dimension(spark.createDataFrame([("белән",), ("авыл",), ("к",), ("белән",), ("",)], "word string")).withColumn("s", suggestion(F.lit("U"))).collect()}
    assert {w: r.state for w, r in rows.items()} == {"белән": "origin_independent", "авыл": "origin_dependent", "к": "unconvertible"}
    assert rows["белән"].s == "belän" and rows["авыл"].s == ""


IYA = "orfografi{{IYA|compact=ä|explicit=yä}}"


def test_resolution(spark):
    row = spark.range(1).select(resolve(F.lit(IYA)).alias("a"), resolve(F.lit(IYA), COMPACT).alias("b"), resolutions(F.lit("atel{{RUS_SIGN_E|glide=y|apostrophe=ʼ|apostrophe_glide=ʼy}}e")).alias("c"), serialised(segments(F.lit(IYA + "x" + IYA))).alias("d"), choices(F.lit(IYA)).alias("e"), resolutions(F.lit("plain")).alias("f")).first()
    assert (row.a, row.b, row.c, row.d, row.f) == ("orfografiyä", "orfografiä", ["atelye", "atelʼe", "atelʼye"], IYA + "x" + IYA, ["plain"])
    assert row.e[0].rule_id == "IYA" and [tuple(o) for o in row.e[0].options] == [("compact", "ä"), ("explicit", "yä")]


@pytest.mark.parametrize("bad", ["{{NOPE|a=b|c=d}}", "x{{IYA|compact=ä|compact=yä}}", "{{IYA|compact={{IYA|a=b|c=d}}|explicit=yä}}", "{{IYA|compact=ä", "сәлам", "", "a}}", "{{HAMZA|omit=a|preserve=ʼ}}"])
def test_invalid_notation(spark, bad):
    assert spark.range(1).select(dsl_error(F.lit(bad)).alias("e")).first().e is not None


def test_policies():
    assert policy(PREFERRED, "IYA=compact")["IYA"] == "compact"
    for bad in (("NOPE=a",), ("IYA=nope",), ("IYA",), ("IYA=compact", "IYA=explicit")):
        with pytest.raises(ValueError):
            policy(PREFERRED, *bad)
