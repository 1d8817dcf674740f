"""Running totals over ranges, and joins with frequent keys, on tables large enough to be dealt."""

from pyspark.sql import functions as F

from lingoloom.operators import dictionary, harvest
from lingoloom.operators.ranges import join_split, running_total


def test_numbers_of_many_wide_rows(spark):
    """No row is lost and no number is given twice, with adaptive execution or without."""
    n = 400_000
    rows = spark.range(n).select((F.xxhash64("id") % 1000).alias("frequency"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("word"), F.repeat(F.md5(F.col("id").cast("string")), 8).alias("wide"))
    for adaptive in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        got = running_total(rows, [-F.col("frequency"), F.col("word")], F.lit(1), "before").withColumn("number", F.col("before") + 1)
        r = got.agg(F.count("*").alias("n"), F.count_distinct("number").alias("distinct"), F.min("number").alias("low"), F.max("number").alias("high"), F.count_distinct("word").alias("words")).first()
        assert tuple(r) == (n, n, 1, n, n)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    head = [tuple(x) for x in got.where("number <= 50").orderBy("number").select("frequency", "word").collect()]
    assert head == [tuple(x) for x in rows.orderBy(F.desc("frequency"), "word").limit(50).select("frequency", "word").collect()]


def test_running_totals_match_a_plain_sum(spark):
    rows = [(i, (i * 7919) % 13, None if i % 50 == 0 else f"k{(i * 31) % 997:03}{i}") for i in range(3000)]
    got = {r.i: r.before for r in running_total(spark.createDataFrame(rows, "i int, n int, k string"), [F.col("k"), F.col("i")], F.col("n"), "before", ranges=9).collect()}
    expected, total = {}, 0
    for i, n, _ in sorted(rows, key=lambda r: (r[2] is not None, r[2] or "", r[0])):
        expected[i] = total
        total += n
    assert got == expected


def test_running_total_of_nothing_and_clashing_names(spark):
    rows = spark.createDataFrame([(3, "a", 1), (1, "b", 2)], "part int, `row` string, k0 int")
    out = running_total(rows, [F.col("part")], F.lit(1), "before", ranges=2)
    assert out.columns == ["part", "row", "k0", "before"] and sorted(map(tuple, out.collect())) == [(1, "b", 2, 0), (3, "a", 1, 1)]
    assert running_total(rows.limit(0), [F.col("part")], F.lit(1), "before").count() == 0


def test_total_cap_of_many_documents(spark):
    kept = spark.range(30_000).select(F.explode(F.sequence(F.lit(1), (F.xxhash64("id") % 3 + 3).cast("int"))).alias("rank"), F.col("id"))
    counts = dict(map(tuple, kept.groupBy("id").count().collect()))
    out = harvest.within_total(kept, harvest.HarvestConfig(max_candidates=20_000))
    got = dict(map(tuple, out.groupBy("id").count().collect()))
    assert out.count() == 20_000
    whole, left = {}, 20_000
    for i in range(30_000):
        if left <= 0:
            break
        whole[i] = min(counts[i], left)
        left -= whole[i]
    assert got == whole


def test_join_with_frequent_keys(spark):
    left = spark.createDataFrame([(i, "a" if i % 3 else f"k{i % 10}") for i in range(300)], "i int, k string")
    right = spark.createDataFrame([("a", 1, True), ("k0", 2, False), ("k3", 3, False)], "k string, v int, frequent boolean")
    for how in ("inner", "left"):
        expected = left.join(right.drop("frequent"), "k", how)
        assert sorted(map(str, join_split(left, right, "k", how).collect())) == sorted(map(str, expected.collect()))


def test_review_tasks_are_numbered_without_gaps(spark):
    words = spark.range(120_000).select(F.concat(F.lit("сүз"), F.translate(F.col("id").cast("string"), "0123456789", "абвгдежзик")).alias("word"))
    judged = words.select("word", (F.length("word") % 5).cast("long").alias("frequency"), F.lit("keep").alias("disposition"), F.lit("N").alias("label"), F.col("word").alias("display"), F.lit("x").alias("native_dsl"), F.lit("y").alias("loanword_dsl"), F.lit("origin_dependent").alias("state"))
    r = dictionary.review_tasks(judged).agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.min("id").alias("low"), F.max("id").alias("high")).first()
    assert tuple(r) == (120_000, 120_000, "word_000001", "word_120000")
