"""Tables that change together, their schemas, and the command line over them."""

import json

import pytest
from pyspark.sql import functions as F

from lingoloom.plans import cli
from lingoloom.sources import tables
from lingoloom.sources.store import ConcurrentCommit, SchemaMismatch, TableStore, conformed


def _values(store, name):
    return sorted(r.id for r in store.read(name).select(F.col("id").cast("string").alias("id")).collect())


def test_outputs_appear_together(spark, tmp_path):
    root = f"file://{tmp_path}/db"
    samples, state = tables.selected_tables(spark.createDataFrame([(1, "x", "Ел."), (2, "y", "Юл.")], "rank int, id string, sentence string"))
    assert tables.write_together({"samples": samples, "state": state}, root) == 1
    assert [r.id for r in tables.read_table(spark, root, "samples").orderBy("id").collect()] == ["sent_000001", "sent_000002"]
    with pytest.raises(FileExistsError):
        tables.write_together({"samples": samples}, root)
    assert tables.write_together({"samples": samples.limit(1)}, root, force=True) == 2
    assert tables.read_table(spark, root, "samples").count() == 1 and tables.read_table(spark, root, "state").count() == 2
    store = TableStore(spark, root)
    assert store.read("samples", 1).count() == 2 and store.vacuum() == 0
    store.commit({"state": state.limit(1)})
    assert store.vacuum() == 1 and store.read("state").count() == 1 and store.read("samples").count() == 1


@pytest.mark.parametrize("step", ["first write", "second write", "publish", "create", "rename"])
def test_a_failure_leaves_the_old_tables(spark, tmp_path, step, monkeypatch):
    store = TableStore(spark, f"file://{tmp_path}/db")
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "id long")
    store.commit({"a": ids(1), "b": ids(2)})
    broken = spark.range(1).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    outputs = {"a": broken if step == "first write" else ids(3), "b": broken if step == "second write" else ids(4)}
    if step == "publish":
        monkeypatch.setattr(store, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    if step in ("create", "rename"):  # a file where the folder of commits should be, or the commit's name taken
        real = store._publish

        def publish(version, found):
            if step == "rename":
                store.fs.create(store._path("commits", f"{version:012}.json"), False).close()
                try:
                    real(version, found)
                finally:
                    store.fs.delete(store._path("commits", f"{version:012}.json"), False)
            else:
                raise OSError("no space")

        monkeypatch.setattr(store, "_publish", publish)
    with pytest.raises(Exception):  # noqa: B017
        store.commit(outputs)
    assert store.version() == 1 and _values(store, "a") == ["1"] and _values(store, "b") == ["2"]
    assert len(list((tmp_path / "db" / "data").iterdir())) == 1 and [p.name for p in (tmp_path / "db" / "commits").iterdir() if not p.name.startswith(".")] == ["000000000001.json"]


def test_of_two_writers_one_fails(spark, tmp_path):
    one, two = (TableStore(spark, f"file://{tmp_path}/db") for _ in range(2))
    one.commit({"a": spark.range(1)})
    began = two.version()
    one.commit({"a": spark.range(2)}, since=began)
    with pytest.raises(ConcurrentCommit):
        two.commit({"a": spark.range(3)}, since=began)
    # both saw the same version, and the other was faster
    found = two.tables()
    with pytest.raises(ConcurrentCommit):
        two._publish(2, found)
    assert one.version() == 2 and _values(two, "a") == ["0", "1"]


def test_conformed_schemas(spark):
    old = spark.createDataFrame([(1, 2.5, [1], "x")], "a int, f float, l array<int>, own string")
    new = conformed(old, "b string not null, a bigint, f double, l array<bigint>, c int", {"b": "new", "c": 7})
    assert new.dtypes == [("b", "string"), ("a", "bigint"), ("f", "double"), ("l", "array<bigint>"), ("c", "int"), ("own", "string")]
    assert tuple(new.first()) == ("new", 1, 2.5, [1], 7, "x")
    for schema in ("a smallint", "a string", "f float, a float", "l array<string>", "b string not null"):
        with pytest.raises(SchemaMismatch):
            conformed(old, schema)
    assert conformed(old, "missing date").first().missing is None


def test_a_table_is_created_when_missing(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/db")
    assert store.ensured("words", "id long, note string").collect() == [] and not store.has("words")
    store.commit({"words": spark.range(2)})
    assert [tuple(r) for r in store.ensured("words", "note string, id long", {"note": "-"}).orderBy("id").collect()] == [("-", 0), ("-", 1)]


def test_command_line(spark, tmp_path, monkeypatch):
    """prepare, select, report, export, import and training one after another, over a folder of tables."""
    text = " ".join(f"Вакыт {w} мәктәптә яхшы үтте, {w} гадел булды." for w in ("бүген", "кичә", "иртәгә", "көндез", "төнлә", "иртән"))
    spark.createDataFrame([("d1", text), ("d2", text.replace("Вакыт", "Халык"))], "id string, text string").write.parquet(f"{tmp_path}/docs")
    run = lambda *args: cli.main([a.format(t=f"file://{tmp_path}") for a in args])
    assert run("prepare", "--documents", "{t}/docs", "--output", "{t}/candidates") == 0
    found = spark.read.parquet(f"{tmp_path}/candidates")
    assert found.count() > 4
    assert run("select", "--candidates", "{t}/candidates", "--output", "{t}/db", "--target-size", "5", "--min-word-frequency", "1") == 0
    store = TableStore(spark, f"file://{tmp_path}/db")
    assert store.read("samples").count() == 5 == store.read("preannotation_state").where("status = 'pending'").count()
    with pytest.raises(FileExistsError):
        run("select", "--candidates", "{t}/candidates", "--output", "{t}/db", "--target-size", "5")
    assert run("report", "--selected", "{t}/db", "--output", "{t}/report") == 0 and TableStore(spark, f"file://{tmp_path}/report").read("headline").count() == 1
    tokens = F.to_json(F.transform(F.filter(F.split("text", r"[ ,.]+"), lambda w: w != ""), lambda w: F.struct(w.alias("text"), F.lit("N").alias("label"))))
    labelled = store.read("preannotation_state").drop("tatar", "tokens_json").join(store.read("samples").select(F.col("id").alias("sample_id"), tokens.alias("tokens_json")), "sample_id").withColumn("status", F.lit("annotated")).withColumn("tatar", F.lit(1))
    store.commit({"preannotation_state": labelled})
    assert run("annotation-export", "--db", "{t}/db", "--output", "{t}/tasks", "--track-exported", "--now", "today") == 0
    (part,) = (tmp_path / "tasks").glob("part-*")
    tasks = json.loads(part.read_text())
    assert tasks and store.read("exported_words").count() == len(tasks)
    word = tasks[0]["data"]["cyrl_word"]
    result = [{"from_name": "reviewed_origin", "type": "choices", "value": {"choices": ["N"]}}, {"from_name": "corrected_zamanalif", "type": "textarea", "value": {"text": ["waqıt"]}}]
    (tmp_path / "export.json").write_text(json.dumps([{"data": {"cyrl_word": word}, "annotations": [{"result": result}]}, {"data": {"cyrl_word": "сүз"}, "annotations": []}]))
    assert run("annotation-import", "--db", "{t}/db", "--input", "{t}/export.json", "--now", "today") == 0
    assert [tuple(r)[:2] for r in store.read("reviewed_words").collect()] == [(word, "waqıt")]
    before = store.version()
    (tmp_path / "bad.json").write_text(json.dumps([{"data": {"cyrl_word": word}, "annotations": [{"result": result[:1]}]}]))
    with pytest.raises(ValueError, match="corrected_zamanalif"):
        run("annotation-import", "--db", "{t}/db", "--input", "{t}/bad.json", "--now", "today")
    assert store.version() == before
    assert run("training-export", "--db", "{t}/db", "--output", "{t}/training") == 0
    assert TableStore(spark, f"file://{tmp_path}/training").read("training").columns == ["id", "cyrillic", "zamanalif"]
