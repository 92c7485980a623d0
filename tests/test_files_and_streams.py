"""Readers, writers and streams on small files."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from winnowmill.errors import InvalidInput
from winnowmill.operators.corrections import apply_corrections
from winnowmill.operators.predict import predict_batch, with_predictions
from winnowmill.sources import readers, writers
from winnowmill.streaming import streams


def test_csv_quoting_ragged_rows_and_broken_bytes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes(b'a,b\n1,"x ""y"", z"\n2,"two\nlines"\n3\n4,d,extra\n5,caf\xc3\xa9\xff\n')
    df = readers.load_dataset(spark, str(path))
    assert dict(df.dtypes) == {"a": "string", "b": "string"}
    assert [tuple(r) for r in df.orderBy("a").collect()] == [
        ("1", 'x "y", z'), ("2", "two\nlines"), ("3", None), ("4", "d"), ("5", "café"),
    ]
    assert readers.row_count(df).first().n_rows == 5 and readers.column_names(df) == ["a", "b"]
    assert dict(readers.read_csv(spark, str(path), infer=True).dtypes)["a"] == "int"


def test_empty_csv_has_no_rows(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a,b\n")
    assert readers.row_count(readers.read_csv(spark, str(path))).first().n_rows == 0


def test_json_records_get_their_position(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text(json.dumps([{"x": 1, "y": "a"}, {"x": 2}]))
    df = readers.load_dataset(spark, str(path))
    assert sorted((r.id, r.x, r.y) for r in df.collect()) == [("0", 1, "a"), ("1", 2, None)]


def test_json_keyed(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text(json.dumps({"r1": {"x": 1, "n": {"k": [1, 2]}}, "r2": {"x": 2, "n": None}}))
    for schema in (None, "x bigint, n struct<k:array<bigint>>"):
        df = readers.read_json_keyed(spark, str(path), schema if schema is None else f"struct<x:bigint,n:struct<k:array<bigint>>>")
        assert sorted((r.id, r.x, r.n and list(r.n.k)) for r in df.collect()) == [("r1", 1, [1, 2]), ("r2", 2, None)]


def test_json_keyed_with_awkward_fields(spark, tmp_path):
    rows = {"r 1": {"x": 1, "n": {"k": [1], "a b": 1}, "q'd": 2, "id": 7}, "r2": {"x": None, "y": 2.5, "z": None}, "r3": {}}
    (tmp_path / "in.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "none.json").write_text("{}")
    got = {r["id"]: r for r in readers.read_json_keyed(spark, str(tmp_path)).collect()}
    assert set(got) == set(rows)
    assert got["r 1"]["q'd"] == 2 and got["r 1"]["n"]["a b"] == 1 and got["r2"]["y"] == 2.5
    assert got["r2"]["z"] is None and got["r3"]["x"] is None
    some = readers.read_json_keyed(spark, str(tmp_path), "x bigint, y double")
    assert some.columns == ["x", "y", "id"] and sorted((r.id, r.x, r.y) for r in some.collect()) == [("r 1", 1, None), ("r2", None, 2.5), ("r3", None, None)]


def test_formats(spark, tmp_path):
    for bad in ("a.txt", "noending", "b.xyz"):
        with pytest.raises(InvalidInput):
            readers.dataset_format(bad)
    assert readers.dataset_format("DIR/A.CSV") == "csv" and readers.dataset_format("x", "orc") == "orc"
    with pytest.raises(InvalidInput):
        readers.load_dataset(spark, "a.xlsx")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.load_dataset(spark, str(tmp_path / "none.csv"))


def test_results_append_with_one_schema(spark, tmp_path):
    df = spark.createDataFrame([(1, 'q "x"', None)], "id int, t string, u string")
    for name in ("out.csv", "out.json", "out.parquet", "out.orc"):
        path = str(tmp_path / name)
        writers.write_results(df, path)
        writers.write_results(df.withColumn("id", F.lit(2)), path)
        back = readers.load_dataset(spark, path, {"out.json": "jsonl"}.get(name))
        assert sorted((int(r["id"]) if name != "out.json" else 0, r.t, r.u) for r in back.collect())[0][1:] == ('q "x"', None)
        assert back.count() == 2 and {"t", "u"} <= set(back.columns)
    with pytest.raises(InvalidInput):
        writers.export_results_csv(df, str(tmp_path / "out.tsv"))
    writers.export_results_csv(df, str(tmp_path / "job.csv"))
    assert readers.load_dataset(spark, str(tmp_path / "job.csv")).first().t == 'q "x"'


def test_audit_columns_and_tables(spark, tmp_path):
    path = str(tmp_path / "audit.json")
    writers.write_json_records(
        spark.createDataFrame([(2, "b", 0.5, "exclude"), (1, "a", 0.25, None)], "id int, clean_label string, label_quality double, action string"), path
    )
    short = readers.read_audit_columns(spark, path, "row", include_audit=False, format="jsonl", sort=True)
    assert [tuple(r) for r in short.collect()] == [(1, "a"), (2, "b")]
    full = readers.read_audit_columns(spark, path, "row", include_project=True, format="jsonl")
    assert full.columns == ["row", "clean_label", "label_quality", "action"]
    assert readers.load_table(spark, "json", path=path).count() == 2


def test_vectors(spark):
    df = spark.createDataFrame([(1, 0.5, 2)], "id int, a float, b int")
    assert readers.read_vectors(df, "id", ["a", "b"], "v").first() == (1, [0.5, 2.0])
    assert readers.read_vectors(df, "id", ["a", "b"], "v", keep_id=False).columns == ["v"]


def test_predictions(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0, 0.0]), (2, [0.5, 0.0, 0.5])], "id int, p array<double>")
    one = with_predictions(df, "p", ["oak", "ash", "elm"])
    assert one.columns == ["id", "predicted_label", "oak", "ash", "elm"]
    assert [r.predicted_label for r in one.collect()] == ["ash", "oak"]
    many = with_predictions(df, "p", ["oak", "ash", "elm"], multi_label=True, prob_columns=False)
    assert [r.predicted_label for r in many.collect()] == [["ash"], ["oak", "elm"]]
    texts = spark.createDataFrame([(1, "aa"), (2, "b")], "id int, t string")

    def model(s):
        import pandas

        return pandas.Series([[n / 2, 1 - n / 2] for n in s.str.len()])

    assert [r.predicted_label for r in predict_batch(texts, model, ["x", "y"], "t", "id").collect()] == ["x", "x"]


# --- streams -------------------------------------------------------------------------------------


def _arrive(folder, number, rows):
    folder.mkdir(exist_ok=True)
    pd.DataFrame(rows, columns=["id", "label", "score"]).to_csv(folder / f"{number}.csv", index=False)


SCHEMA = "id bigint, label string, score double"


def test_enrichment_resumes_without_repeating(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    seen = spark.sparkContext.accumulator(0)

    def scorer(batch):
        import pandas

        seen.add(len(batch))
        return pandas.DataFrame({"response": batch["prompt"], "trustworthiness_score": 0.5})

    def run():
        stream = streams.stream_records(spark, str(source), SCHEMA)
        query = streams.resumable_enrich(
            stream, state, out, lambda s: streams.enrich_stream(s, "about {label}", scorer, ["id"], new_column="m")
        )
        query.awaitTermination()

    _arrive(source, 1, [(1, "x", 0.1), (2, "y", 0.2)])
    run()
    assert seen.value == 2
    _arrive(source, 2, [(3, "z", 0.3)])
    run()
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == [(1, "about x", 0.5), (2, "about y", 0.5), (3, "about z", 0.5)] and seen.value == 3


def test_progress_and_corrections_equal_the_batch(spark, tmp_path):
    source = tmp_path / "in"
    _arrive(source, 1, [(1, "x", 0.5), (2, "y", None)])
    _arrive(source, 2, [(3, "x", 0.25), (4, "z", 1.0)])
    batch = spark.read.schema(SCHEMA).option("header", True).csv(str(source))
    stream = streams.stream_records(spark, str(source), SCHEMA, files_per_batch=1)
    query = streams.progress_stream(stream, "score", "label").writeStream.format("memory").queryName("progress")
    query.outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    from winnowmill.operators.jobs import job_progress

    assert sorted(map(tuple, spark.table("progress").collect())) == sorted(map(tuple, job_progress(batch, "score", "label").collect()))

    audit = spark.createDataFrame([(1, None, "q"), (4, "exclude", None)], "id bigint, action string, corrected_label string")
    fixed = streams.corrections_stream(stream, audit, "id", "label").writeStream.format("memory").queryName("fixed")
    fixed.trigger(availableNow=True).start().awaitTermination()
    expected = apply_corrections(batch, audit, "id", "label", how="dataset")
    assert sorted(map(tuple, spark.table("fixed").collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
