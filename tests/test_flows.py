"""Sources, sinks, run history, streams and the end-to-end plans."""

import os
from datetime import datetime

import pytest
from conftest import frame
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from clickscore.contract import SESSION
from clickscore.operators import deciding as H
from clickscore.operators import learning as L
from clickscore.operators import runs as J
from clickscore.operators import scoring as Sc
from clickscore.plans import batch_scoring, profile, training
from clickscore.sources import clickstream, readers, writers
from clickscore.streaming import scoring as K


def test_sessions_survive_a_csv_round_trip(spark, sessions, tmp_path):
    rows = sessions.select(*SESSION.columns).withColumn("extra", F.lit(1))
    path = writers.write_table(rows, str(tmp_path), "sessions.csv", fmt="csv")
    again = readers.read_sessions(spark, path)
    assert again.schema == SESSION.schema or again.columns == list(SESSION.columns)
    assert again.exceptAll(rows.drop("extra")).count() == 0 == rows.drop("extra").exceptAll(again).count()


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_sessions_from_columnar_files_and_missing_columns(spark, sessions, tmp_path, fmt):
    path = writers.write_table(sessions, str(tmp_path), f"s.{fmt}", fmt=fmt)
    assert readers.read_sessions(spark, path).count() == sessions.count()
    short = writers.write_table(sessions.drop("Month", "Revenue"), str(tmp_path), f"t.{fmt}", fmt=fmt)
    with pytest.raises(ValueError, match=r"\['Month', 'Revenue'\]"):
        readers.read_sessions(spark, short)


def test_uploads_are_text_and_blank_words_are_null(spark, tmp_path):
    path = tmp_path / "up.csv"
    path.write_text("A b,A b2,c\n1,n/a,x\nNA,2.50,\n")
    df = readers.read_upload(spark, str(path))
    assert dict(df.dtypes) == {"A b": "string", "A b2": "string", "c": "string"}
    assert [tuple(r) for r in df.collect()] == [("1", None, "x"), (None, "2.50", None)]


def test_json_rows_keep_nesting(spark, tmp_path):
    df = spark.range(1).select(F.struct(F.lit(1).alias("a"), F.array(F.lit("x")).alias("b")).alias("s"))
    path = writers.write_json(df, str(tmp_path), "doc")
    assert spark.read.text(path).first()[0] == '{"s":{"a":1,"b":["x"]}}'


# A recorded history of three model runs under one session.
HISTORY = [
    ("XGBoost", "m3", "2026-07-30 20:25:51", 0.7231829130710589, 0.7539728929333233, 0.7546, 0.9367, 0.6702, 0.8377, 8.178),
    ("Random Forest", "m2", "2026-07-30 20:23:26", 0.7173852896272296, 0.7515119024181226, 0.7428, 0.9328, 0.6589, 0.8115, 32.19),
    ("Logistic Regression", "m1", "2026-07-30 20:21:32", 0.645930188790097, 0.6552421427990298, 0.6701, 0.9157, 0.6475, 0.7644, 4.677),
]


@pytest.fixture(scope="module")
def history(spark):
    out = J.record_run(
        spark, "s1", "training-session", datetime(2026, 7, 30, 20, 21, 30), "RUNNING",
        metrics={"operating_threshold": 0.7, "model_size_mb": 0.474, "ok": True, "note": "text"},
        params={"long": "x" * 600}, tags={"selected_model": "XGBoost"},
    )
    for name, run_id, when, *values in HISTORY:
        metrics = dict(zip(J.COMPARISON, values))
        out = out.unionByName(
            J.record_run(spark, run_id, name, datetime.fromisoformat(when), parent_run_id="s1", metrics=metrics)
        )
    return out.persist()


def test_only_real_numbers_are_metrics_and_texts_are_whole(history):
    kept = {r["key"] for r in history.filter("run_id = 's1' AND kind = 'metric'").collect()}
    assert kept == {"operating_threshold", "model_size_mb"}
    assert len(history.filter("key = 'long'").first()["value"]) == 600


def test_runs_change_state_and_may_have_no_values(spark, history):
    at = datetime(2026, 7, 31)
    more = J.record_run(spark, "m1", "Logistic Regression", at, "FINISHED", "s1", metrics={"test_f1": 0.9})
    empty = J.record_run(spark, "e1", "empty", at)
    tagged = J.record_run(spark, "t1", "tagged", at, parent_run_id="s1", tags={"a": 1})
    first = J.record_run(
        spark, "m1", "Logistic Regression", at, "RUNNING", "s1", metrics={"test_f1": 2.0}, recorded_at=datetime(2020, 1, 1)
    )
    every = history.unionByName(more).unionByName(empty).unionByName(tagged).unionByName(first)
    runs = {r["run_id"]: r for r in J.classify_runs(every).collect()}
    assert set(runs) == {"s1", "m1", "m2", "m3", "e1", "t1"}
    assert runs["m1"]["status"] == "FINISHED" and runs["e1"]["n_values"] == 0
    wide = {r["run_id"]: r for r in J.runs_wide(every).collect()}
    assert set(wide) == set(runs) and wide["m1"]["metrics.test_f1"] == 0.9
    rows = J.runs_comparison(every).collect()
    assert len(rows) == 4 and sum(r["is_best"] for r in rows) == 1
    summary = J.runs_summary(every).first()
    assert (summary["n_session_runs"], summary["n_model_runs"]) == (2, 4)


def test_more_than_a_thousand_keys(spark):
    one = J.record_run(spark, "k", "k", datetime(2026, 1, 1), params={f"p{i}": i for i in range(1200)})
    assert len(J.run_keys(one)) == 1200


def test_comparison_marks_the_best_run(history):
    rows = J.runs_comparison(history).collect()
    assert [r["Model"] for r in rows] == [h[0] for h in HISTORY]
    assert [r["is_best"] for r in rows] == [True, False, False]
    assert rows[0]["Test PR-AUC"] == 0.7546 and rows[1]["Latency (ms)"] == 32.19


def test_session_and_summary(history):
    last = J.latest_session(history).first()
    assert (last["selected_model"], last["operating_threshold"], last["final_recall"]) == ("XGBoost", 0.7, None)
    summary = {r["run_name"]: r for r in J.runs_summary(history).collect()}
    assert len(summary) == 3
    assert (summary["XGBoost"]["n_session_runs"], summary["XGBoost"]["n_model_runs"]) == (1, 3)
    assert summary["Random Forest"]["Test ROC-AUC"] == 0.9328
    kinds = {r["run_id"]: r["is_model_run"] for r in J.classify_runs(history).collect()}
    assert kinds == {"s1": False, "m1": True, "m2": True, "m3": True}


def test_wide_history_round_trip(spark, history, tmp_path):
    wide = J.runs_wide(history)
    assert wide.columns[:5] == ["run_id", "run_name", "status", "start_time", "is_model_run"]
    assert wide.columns[5:] == sorted(wide.columns[5:])
    path = writers.write_table(wide.drop("run_id"), str(tmp_path), "wide.csv", fmt="csv", one_file=True)
    long = readers.read_wide_runs(spark, path)
    assert {r["Model"]: r["Test F1"] for r in J.runs_comparison(long).collect()} == {h[0]: h[7] for h in HISTORY}


def test_absent_or_malformed_history_is_empty(spark, history, tmp_path):
    assert readers.read_runs(spark, str(tmp_path / "nothing")).count() == 0
    bad = tmp_path / "bad.csv"
    bad.write_text("a,b\n1,2\n")
    assert readers.read_runs(spark, str(bad)).count() == 0
    assert readers.read_wide_runs(spark, str(bad)).count() == 0
    path = writers.append_rows(history, str(tmp_path / "runs.parquet"))
    assert readers.read_runs(spark, path).count() == history.count()


def test_stream_scores_equal_batch_scores(spark, unique, linear, tmp_path):
    rows = unique.select("row_id", *SESSION.features)
    source = str(tmp_path / "in")
    rows.repartition(4).write.parquet(source)
    stream = K.score_stream(K.read_session_stream(spark, source, rows.schema, files_per_batch=2), linear)
    K.write_scored_stream(stream, str(tmp_path / "out"), str(tmp_path / "log"), once=True).awaitTermination()
    got, want = spark.read.parquet(str(tmp_path / "out")), Sc.score(rows, linear)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_history_stream_continues_and_keeps_newest(spark, unique, linear, tmp_path):
    rows = unique.select("row_id", *SESSION.features)
    source, sink, log = (str(tmp_path / n) for n in ("in", "history", "log"))
    for part in range(2):
        # Row ids of unique sessions are even.
        half = rows.filter(F.col("row_id") % 4 == 2 * part)
        assert half.count() > 20
        half.coalesce(1).write.mode("append").parquet(source)
        stream = K.score_stream(K.read_session_stream(spark, source, rows.schema), linear)
        K.write_history_stream(stream, sink, log, once=True).awaitTermination()
    assert spark.read.parquet(sink).count() == rows.count()
    latest = K.latest_history(spark, sink, n=20).collect()
    assert len(latest) == 20 and all(r["row_id"] % 4 == 2 for r in latest)
    assert [r["row_id"] for r in latest] == sorted((r["row_id"] for r in latest), reverse=True)


def test_latest_view_is_kept_per_batch_and_survives_a_replay(spark, unique, linear, tmp_path):
    rows = unique.select("row_id", *SESSION.features)
    source, sink, log = (str(tmp_path / n) for n in ("in", "history", "log"))

    def run():
        stream = K.score_stream(K.read_session_stream(spark, source, rows.schema, files_per_batch=1), linear)
        K.write_history_stream(stream, sink, log, once=True, n=30).awaitTermination()

    for part in range(4):
        rows.filter(F.floor(F.col("row_id") / 2) % 4 == part).limit(12).coalesce(1).write.mode("append").parquet(source)
        run()
    key = lambda df: [(r["batch_id"], r["row_id"]) for r in df.collect()]
    history = spark.read.parquet(sink)
    want = key(H.prediction_history(history, 30))
    assert key(K._view(spark, sink)) == want and len({b for b, _ in want}) == 3
    assert len(K._views(spark, sink)) == 2
    # The last batch is done again, as after a failure before it was committed.
    for name in ("3", ".3.crc"):
        os.remove(f"{log}/commits/{name}")
    run()
    assert spark.read.parquet(sink).count() == 48
    assert key(K._view(spark, sink)) == want == key(K.latest_history(spark, sink, n=30))
    assert K.latest_history(spark, sink).count() == 48  # more than the view holds


def test_scoring_a_file_keeps_the_callers_columns(spark, sessions, linear, tmp_path):
    up = clickstream.uploads_from_sessions(sessions, "padded")
    path = writers.write_scored(up, str(tmp_path / "up.csv"))
    out = str(tmp_path / "scored")
    summary, top, got = batch_scoring.score_file(spark, path, out, linear, 0.5)
    written = spark.read.option("header", True).csv(out)
    assert written.columns == ["session_id", *SESSION.features, "campaign", *Sc.SCORE_COLUMNS]
    assert written.count() == summary.first()["n_sessions"] == sessions.count()
    assert summary.first()["n_flagged"] == written.filter("prediction = 'Purchase'").count()
    assert top.count() == 25 and got.strategy == "exact"


def test_profile_report_and_stored_input_profile(spark, sessions, tmp_path):
    tables = profile.profile_tables(sessions)
    assert tables["quality"].count() == 18 and tables["outliers"].count() == 15
    doc = profile.profile_summary(tables).first()
    assert doc["null_total"][0]["n_null"] == 0 and len(doc["outliers"]) == 15
    folder = str(tmp_path / "profile")
    profile.write_input_profile(sessions, folder)
    stored = readers.read_profile(spark, folder)
    assert stored["numeric_ranges"].count() == 10 and stored["segment_presets"].count() >= 1
    with pytest.raises(FileNotFoundError, match="write_input_profile"):
        readers.read_profile(spark, str(tmp_path / "nothing"))


def test_training_end_to_end(spark, sessions):
    small = dict(labelCol=L.LABEL, weightCol=L.WEIGHT, maxIter=3, standardization=False)
    families = {
        "mild": L.Candidate(LogisticRegression(regParam=1e-3, **small), {"regParam": [1e-3]}, "a"),
        "harsh": L.Candidate(LogisticRegression(regParam=50.0, **small), {"regParam": [50.0]}, "b"),
    }
    got = training.train(sessions, families=families, draws=1, parallelism=4, folds=2)
    card = got.card.first()
    assert card["model_name"] == got.name
    assert card["dataset"]["rows_used"] == card["dataset"]["train_rows"] + card["dataset"]["test_rows"]
    assert set(card["comparison"]) == set(families)
    assert sum(card["confusion"].values()) == card["dataset"]["test_rows"]
    assert sum(r["count"] for r in got.tables["calibration_curve"].collect()) == card["dataset"]["test_rows"]
    assert 0.05 <= got.threshold <= 0.95 and got.tables["threshold_sweep"].count() == 91
    assert len(card["top_features"]) == 15


def test_frame_helper_matches_the_contract(spark):
    assert frame(spark, {}).select(*SESSION.columns).schema.names == SESSION.schema.names
