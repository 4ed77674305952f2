import pytest
from catalog.queries import SPELLINGS
from conftest import TYPICAL, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscore.contract import SESSION
from clickscore.functions import coercion as C
from clickscore.operators import alignment as A
from clickscore.operators import scoring
from clickscore.sources.clickstream import uploads_from_sessions

FEATURES = list(SESSION.features)


def scores(df, model):
    return {r["session_id"]: r["purchase_probability"] for r in df.collect()}


@pytest.fixture(scope="module")
def plain(sessions, linear):
    up = uploads_from_sessions(sessions, "exact")
    return scores(scoring.score_upload(up, linear)[0], linear)


@pytest.mark.parametrize("style", ["renamed", "recased", "yes_no", "decimal_codes", "padded"])
def test_disguised_uploads_score_alike(sessions, linear, plain, style):
    up = uploads_from_sessions(sessions, style)
    scored, got = scoring.score_upload(up, linear)
    assert got.trustworthy
    assert got.strategy == ("normalised" if style == "renamed" else "exact")
    assert scores(scored, linear) == plain
    assert scored.columns == [*up.columns, *scoring.SCORE_COLUMNS]


def test_positional_upload_scores_alike_but_is_not_trusted(sessions, linear, plain):
    up = uploads_from_sessions(sessions, "anonymous")
    with pytest.raises(ValueError):
        scoring.score_upload(up, linear)
    scored, got = scoring.score_upload(up, linear, allow_positional=True)
    assert (got.strategy, got.trustworthy) == ("positional", False)
    assert got.mapping["Administrative"] == "col_0"
    assert A.FIRST_ONLY.format(n=17, m=18) in got.notes
    assert scores(scored, linear) == plain


def test_scores_differ_without_alignment(sessions, linear, plain):
    raw = sessions.withColumn("Month", F.lower("Month")).withColumn("session_id", F.col("row_id").cast("string"))
    assert scores(scoring.score(raw, linear), linear) != plain


@pytest.mark.parametrize("names", [["a", "b", "c", "d", "e"], [f"field_{i}" for i in range(20)]])
def test_unrelated_tables_are_refused(names):
    with pytest.raises(ValueError):
        A.match_columns(names, allow_positional=False)


def test_too_few_columns_are_refused_even_by_position():
    with pytest.raises(ValueError, match="17"):
        A.match_columns(["a", "b", "c"], allow_positional=True)


def test_first_column_wins_when_names_collide(spark):
    loose = [n.lower() for n in FEATURES]
    strategy, spots, _ = A.match_columns(["PAGE VALUES", *loose], allow_positional=False)
    assert strategy == "normalised"
    assert spots[FEATURES.index("PageValues")] == 0
    doubled = frame(spark, {}).select(*FEATURES, F.col("Month").alias("month"))
    assert A.align(doubled).frame.first()["Month"] == "Nov"


@settings(max_examples=60, deadline=None)
@given(st.permutations(FEATURES), st.data())
def test_renaming_and_order_never_change_the_match(names, data):
    styles = st.sampled_from([str.upper, str.lower, str.title, lambda s: s.replace("_", " "), lambda s: f" {s}-"])
    renamed = [data.draw(styles)(n) for n in names]
    _, spots, _ = A.match_columns(renamed, allow_positional=False)
    assert [names[i] for i in spots] == FEATURES


def one(spark, text, make, dtype=T.StringType()):
    df = spark.createDataFrame([(t,) for t in text], T.StructType([T.StructField("x", dtype)]))
    return [r[0] for r in df.select(make(F.col("x"), dtype)).collect()]


def test_numbers_from_text(spark):
    text = ["1", " 2.5 ", "1e3", "-.5", "n/a", "", None, "1d", "0x10", "nan", "inf", "1,5"]
    got = one(spark, text, C.to_number)
    assert got == [1.0, 2.5, 1000.0, -0.5, None, None, None, None, None, None, None, None]


def test_codes_from_text(spark):
    text = ["2", "2.0", "2.5", "3.5", "x", None, "1e300"]
    assert one(spark, text, C.to_code) == [2, 2, 2, 4, -1, -1, -1]
    assert one(spark, [2.0, None], C.to_code, T.DoubleType()) == [2, -1]


def test_flags_from_text(spark):
    text = ["Yes", " TRUE ", "t", "1", "no", "F", "0", "0.0", "2", "maybe", "", None]
    want = [True, True, True, True, False, False, False, False, True, True, False, False]
    assert one(spark, text, C.to_flag) == want


def test_missing_category_is_unknown_not_imputed(spark):
    got = A.align(frame(spark, {"Month": None, "Browser": None}), levels=SPELLINGS).frame.first()
    assert (got["Month"], got["Browser"]) == ("nan", -1)


def test_repairs_are_counted_once_each(spark):
    df = frame(spark, {}, {}, {}).select(*[F.col(c).cast("string").alias(c) for c in FEATURES])
    df = df.withColumns({"PageValues": F.lit("abc"), "Browser": F.lit("?"), "Month": F.lit("NOV")})
    got = A.align(df, levels=SPELLINGS)
    counts = {(r["column"], r["repair"]): r["n"] for r in got.coercion_counts().collect()}
    assert counts == {("PageValues", "not_numeric"): 3, ("Browser", "not_code"): 3, ("Month", "recased"): 3}
    assert all(r["note"].startswith(f"{r['column']}: 3 ") for r in got.coercion_notes().collect())
    assert got.mapping_table().count() == 17


def test_recognised_and_required(spark):
    df = frame(spark, {}).drop("PageValues", "Month")
    assert A.recognised(df) == (15, 17)
    with pytest.raises(ValueError, match="PageValues"):
        A.require_columns(df)
    assert TYPICAL["Month"] == "Nov"


@pytest.mark.parametrize("how", ["list", "table", "shuffled"])
def test_many_levels_are_joined_with_the_same_result(spark, sessions, monkeypatch, how):
    """A hundred thousand fitted spellings: values and notes as with the short list."""
    up = uploads_from_sessions(sessions, "recased")
    few = A.align(up, levels=SPELLINGS)
    many = {c: [*v, *(f"Level {i}" for i in range(100_000))] for c, v in SPELLINGS.items()}
    if how != "list":
        many = {c: spark.createDataFrame([(x,) for x in v], "level string") for c, v in many.items()}
    if how == "shuffled":
        monkeypatch.setattr(A, "BROADCAST_BYTES", 0)
    got = A.align(up, levels=many)
    assert got.frame.count() == few.frame.count() and got.frame.exceptAll(few.frame).count() == 0
    assert got.coercion_counts().exceptAll(few.coercion_counts()).count() == 0
