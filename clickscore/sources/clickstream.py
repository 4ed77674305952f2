"""Derive session, scored and run tables from raw event and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickscore.contract import SESSION


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sessions_from_events(events: DataFrame) -> DataFrame:
    """One session per user and day, with the 18 contract columns and ``row_id``.

    Two shuffles: events by (user, day) with map-side combine, then the much
    smaller user-day rows by user to number each user's days.
    """
    # One number that orders like (ts, event_id): numeric buffers keep the aggregate hashed.
    at = F.expr(
        "CAST(unix_micros(CAST(ts AS TIMESTAMP)) AS DECIMAL(38, 0)) * 10000000000000000000BD + event_id"
    ).cast("decimal(38,0)")
    seen = events.select(
        "user_id",
        F.to_date("ts").alias("day"),
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        at.alias("at"),
    )

    def hits(*kinds: str):
        return F.count_if(F.col("event_type").isin(*kinds))

    def spent(*kinds: str):
        total = F.sum(F.when(F.col("event_type").isin(*kinds), F.col("value")))
        return F.round(F.coalesce(total, F.lit(0.0)), 2)

    days = seen.groupBy("user_id", "day").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("k", "at").alias("k1"),
        hits("signup").alias("Administrative"),
        spent("signup").alias("Administrative_Duration"),
        hits("error").alias("Informational"),
        spent("error").alias("Informational_Duration"),
        hits("view", "click").alias("ProductRelated"),
        spent("view", "click").alias("ProductRelated_Duration"),
        hits("purchase").alias("purchases"),
        spent("purchase").alias("paid"),
    )
    nth_day = F.row_number().over(Window.partitionBy("user_id").orderBy("day"))
    months = F.lit(["Feb", "Mar", "May", "June", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"])
    n = F.col("n").cast("double")
    shaped = days.withColumn("nth_day", nth_day).select(
        "user_id",
        "day",
        *[c for pair in SESSION.visits for c in pair],
        F.when(F.col("n") == 1, F.lit(0.2)).otherwise(F.lit(0.0)).alias("BounceRates"),
        F.round(F.lit(0.2) / n, 4).alias("ExitRates"),
        F.round(F.col("paid") / n, 4).alias("PageValues"),
        ((F.col("k1") % 6).cast("double") / F.lit(5.0)).alias("SpecialDay"),
        F.element_at(months, F.col("k1") % 10 + 1).alias("Month"),
        F.when(F.col("k1") % 50 == 0, "Other")
        .when(F.col("nth_day") <= 4, "New_Visitor")
        .otherwise("Returning_Visitor")
        .alias("VisitorType"),
        F.weekday("day").isin(5, 6).alias("Weekend"),
        (F.col("k1") % 8 + 1).cast("int").alias("OperatingSystems"),
        (F.col("k1") % 13 + 1).cast("int").alias("Browser"),
        (F.col("user_id") % 9 + 1).cast("int").alias("Region"),
        (F.col("k1") % 20 + 1).cast("int").alias("TrafficType"),
        (F.col("purchases") >= 2).alias("Revenue"),
    )
    copies = F.when(F.col("user_id") % 40 == 7, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return shaped.withColumn("copy", F.explode(copies)).select(
        *SESSION.columns,
        # Days since the epoch: unique over any span of days, twice for the copy.
        ((F.col("user_id") * 100_000 + F.unix_date(F.col("day").cast("date"))) * 2 + F.col("copy")).alias("row_id"),
    )


def scored_from_events(events: DataFrame) -> DataFrame:
    """Scored pairs: (row_id, scored_at, probability, label) and two profile columns."""
    return events.select(
        F.col("event_id").alias("row_id"),
        F.col("ts").alias("scored_at"),
        F.least(F.col("value") / F.lit(500.0), F.lit(1.0)).alias("probability"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )


def model_scores_from_events(events: DataFrame) -> DataFrame:
    """Three competing scores per row in long form, from a single scan."""
    base = scored_from_events(events)
    p, k = F.col("probability"), F.col("k") / F.lit(100.0)
    rival = F.array(
        F.struct(F.lit("by_value").alias("model"), p.alias("probability")),
        F.struct(F.lit("by_key").alias("model"), k.alias("probability")),
        F.struct(F.lit("inverted").alias("model"), (F.lit(1.0) - p).alias("probability")),
    )
    return base.select("row_id", "label", F.inline(rival))


def scored_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Scored pairs of the largest table; has no row key, so only for aggregates."""
    return lineitem.select(
        (F.col("l_quantity") / F.lit(51.0)).alias("probability"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )


def runs_from_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Run history in long form: one session run per customer, one model run per order.

    Model runs are recorded twice, first as running.  Of ten sessions one has no values and
    one has a tag only.
    """
    head = F.struct(
        F.lit("run").alias("kind"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value")
    )
    metric = F.array(
        *[
            F.struct(
                F.lit("metric").alias("kind"),
                F.lit(name).alias("key"),
                value.cast("string").alias("value"),
            )
            for name, value in (
                ("cv_pr_auc_baseline", F.col("o_totalprice") / F.lit(1e6)),
                ("cv_pr_auc_tuned", F.col("o_totalprice") / F.lit(8e5)),
                ("test_pr_auc", F.col("o_totalprice") / F.lit(5e5)),
                ("test_roc_auc", F.lit(1.0) - F.col("o_totalprice") / F.lit(2e6)),
                ("test_f1", F.col("o_totalprice") / F.lit(7e5)),
                ("test_recall", F.col("o_totalprice") / F.lit(6e5)),
            )
        ],
        F.struct(
            F.lit("param").alias("kind"),
            F.lit("priority").alias("key"),
            F.col("o_orderpriority").alias("value"),
        ),
        head,
    )
    models = orders.select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("parent_run_id"),
        F.col("o_orderpriority").alias("run_name"),
        F.when(F.col("o_orderstatus") == "F", "FINISHED")
        .when(F.col("o_orderstatus") == "O", "RUNNING")
        .otherwise("FAILED")
        .alias("status"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 1 HOUR")).alias("recorded_at"),
        F.inline(metric),
    )
    begun = (
        models.filter("kind = 'run'")
        .withColumn("status", F.lit("RUNNING"))
        .withColumn("recorded_at", F.col("start_time").cast("timestamp"))
    )
    facts = F.array(
        F.struct(
            F.lit("metric").alias("kind"),
            F.lit("operating_threshold").alias("key"),
            (F.abs(F.col("c_acctbal")) / F.lit(1e4)).cast("string").alias("value"),
        ),
        F.struct(
            F.lit("tag").alias("kind"),
            F.lit("selected_model").alias("key"),
            F.col("c_mktsegment").alias("value"),
        ),
    )
    held = (
        F.when(F.col("c_custkey") % 10 == 0, F.array(head))
        .when(F.col("c_custkey") % 10 == 1, F.array(head, F.get(facts, 1)))
        .otherwise(F.concat(F.array(head), facts))
    )
    sessions = customer.select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("run_id"),
        F.lit(None).cast("string").alias("parent_run_id"),
        F.col("c_name").alias("run_name"),
        F.lit("FINISHED").alias("status"),
        F.timestamp_seconds(F.lit(946684800) + F.col("c_custkey") * 60).alias("start_time"),
        F.timestamp_seconds(F.lit(946684800) + F.col("c_custkey") * 60).alias("recorded_at"),
        F.inline(held),
    )
    return models.unionByName(begun).unionByName(sessions)


def uploads_from_sessions(sessions: DataFrame, style: str) -> DataFrame:
    """The session table as somebody else's export: all text, plus one defect.

    ``style`` is one of exact, renamed, anonymous, recased, yes_no, decimal_codes,
    broken_numbers, padded.
    """
    names = list(SESSION.features)
    cells = {c: F.col(c).cast("string") for c in names}
    if style == "recased":
        cells["Month"] = F.lower(cells["Month"])
        cells["VisitorType"] = F.upper(cells["VisitorType"])
    elif style == "yes_no":
        cells["Weekend"] = F.when(F.col("Weekend"), "Yes").otherwise("No")
    elif style == "decimal_codes":
        for c in SESSION.coded_categorical:
            cells[c] = F.concat(cells[c], F.lit(".0"))
    elif style == "broken_numbers":
        bad = F.floor(F.col("row_id") / 200_000) % 50 == 3
        for c in SESSION.numeric + SESSION.coded_categorical:
            cells[c] = F.when(bad, "n/a").otherwise(cells[c])
    labels = {c: c for c in names}
    if style == "renamed":
        labels = {
            c: (c.upper() if i % 2 == 0 else c.lower()).replace("_", " ")
            for i, c in enumerate(names)
        }
    elif style == "anonymous":
        labels = {c: f"col_{i}" for i, c in enumerate(names)}
    out = [cells[c].alias(labels[c]) for c in names]
    if style == "padded":
        out = [
            F.col("row_id").cast("string").alias("session_id"),
            *out,
            F.lit("spring").alias("campaign"),
        ]
    else:
        out = [*out, F.col("row_id").cast("string").alias("session_id")]
    return sessions.select(*out)
