"""Queries that give one collection per key: it is whole, however its numbers spread over pieces."""

from pyspark.sql import functions as F

from tallyworks.operators.grouping import collect_by_range, whole_lists
from tallyworks.plans import catalog

QUERIES = catalog.queries()


def test_pieces_are_put_together(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("k"), (F.col("id") * 7 % 3000 - 1500).alias("v"))
    got = whole_lists(collect_by_range(rows, ["k"], "v", "vs", width=100), ["k"], "vs").collect()
    assert len(got) == 2 and all(r["piece"] == 0 and r["vs"] == sorted(r["vs"]) for r in got)
    assert sorted(v for r in got for v in r["vs"]) == list(range(-1500, 1500))
    assert {r["k"]: len(r["vs"]) for r in got} == {"hot": 2000, None: 1000}


def stored_events(spark, folder):
    """A user with items of several ranges, repeats and a null; one with a null alone."""
    rows = [("7", i, i) for i in (99, 3, 40, 3, None, 17)] + [("8", None, 1)]
    numbered = [(n, int(user), minute or 0, item) for n, (user, item, minute) in enumerate(rows)]
    events = spark.createDataFrame(numbered, "event_id LONG, user_id LONG, minute INT, item INT").select(
        "event_id",
        F.expr("timestamp_ntz '2024-01-01 06:00:00' + make_dt_interval(0, 0, minute, 0)").alias("ts"),
        "user_id",
        F.lit("view").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.to_json(F.struct(F.col("item").alias("k"))).alias("props"),
    )
    events.write.parquet(f"{folder}/events.parquet")


def test_user_item_sets(spark, tmp_path):
    stored_events(spark, tmp_path)
    got = QUERIES["user_item_sets"](spark, str(tmp_path)).collect()
    assert sorted((r["user_id"], r["piece"], r["items"]) for r in got) == [("7", 0, "3,17,40,99"), ("8", 0, None)]


def test_stream_item_window_at(spark, tmp_path):
    stored_events(spark, tmp_path)
    got = {r["user_id"]: (r["piece"], r["clicks"]) for r in QUERIES["stream_item_window_at"](spark, str(tmp_path)).collect()}
    assert len(got) == 2 and got["7"][0] == 0
    assert [c.split(":")[1] for c in got["7"][1].split(",") if ":" in c] == ["3", "17", "40", "99"]


def test_qa_answer_lists(spark, tmp_path):
    spark.createDataFrame([(1, "5-LOW"), (2, "5-LOW")], "o_orderkey LONG, o_orderpriority STRING").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(1, n, float(20 + n)) for n in range(1, 10)] + [(3, 1, 30.0)]
    spark.createDataFrame(lines, "l_orderkey LONG, l_linenumber INT, l_quantity DOUBLE").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = [tuple(r) for r in QUERIES["qa_answer_lists"](spark, str(tmp_path)).select("qid", "piece", "scores").collect()]
    assert got == [(1, 0, ",".join(sorted(str(n - 5) for n in range(1, 10))))]
