"""Texts that share nothing with an item stay out of the shuffle, whatever the size of the table."""

from corpusflow.llm import decontamination


def test_rows_without_shared_shingles_are_not_shuffled(spark):
    item = " ".join(f"w{i}" for i in range(30))
    rows = [(i, f"nothing shared here {i} " * 5) for i in range(200)] + [(500, f"before {item} after"), (None, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        leaks = decontamination.find_leaks(docs, benchmark)
        plan = leaks._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [pmod(" in plan and "LeftSemi" in plan
        assert sorted((str(r["doc_id"]), r["start_word"], r["similarity"]) for r in leaks.collect()) == [("500", 1, 1.0), ("None", 0, 1.0)]
        assert decontamination.drop_leaks(docs, benchmark).count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
