"""Near-duplicates among rows with null or repeated ids: one row of each group stays."""

import corpus_pipeline


def test_one_row_of_equal_texts_stays_whatever_the_ids(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    rows = [(None, one), (None, one), (7, one), (5, two), (5, two), (None, three), (None, three), (9, two), (5, one), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.minhash_dedup(spark, df, "")
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(5, one), (5, two), (None, three), (3, None), (4, "")], key=str)
