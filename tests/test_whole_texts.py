"""The training inputs over whole texts: nothing is cut at 64 tokens."""

from compare import differences, expected

import __spark_entry__ as entry
from corpusflow.functions.sequences import MASK, PAD

SF = "/root/testdata/sf0.001"


def collected(spark, name):
    return {r.doc_id: r for r in entry.queries()[name](spark, SF).collect()}


def ids(text):
    return [int(x) for x in text.split()]


def test_inputs_are_the_whole_encoded_texts(spark):
    inputs = entry.queries()["prepare_inputs_whole"](spark, SF).toPandas()
    assert differences(inputs, expected(entry.oracle_sql()["encode_batches"], SF)) == []
    whole = {doc: ids(text) for doc, text in zip(inputs.doc_id, inputs.input_ids)}
    causal, masked = collected(spark, "causal_lm_inputs_whole"), collected(spark, "masked_lm_inputs_whole")
    assert set(causal) == set(masked) == set(whole) and max(map(len, whole.values())) > 10_000
    for doc, wanted in whole.items():
        assert ids(causal[doc].input_ids) == wanted and ids(causal[doc].labels) == [*wanted[1:], PAD]
        assert ids(masked[doc].labels) == wanted
    seen = [ids(r.input_ids) for r in masked.values()]
    assert any(MASK in x[64:] for x in seen)
    assert entry.queries()["masked_token_count_whole"](spark, SF).first()[0] == sum(x.count(MASK) for x in seen)
    audit = entry.queries()["example_audit_whole"](spark, SF).first()
    assert (audit.n_rows, audit.with_mask) == (len(seen), sum(MASK in x for x in seen))
    assert audit.of_length == audit.labels_fit == len(seen)
