"""The Merkle manifest against a plain version, its store, and the registered query's SQL."""

import hashlib

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import merkle

COLUMNS = "doc_id bigint, source string, lang string, n_chars bigint, text string, rank string, digest string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, place):
    out = []
    for level in tree[:-1]:
        run = place - place % 3
        out.append((level[run:place], level[place + 1 : run + 3]))
        place //= 3
    return out


def plain(rows, altered):
    trees, found = {}, []
    for row in rows:
        trees.setdefault(row["source"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, row["text"]), row))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(trees[s], key=lambda x: x[:3]) for s in names}
    stages = {s: levels([x[2] for x in trees[s]]) for s in names}
    top = levels([stages[s][-1][0] for s in names])
    for number, source in enumerate(names):
        for place, (_, _, own, row) in enumerate(trees[source]):
            path = siblings(stages[source], place) + siblings(top, number)
            text = row["text"].replace("\n", "") if row["text"] is not None and altered(row) else row["text"]
            folded = leaf(row, text)
            for left, right in path:
                folded = sha(*left, folded, *right)
            root = top[-1][0]
            found.append((row["doc_id"], own, stages[source][-1][0], root, sha(*(d for a, b in path for d in a + b)), folded, folded == root))
    return sorted(found, key=repr)


def report(spark, rows, schema=COLUMNS):
    docs = spark.createDataFrame(rows, schema)
    found = merkle.manifest_report(docs, F.col("doc_id") % 2 == 0).collect()
    return sorted(map(tuple, found), key=repr), docs.collect()


def test_a_hot_source_nulls_and_repeated_rows(spark):
    rows = [(i, "hot", "en", i, f"line {i}\nend é", "clash", "clash") for i in range(800)]
    rows += [(i, f"s{i % 7}", None, None, None if i % 3 else "a\nb", None, None) for i in range(40)]
    rows += [(5, "hot", "en", 5, "line 5\nend é", "x", "y")] * 3 + [(None, None, None, None, None, None, None)] * 2
    rows += [(None, "hot", "é", 1, "", "", ""), (1, "", "", 0, "", "", ""), (2, "one", "x", 1, "x" * 200_000 + "\n", "", "")]
    found, docs = report(spark, rows)
    assert found == plain(docs, lambda r: r["doc_id"] is not None and r["doc_id"] % 2 == 0)
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("n", [1, 4, merkle.BLOCK, merkle.BLOCK + 1])
def test_one_source_of_every_shape(spark, n):
    found, docs = report(spark, [(i, "s", "en", 1, f"t{i}\n", None, None) for i in range(n)])
    assert found == plain(docs, lambda r: r["doc_id"] % 2 == 0)


def test_an_empty_table(spark):
    assert report(spark, [])[0] == []


def test_requests_for_some_leaves_and_for_none_that_exist(spark):
    rows = [(f"s{i % 3}" if i % 3 else None, i // 3, sha(str(i))) for i in range(900)]
    leaves = spark.createDataFrame(rows, "tree string, rank bigint, leaf string")
    manifest = merkle.build(leaves)
    asked = spark.createDataFrame([("s1", 0), (None, 299), ("s2", 17), ("s2", 300), ("none", 0)], "tree string, rank bigint")
    proofs = merkle.prove(manifest, asked).collect()
    assert sorted(((r["tree"], r["rank"]) for r in proofs), key=repr) == sorted([("s1", 0), (None, 299), ("s2", 17)], key=repr)
    known = {(t, k): d for t, k, d in rows}
    for proof in proofs:
        digest = known[proof["tree"], proof["rank"]]
        for step in reversed(proof["path"]):
            digest = sha(step["left"], digest, step["right"])
        assert digest == manifest.root == proof["root"]


def test_the_store_names_children_by_digest(spark):
    leaves = [sha(str(i)) for i in range(300)]
    frame = spark.createDataFrame([("s", i, d) for i, d in enumerate(leaves)], "tree string, rank bigint, leaf string")
    manifest = merkle.build(frame)
    store = {r["digest"]: r["children"] for r in merkle.children(manifest).collect()}
    assert all(sha(*below) == above for above, below in store.items())
    reached = [manifest.root]
    while any(d in store for d in reached):
        reached = [c for d in reached for c in store.get(d, [d])]
    assert reached == leaves
