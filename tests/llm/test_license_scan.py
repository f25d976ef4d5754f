"""Licence notices against a plain version that looks at every offset."""

import random
import re
from collections import Counter

import pytest

from corpusflow.llm import license_scan as scan

MIT = scan.TEMPLATES[3].text
TEXTS = [
    None, "", " \n ", "Released under the MIT License. under the mit license", "# Licensed under the Apache License,\n# Version 2.0!",
    "CC-BY-NC 4.0, cc by nc; cc byé nc", "This work is licensed under the GNU General Public License, version 3.",
    "/* " + MIT.upper() + " */", "Copyright (c) 2020 Someone. " + MIT.replace("software and", "software, which is great in every way, and"),
    " ".join(MIT.split()[::-1]), "permission is hereby granted free of charge", "the version of the license " * 50,
    MIT + " " + MIT, "ſecond under the mıt license", "SPDX-License-Identifier: Apache-2.0", "x " * 100_000 + "cc by nc", "under the mit",
    "the gnu lesser general public license version 3 is licensed under", "Licensed under the GNU Lesser General Public License version 3",
]


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def runs(words, phrase):
    return [i for i in range(len(words) - len(phrase) + 1) if words[i : i + len(phrase)] == phrase]


def plain(texts):
    split = [words_of(t) for t in texts]
    known = {w for t in scan.TEMPLATES for w in t.text.split()}
    documents = Counter(w for words in split for w in known & set(words))
    rows = []
    for words in split:
        base = [(label, at) for phrase, label in scan.PHRASES.items() for at in runs(words, phrase.split())]
        notices = set()
        for number, template in enumerate(scan.TEMPLATES):
            wanted = template.text.split()
            phrases = [runs(words, p.split()) for p in template.phrases]
            if not all(phrases):
                continue
            keys = sorted(set(wanted) & set(words), key=lambda w: (documents[w], w.encode()))[: scan.KEYS]
            places = {w: [i for i, x in enumerate(words) if x == w] for w in keys}
            votes = Counter(p - t for t, w in enumerate(wanted) if w in places for p in places[w])
            candidates = [
                o for o, n in votes.items()
                if n >= scan.NEED and all(any(o - scan.DRIFT <= p < o + len(wanted) + scan.DRIFT for p in ps) for ps in phrases)
            ]
            for o in candidates:
                near = [c for c in candidates if o <= c <= o + scan.DRIFT]
                seen = [any(0 <= c + t < len(words) and words[c + t] == w for c in near) for t, w in enumerate(wanted)]
                if sum(seen) / len(wanted) >= scan.COVER:
                    notices.add((template.label, number, o, sum(seen) / len(wanted)))
        rows.append((len(words), sorted(base), sorted(notices)))
    return rows


def scanned(spark, texts):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, n_words string")
    rows = scan.scan_licenses(docs).orderBy("doc_id").collect()
    return [(r["n_words"], sorted(map(tuple, r["base"])), sorted(map(tuple, r["notices"]))) for r in rows]


def test_notices_and_base_phrases(spark):
    rng = random.Random(3)
    vocabulary = sorted({w for t in scan.TEMPLATES for w in t.text.split()})
    mixed = []
    for _ in range(150):
        notice = rng.choice(scan.TEMPLATES).text.split()
        for _ in range(rng.randrange(4)):
            notice.insert(rng.randrange(len(notice) + 1), rng.choice(vocabulary))
        del notice[rng.randrange(len(notice)) :][: rng.randrange(2)]
        mixed.append(" ".join(rng.choices(vocabulary, k=rng.randrange(30)) + notice + rng.choices(vocabulary, k=5)))
    texts = TEXTS + mixed + [TEXTS[3]] * 3
    found = scanned(spark, texts)
    assert found == plain(texts)
    labels = [{n[0] for n in notices} for _, _, notices in found]
    assert labels[6] == {"gpl-3"} and labels[7] == labels[8] == {"mit"} and labels[14] == {"apache-2"}
    assert not labels[9] and not labels[10] and not labels[11] and not labels[13]
    assert labels[18] == {"lgpl-3"}


def test_an_empty_table_and_own_templates(spark):
    assert scanned(spark, []) == []
    docs = spark.createDataFrame([("k", "Use it for good, not evil.")], "name string, text string")
    own = [scan.Template("json", "used for good not evil", ("for good not evil",))]
    row = scan.scan_licenses(docs, ["name"], own, {"not evil": "nice"}).first()
    assert row["base"][0]["start"] == 4 and row["notices"][0]["label"] == "json" and row["notices"][0]["coverage"] == 0.8


@pytest.mark.parametrize("name", ["op11_license_scan", "op13_merkle_manifest"])
def test_registered_queries_equal_their_sql(spark, name):
    from compare import differences, expected

    from corpusflow.llm.oracle import ORACLE
    from corpusflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    assert differences(QUERIES[name](spark, sf).toPandas(), expected(ORACLE[name], sf)) == []
