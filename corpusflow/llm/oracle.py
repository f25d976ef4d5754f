"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from corpusflow.llm import license_scan
from corpusflow.llm.merkle import FANOUT

# CRC-32 of the decimal form of a number, bit by bit.
_CRC_TABLE = (
    "crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)), "
    "lambda x, k: xor(x >> 1, (x & 1) * 3988292384))) AS crc_steps)"
)


def _crc(number: str) -> str:
    codes = f"list_transform(string_split({number}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), "
        "lambda x, b: xor(x >> 8, crc_steps[(xor(x, b) & 255) + 1])), 4294967295)"
    )


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return f"sha256({' || '.join(f'''coalesce(strlen({f}) || ':' || {f}, '-')''' for f in fields)})"


def _tree(name: str, leaves: str, last: int = 1) -> str:
    """All nodes `(tree, level, place, digest, n)` over `leaves(tree, place, digest)`; `n` nodes stand on the node's level."""
    return f"""{name}_nodes AS (
      SELECT tree, 0 AS level, place, digest FROM {leaves}
      UNION ALL
      SELECT tree, level + 1, place // {FANOUT}, sha256(string_agg(digest, '' ORDER BY place))
      FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}_nodes) WHERE n > 1
      GROUP BY tree, level, place // {FANOUT}),
    {name}_top AS (SELECT tree, arg_max(digest, level) AS digest, max(level) AS height FROM {name}_nodes GROUP BY tree)"""


_MERKLE = f"""WITH RECURSIVE {_CRC_TABLE},
    leaves AS (
      SELECT doc_id, source AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, {_leaf('text')} AS digest,
        CASE WHEN {_crc('doc_id')} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS shown
      FROM documents, crc_table),
    {_tree('low', 'leaves')},
    subroots AS (
      SELECT 0 AS tree, row_number() OVER (ORDER BY tree IS NOT NULL, encode(tree)) - 1 AS place, digest, tree AS source, height FROM low_top),
    {_tree('high', 'subroots')},
    steps AS (
      SELECT l.doc_id, n.level, n.place // {FANOUT} * {FANOUT} AS run, (l.place // pow({FANOUT}, n.level)::BIGINT) AS own, n.place, n.digest
      FROM leaves l JOIN low_top t ON l.tree IS NOT DISTINCT FROM t.tree
      JOIN low_nodes n ON n.tree IS NOT DISTINCT FROM l.tree AND n.level < t.height
        AND n.place // {FANOUT} = l.place // pow({FANOUT}, n.level + 1)::BIGINT
      UNION ALL
      SELECT l.doc_id, s.height + n.level, n.place // {FANOUT} * {FANOUT}, (s.place // pow({FANOUT}, n.level)::BIGINT), n.place, n.digest
      FROM leaves l JOIN subroots s ON l.tree IS NOT DISTINCT FROM s.source JOIN high_top t ON true
      JOIN high_nodes n ON n.level < t.height AND n.place // {FANOUT} = s.place // pow({FANOUT}, n.level + 1)::BIGINT),
    siblings AS (
      SELECT doc_id, level, coalesce(string_agg(digest, '' ORDER BY place) FILTER (place < own), '') AS lefts,
        coalesce(string_agg(digest, '' ORDER BY place) FILTER (place > own), '') AS rights
      FROM steps GROUP BY doc_id, level),
    proofs AS (SELECT doc_id, sha256(string_agg(lefts || rights, '' ORDER BY level)) AS proof FROM siblings GROUP BY doc_id),
    folds AS (
      SELECT doc_id, 0::BIGINT AS level, shown AS digest FROM leaves
      UNION ALL
      SELECT f.doc_id, f.level + 1, sha256(s.lefts || f.digest || s.rights) FROM folds f JOIN siblings s USING (doc_id, level)),
    folded AS (SELECT doc_id, arg_max(digest, level) AS digest FROM folds GROUP BY doc_id)
  SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, t.digest AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
    f.digest AS folded_root, f.digest = t.digest AS verified
  FROM leaves l JOIN subroots s ON l.tree IS NOT DISTINCT FROM s.source JOIN high_top t ON true
  LEFT JOIN proofs p ON p.doc_id = l.doc_id JOIN folded f ON f.doc_id = l.doc_id"""


def _words(text: str) -> str:
    """Rows `(place, word)` of a text literal."""
    return f"(SELECT generate_subscripts(w, 1) - 1 AS t, unnest(w) AS word FROM (SELECT string_split('{text}', ' ') AS w))"


def _licenses() -> str:
    templates = " UNION ALL ".join(
        f"SELECT {i} AS template, '{t.label}' AS label, t, word FROM {_words(t.text)}" for i, t in enumerate(license_scan.TEMPLATES))
    phrases = " UNION ALL ".join(
        f"SELECT {i} AS template, {k} AS phrase, t, word FROM {_words(p)}"
        for i, t in enumerate(license_scan.TEMPLATES) for k, p in enumerate(t.phrases))
    base = " UNION ALL ".join(
        f"SELECT {i} AS phrase, '{label}' AS label, t, word FROM {_words(p)}" for i, (p, label) in enumerate(license_scan.PHRASES.items()))
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    drift = license_scan.DRIFT
    return f"""WITH split AS (SELECT doc_id, {split} AS w FROM documents),
    words AS (SELECT doc_id, generate_subscripts(w, 1) - 1 AS p, unnest(w) AS word FROM split),
    base AS ({base}), templates AS ({templates}), phrases AS ({phrases}),
    base_places AS (
      SELECT doc_id, phrase, label, p - t AS start FROM words JOIN base USING (word)
      JOIN (SELECT phrase, count(*) AS size FROM base GROUP BY phrase) USING (phrase)
      GROUP BY doc_id, phrase, label, p - t, size HAVING count(*) = size),
    base_found AS (
      SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list(DISTINCT label) AS labels
      FROM base_places GROUP BY doc_id),
    present AS (SELECT DISTINCT doc_id, word FROM words WHERE word IN (SELECT word FROM templates)),
    frequency AS (SELECT word, count(*) AS documents FROM present GROUP BY word),
    keys AS (
      SELECT doc_id, template, word FROM present JOIN frequency USING (word) JOIN (SELECT DISTINCT template, word FROM templates) USING (word)
      QUALIFY row_number() OVER (PARTITION BY doc_id, template ORDER BY documents, encode(word)) <= {license_scan.KEYS}),
    sizes AS (SELECT template, any_value(label) AS label, count(*) AS size FROM templates GROUP BY template),
    voted AS (
      SELECT doc_id, template, p - t AS start FROM keys JOIN templates USING (template, word) JOIN words USING (doc_id, word)
      GROUP BY doc_id, template, p - t HAVING count(*) >= {license_scan.NEED}),
    phrase_places AS (
      SELECT doc_id, template, phrase, p - t AS place FROM words JOIN phrases USING (word)
      JOIN (SELECT template, phrase, count(*) AS size FROM phrases GROUP BY template, phrase) USING (template, phrase)
      GROUP BY doc_id, template, phrase, p - t, size HAVING count(*) = size),
    candidates AS (
      SELECT v.doc_id, v.template, v.start FROM voted v JOIN sizes z USING (template)
      JOIN phrase_places f ON f.doc_id = v.doc_id AND f.template = v.template AND f.place >= v.start - {drift} AND f.place < v.start + z.size + {drift}
      JOIN (SELECT template, count(DISTINCT phrase) AS needed FROM phrases GROUP BY template) USING (template)
      GROUP BY v.doc_id, v.template, v.start, needed HAVING count(DISTINCT f.phrase) = needed),
    same AS (
      SELECT c.doc_id, c.template, c.start, m.t FROM candidates c JOIN templates m USING (template)
      JOIN words w ON w.doc_id = c.doc_id AND w.p = c.start + m.t AND w.word = m.word),
    notices AS (
      SELECT c.doc_id, c.template, c.start, any_value(z.label) AS label, count(DISTINCT s.t) / any_value(z.size)::DOUBLE AS coverage
      FROM candidates c JOIN sizes z USING (template)
      JOIN same s ON s.doc_id = c.doc_id AND s.template = c.template AND s.start BETWEEN c.start AND c.start + {drift}
      GROUP BY c.doc_id, c.template, c.start HAVING coverage >= {license_scan.COVER}),
    found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(coverage) AS score FROM notices GROUP BY doc_id)
  SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, f.labels))), ','), '') AS labels,
    CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END AS score
  FROM split LEFT JOIN base_found b USING (doc_id) LEFT JOIN found f USING (doc_id)"""


ORACLE: dict[str, str] = {"op11_license_scan": _licenses(), "op13_merkle_manifest": _MERKLE}
