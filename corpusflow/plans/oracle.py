"""ANSI SQL with the same results as `corpusflow.plans.queries`, for another engine to check them.

Merges are trained by SQL as well, for a small vocabulary; larger ones are tested
against a public tokenizer package.
"""

from __future__ import annotations

from corpusflow.functions.permutation import FIRST, MASK, ROUNDS, SECOND
from corpusflow.functions.text import STRIP_CODES

_STRIP = "[" + "".join(rf"\x{{{code:x}}}" for code in STRIP_CODES) + "]"
# Fixed value: characters with the White_Space property.
_SPACE = r"\t-\r \x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _SPACE + r"\p{L}\p{N}]+|[" + _SPACE + r"]+"
).replace("'", "''")


def _cleaned(text: str = "text") -> str:
    strip = f"regexp_replace(regexp_replace(l, '^{_STRIP}+', ''), '{_STRIP}+$', '')"
    lines = f"list_transform(string_split({text}, chr(10)), lambda l: {strip})"
    return f"replace(array_to_string(list_filter({lines}, lambda l: l <> ''), ' '), '  ', ' ')"


def _byte_id(code: str) -> str:
    return (
        f"CASE WHEN {code} BETWEEN 33 AND 126 THEN {code} - 29 WHEN {code} BETWEEN 161 AND 172 THEN {code} - 63 "
        f"WHEN {code} >= 174 THEN {code} - 64 WHEN {code} <= 32 THEN {code} + 192 "
        f"WHEN {code} = 173 THEN 259 ELSE {code} + 98 END"
    )


# The byte code of the id `i` of the alphabet, the other way round.
_BYTE_OF = (
    "CASE WHEN i BETWEEN 4 AND 97 THEN i + 29 WHEN i BETWEEN 98 AND 109 THEN i + 63 WHEN i BETWEEN 110 AND 191 THEN i + 64 "
    "WHEN i BETWEEN 192 AND 224 THEN i - 192 WHEN i = 259 THEN 173 ELSE i - 98 END"
)


def _bare(text: str) -> str:
    return f"replace(lower({text}), ' ', '')"


def _aligned(labels: str) -> str:
    return f"coalesce(bool_and(string_split(input_ids, ' ')[2:] = string_split({labels}, ' ')[:127]), true)"


def _byte_ids(text: str) -> str:
    return (
        f"list_transform(regexp_extract_all(hex(encode({text})), '..'), "
        f"lambda h: ({_byte_id('''('0x' || h)::INTEGER''')})::INTEGER)"
    )


def _joined(ids: str) -> str:
    return f"array_to_string(({ids})::VARCHAR[], ' ')"


def _uniform(digest: str, slot: int = 0) -> str:
    return f"(('0x' || substr({digest}, {slot * 8 + 1}, 8))::UBIGINT / 4294967296::DOUBLE)"


CLEANED = f"cleaned AS (SELECT doc_id, {_cleaned()} AS text FROM documents)"
CLEANED_CONVERSATIONS = f"conv AS (SELECT conv_id, turn, {_cleaned()} AS text FROM conversations)"
WORDS = f"{CLEANED}, words AS (SELECT word, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(text, '{_WORDS}')) AS word FROM cleaned) GROUP BY word)"
ENCODED = f"encoded AS (SELECT doc_id, text, {_byte_ids('text')} AS ids, list_concat([0], {_byte_ids('text')}, [1]) AS input_ids FROM documents)"
STREAM = (
    f"{ENCODED}, tokens AS (SELECT doc_id, unnest(input_ids) AS token_id, generate_subscripts(input_ids, 1) AS i FROM encoded), "
    "stream AS (SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS pos, doc_id, token_id FROM tokens)"
)
PAIRS = (
    f"{WORDS}, symbols AS (SELECT cnt, {_byte_ids('word')} AS ids FROM words), "
    "pairs AS (SELECT ids[i] AS \"left\", ids[i + 1] AS \"right\", sum(cnt)::BIGINT AS cnt FROM "
    "(SELECT ids, cnt, unnest(range(1, len(ids))) AS i FROM symbols) GROUP BY ALL)"
)
SCORED = (
    "scored AS (SELECT vec_id, embedding, (CASE WHEN label = 9 THEN -100 ELSE label END)::INTEGER AS label, "
    "vec_id // 16 AS batch_id, vec_id // 10 AS prompt_id FROM embeddings), "
    "entries AS (SELECT vec_id, label, batch_id, prompt_id, unnest(embedding) AS logit, "
    "generate_subscripts(embedding, 1) - 1 AS idx FROM scored), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY logit DESC, idx) AS place FROM entries), "
    "losses AS (SELECT vec_id, batch_id, prompt_id, m + ln(total) - own AS nll FROM (SELECT vec_id, batch_id, "
    "prompt_id, any_value(m) AS m, sum(exp(logit::DOUBLE - m)) AS total, max(CASE WHEN idx = label THEN logit::DOUBLE END) AS own "
    "FROM (SELECT *, (max(logit) OVER (PARTITION BY vec_id))::DOUBLE AS m FROM entries WHERE label <> -100) "
    "GROUP BY vec_id, batch_id, prompt_id))"
)
LOG = "log AS (SELECT event_type AS name, ts, event_id, value FROM events)"
LOSSES = "losses AS (SELECT user_id AS run_id, ts, event_id AS step, value FROM events)"
CATALOG = (
    "catalog AS (SELECT user_id AS run_id, event_id AS step, "
    "'run-' || user_id || '/checkpoint-' || event_id || '.pt' AS path, value AS val_loss FROM events)"
)
STEPS = (
    "steps AS (SELECT l_returnflag AS run_id, l_quantity::BIGINT AS tokens, l_tax + 0.01::DOUBLE AS seconds, "
    "l_extendedprice AS mem_mb FROM lineitem)"
)
GENERATED = (
    "generated AS (SELECT conv_id, turn, len(t)::INTEGER AS n_tokens, length(text)::INTEGER AS n_chars, "
    "CASE WHEN len(t) > 0 THEN list_unique(t) / len(t)::DOUBLE END AS diversity FROM (SELECT *, "
    "list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '') AS t FROM conversations WHERE role = 'assistant'))"
)


def _split(documents: str, validation: str | None) -> str:
    """Rows `(split, sample_no, text)` from kept rows `(sample_no, text)`."""
    val_rows = "0" if validation is None else f"(SELECT count(*) FROM {validation})"
    sizes = (
        f"counts AS (SELECT n, v, CASE WHEN v > 100 THEN e ELSE e - floor(e * 0.05::DOUBLE) END AS train_end, e, "
        f"CASE WHEN v > 100 THEN v - floor(v * 0.5::DOUBLE) ELSE v END AS val_end FROM (SELECT n, "
        + ("floor(n * 0.05::DOUBLE) AS v, n - floor(n * 0.05::DOUBLE) AS e" if validation is None else f"{val_rows} AS v, n AS e")
        + f" FROM (SELECT count(*) AS n FROM {documents})))"
    )
    from_train = (
        "SELECT CASE WHEN sample_no < train_end THEN 'train' WHEN sample_no < e THEN 'test' "
        "WHEN sample_no < e + val_end THEN 'validation' ELSE 'test' END AS split, sample_no, text "
        f"FROM {documents}, counts"
    )
    parts = from_train
    if validation is not None:
        parts += (
            " UNION ALL SELECT CASE WHEN sample_no < val_end THEN 'validation' ELSE 'test' END, sample_no, text "
            f"FROM {validation}, counts"
        )
    return f"{sizes}, splits AS ({parts})"


KEPT = (
    f"{CLEANED}, kept AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS sample_no, text FROM "
    "cleaned WHERE length(text) BETWEEN 150 AND 500)"
)
KEPT_VALIDATION = (
    f"{CLEANED_CONVERSATIONS}, held AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS sample_no, text FROM "
    "conv WHERE length(text) BETWEEN 150 AND 500)"
)
WITH_VALIDATION = f"{KEPT}, {KEPT_VALIDATION}, {_split('kept', 'held')}"
ALL_SAMPLES = (
    f"{CLEANED}, samples AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS sample_no, text FROM cleaned "
    f"WHERE length(text) >= 1), {_split('samples', None)}"
)


def _stops(order: str, losses: str = "losses") -> str:
    run = f"PARTITION BY run_id ORDER BY {order}"
    return (
        f"marked AS (SELECT *, row_number() OVER ({run}) - 1 AS n, "
        f"min(value) OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS least FROM {losses}), "
        f"counted AS (SELECT *, n - max(CASE WHEN least IS NULL OR value <= least THEN n END) OVER ({run}) AS counter FROM marked), "
        f"stops AS (SELECT *, max(counter) OVER ({run}) >= 5 AS early_stop FROM counted)"
    )


def _stops_with_delta(delta: str, patience: int, order: str = "step", run: str = "run_id", losses: str = LOSSES) -> str:
    """A fold over the losses of each run in order; -loss is the score to beat."""
    worse = f"-m.value < f.best + {delta}::DOUBLE"
    return (
        f"RECURSIVE {losses}, numbered AS (SELECT {run}, step, value, row_number() OVER (PARTITION BY {run} ORDER BY {order}) AS n FROM losses), "
        f"fold AS (SELECT {run}, n, step, -value AS best, 0 AS counter, false AS stop FROM numbered WHERE n = 1 UNION ALL "
        f"SELECT f.{run}, m.n, m.step, CASE WHEN {worse} THEN f.best ELSE -m.value END, "
        f"CASE WHEN {worse} THEN f.counter + 1 ELSE 0 END, f.stop OR ({worse} AND f.counter + 1 >= {patience}) "
        f"FROM fold f JOIN numbered m ON m.{run} = f.{run} AND m.n = f.n + 1)"
    )


STOPS_WITH_DELTA = _stops_with_delta("0.25", 5)
LONG_LOSSES = "losses AS (SELECT event_type AS name, ts, event_id AS step, value - event_id * 0.01::DOUBLE AS value FROM events)"
def _permuted(index: str, n: str, seed: int, epoch: int) -> str:
    """Place of an index in a keyed order: rounds that swap x with (turn - x) mod n by a bit of the larger."""
    keys = f"list_transform(range({ROUNDS}), lambda r: md5('{seed}|{epoch}|' || r))"
    steps = (
        f"list_transform({keys}, lambda h: {{'turn': ('0x' || substr(h, 1, 15))::BIGINT % {n}, "
        f"'key': ('0x' || substr(h, 16, 8))::BIGINT & {MASK}, 'x': 0::BIGINT}})"
    )
    other = f"(((k.turn - s.x) % {n} + {n}) % {n})"
    folded = f"xor(xor(greatest(s.x, {other}) & {MASK}, greatest(s.x, {other}) >> 31), k.key)"
    one = f"(({folded} * {FIRST}) & {MASK})"
    two = f"((xor({one}, {one} >> 15) * {SECOND}) & {MASK})"
    start = f"{{'turn': 0::BIGINT, 'key': 0::BIGINT, 'x': ({index})::BIGINT}}"
    step = f"{{'turn': 0::BIGINT, 'key': 0::BIGINT, 'x': CASE WHEN ({two} >> 17) & 1 = 1 THEN {other} ELSE s.x END}}"
    return f"struct_extract(list_reduce(list_prepend({start}, {steps}), lambda s, k: {step}), 'x')"


# Symbols of a word stand between bars, |1||2|, so that replacing a pair leaves its neighbours' bars alone.
TRAINED = (
    "RECURSIVE words AS (SELECT word, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(line || chr(10), '" + _WORDS + "')) AS word "
    "FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY word), "
    f"coded AS (SELECT word, cnt, {_byte_ids('word')} AS ids FROM words), "
    "trained AS (SELECT 0 AS step, -1 AS l, -1 AS r, word, cnt, '|' || array_to_string(ids::VARCHAR[], '||') || '|' AS syms FROM coded WHERE len(ids) > 1 "
    "UNION ALL SELECT t.step + 1, m.l, m.r, t.word, t.cnt, replace(t.syms, '|' || m.l || '||' || m.r || '|', '|' || (260 + t.step) || '|') "
    "FROM trained t JOIN (SELECT ids[i]::INTEGER AS l, ids[i + 1]::INTEGER AS r FROM (SELECT cnt, ids, unnest(range(1, len(ids))) AS i "
    "FROM (SELECT cnt, string_split(trim(syms, '|'), '||') AS ids FROM trained)) GROUP BY l, r ORDER BY sum(cnt) DESC, l, r LIMIT 1) m ON true "
    "WHERE t.step < 40)"
)
WINDOWS = (
    f"{STREAM}, shifted AS (SELECT pos, token_id, lead(token_id) OVER (ORDER BY pos) AS next_id, max(pos) OVER () AS last FROM stream), "
    "windows AS (SELECT pos // 128 * 128 AS window_start, string_agg(token_id::VARCHAR, ' ' ORDER BY pos) AS input_ids, "
    "string_agg(next_id::VARCHAR, ' ' ORDER BY pos) AS labels FROM shifted WHERE pos // 128 * 128 + 128 <= last GROUP BY pos // 128)"
)
FITTED = (  # inputs as long as the longest of their batch
    f"{ENCODED}, sized AS (SELECT doc_id, input_ids, len(input_ids) AS n, max(len(input_ids)) OVER (PARTITION BY doc_id // 16) AS longest FROM encoded), "
    "fitted AS (SELECT doc_id, list_concat(input_ids, list_transform(range(n, longest), lambda i: 3)) AS input_ids, n, longest FROM sized)"
)
_FIT_MASKS = (
    "array_to_string(list_transform(range(0, longest), lambda i: CASE WHEN i < n THEN '1' ELSE '0' END), ' ') AS attention_mask, "
    "array_to_string(list_transform(range(0, longest), lambda i: '0'), ' ') AS token_type_ids"
)
MASKED = (
    f"{FITTED}, drawn AS (SELECT doc_id, i, input_ids[i] AS token, md5('3|' || doc_id || '|' || (i - 1)) AS code FROM "
    "(SELECT doc_id, input_ids, unnest(range(1, longest + 1)) AS i FROM fitted)), "
    f"changed AS (SELECT doc_id, i, CASE WHEN token IN (0, 1, 3) OR {_uniform('code', 0)} >= 0.15::DOUBLE THEN token "
    f"WHEN {_uniform('code', 1)} < 0.8::DOUBLE THEN 2 WHEN {_uniform('code', 2)} < 0.5::DOUBLE "
    f"THEN floor({_uniform('code', 3)} * 260)::INTEGER ELSE token END AS id FROM drawn), "
    "masked AS (SELECT doc_id, list(id ORDER BY i) AS input_ids FROM changed GROUP BY doc_id)"
)


def _sampling(temperature: str, top_k: int, top_p: str) -> str:
    """Entries that survive temperature, top-k and top-p, as `nucleus (vec_id, idx, p, place)`."""
    return (
        f"{SCORED}, scaled AS (SELECT vec_id, idx, place, logit::DOUBLE / {temperature}::DOUBLE AS x FROM ranked), "
        f"top AS (SELECT * FROM (SELECT *, max(CASE WHEN place = {top_k} THEN x END) OVER (PARTITION BY vec_id) AS kth, "
        "max(x) OVER (PARTITION BY vec_id) AS m FROM scaled) WHERE x >= kth), "
        "soft AS (SELECT vec_id, idx, place, exp(x - m) / sum(exp(x - m)) OVER (PARTITION BY vec_id) AS p FROM top), "
        "mass AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY vec_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM soft), "
        f"nucleus AS (SELECT vec_id, idx, place, p / sum(p) OVER (PARTITION BY vec_id) AS p FROM mass WHERE before <= {top_p}::DOUBLE)"
    )


def _histogram(measure: str, source: str, column: str, width: str) -> str:
    return (
        f"SELECT floor({column} / {width}::DOUBLE)::BIGINT AS bucket, count(*) AS n, '{measure}' AS measure "
        f"FROM {source} WHERE {column} IS NOT NULL GROUP BY ALL"
    )


ORACLE: dict[str, str] = {
    # sources and sinks
    "load_corpus": "SELECT 'train' AS split, text FROM documents UNION ALL SELECT 'validation', text FROM conversations",
    "jsonl_round_trip": "SELECT text FROM documents",
    "jsonl_lenient_round_trip": "SELECT text FROM documents WHERE text <> ''",
    "jsonl_lenient_without_text": "SELECT text FROM conversations WHERE role = 'assistant' AND text <> ''",
    "read_training_files": f"WITH {CLEANED} SELECT text FROM cleaned WHERE text <> ''",
    "resolve_text_column": "SELECT CASE doc_id % 4 WHEN 1 THEN 'story' WHEN 3 THEN 'body' ELSE 'text' END AS field, text FROM documents",
    "paragraph_text_round_trip": f"WITH {CLEANED} SELECT text FROM cleaned WHERE text <> ''",
    "read_prompts": f"WITH {CLEANED_CONVERSATIONS} SELECT text AS prompt FROM conv WHERE text <> ''",
    "small_bundle": f"WITH {ALL_SAMPLES} SELECT split, text FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY sample_no) AS n FROM splits) WHERE n <= CASE split WHEN 'train' THEN 1000 ELSE 100 END",
    "tokenizer_corpus": f"WITH {CLEANED}, {CLEANED_CONVERSATIONS} SELECT text FROM (SELECT 0 AS f, doc_id AS a, 0 AS b, text FROM cleaned UNION ALL SELECT 1, conv_id, turn, text FROM conv) WHERE text <> ''",
    "run_catalog_round_trip": f"WITH {CATALOG}, kept AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS n FROM catalog), lists AS (SELECT run_id, string_agg(path, ' ' ORDER BY step) AS checkpoints FROM kept WHERE n <= 5 GROUP BY run_id) SELECT run_id, checkpoints, best_checkpoint, best_metric, last_checkpoint FROM lists JOIN (SELECT run_id, arg_min(path, (val_loss, step)) AS best_checkpoint, min(val_loss) AS best_metric, arg_max(path, step) AS last_checkpoint FROM catalog GROUP BY run_id) USING (run_id)",
    "eval_results_round_trip": f"WITH {SCORED} SELECT prompt_id, round(exp(avg(nll)), 4) AS perplexity FROM losses GROUP BY prompt_id",
    # projections and filters
    "clean_text": f"WITH {CLEANED} SELECT doc_id, text FROM cleaned",
    "filter_length": f"WITH {CLEANED} SELECT doc_id, text FROM cleaned WHERE length(text) BETWEEN 150 AND 500",
    "scan_cap": "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 500",
    "extract_samples": f"WITH {CLEANED} SELECT * FROM (SELECT doc_id, text FROM cleaned ORDER BY doc_id LIMIT 800) WHERE length(text) BETWEEN 150 AND 500",
    "non_empty": f"WITH {CLEANED} SELECT doc_id, text FROM cleaned WHERE text <> ''",
    "is_special": f"WITH {STREAM} SELECT doc_id, token_id IN (0, 1, 3) AS special, count(*) AS n FROM stream GROUP BY ALL",
    "valid_labels": f"WITH {SCORED} SELECT vec_id, label FROM scored WHERE label <> -100",
    "cadence_filter": "SELECT user_id AS run_id, event_id AS step FROM events WHERE event_id % 100 = 0",
    # lookups
    "token_to_id": f"WITH {CLEANED}, chars AS (SELECT unnest(string_split(text, '')) AS token FROM cleaned) SELECT token, count(*) AS n, coalesce(CASE WHEN unicode(token) BETWEEN 33 AND 126 THEN unicode(token) - 29 WHEN unicode(token) BETWEEN 161 AND 172 THEN unicode(token) - 63 WHEN unicode(token) BETWEEN 174 AND 323 THEN unicode(token) - 64 END, -1)::INTEGER AS id FROM chars WHERE token <> '' GROUP BY token",
    "id_to_token": f"WITH {ENCODED}, counted AS (SELECT unnest(ids) AS id FROM encoded) SELECT id, chr((id + CASE WHEN id < 98 THEN 29 WHEN id < 110 THEN 63 ELSE 64 END)::INTEGER) AS token, count(*) AS n FROM counted GROUP BY id",
    "encode_words": f"WITH {WORDS} SELECT word, cnt, {_joined(_byte_ids('word'))} AS ids FROM words",
    "special_token_filter": f"WITH {STREAM} SELECT doc_id, count(*) AS n, sum(token_id)::BIGINT AS id_sum FROM stream WHERE token_id > 3 GROUP BY doc_id",
    # aggregations
    "pretoken_counts": f"WITH {WORDS} SELECT word, cnt FROM words",
    "pair_counts": f'WITH {PAIRS} SELECT "left", "right", cnt FROM pairs',
    "most_frequent_pair": f'WITH {PAIRS} SELECT "left", "right", cnt FROM pairs ORDER BY cnt DESC, "left", "right" LIMIT 10',
    "train_bpe_ids": f"WITH {TRAINED} SELECT DISTINCT (step - 1)::INTEGER AS rank, l AS left_id, r AS right_id, (259 + step)::INTEGER AS merged_id FROM trained WHERE step > 0",
    "split_counts": f"WITH {KEPT}, {_split('kept', None)} SELECT split, count(*) AS samples FROM splits GROUP BY split",
    "batch_max_length": f"WITH {ENCODED} SELECT doc_id, doc_id // 16 AS batch_id, (max(len(ids)) OVER (PARTITION BY doc_id // 16))::INTEGER AS batch_length FROM encoded",
    "metric_average": f"WITH {LOG} SELECT round(avg(value), 6) AS average FROM log WHERE name = 'purchase'",
    "metric_averages": f"WITH {LOG} SELECT name, round(avg(value), 6) AS average FROM log GROUP BY name",
    "metric_latest": f"WITH {LOG} SELECT arg_max(value, (ts, event_id)) AS latest FROM log WHERE name = 'error'",
    "metric_current": f"WITH {LOG} SELECT name, arg_max(value, (ts, event_id)) AS latest FROM log GROUP BY name",
    "metric_current_wide": f"WITH {LOG} SELECT "
    + ", ".join(f"arg_max(value, (ts, event_id)) FILTER (WHERE name = '{n}') AS \"{n}\"" for n in ("click", "error", "purchase", "signup", "view"))
    + " FROM log",
    "accuracy": f"WITH {SCORED} SELECT round(avg(CASE WHEN idx = label THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM ranked WHERE place = 1 AND label <> -100",
    "top5_accuracy": f"WITH {SCORED}, own AS (SELECT place FROM ranked WHERE label <> -100 AND idx = label) SELECT round(avg((place = 1)::INTEGER), 6) AS accuracy, round(avg((place <= 5)::INTEGER), 6) AS top5_accuracy FROM own",
    "cross_entropy": f"WITH {SCORED} SELECT round(avg(nll), 6) AS loss FROM losses",
    "validation_loss": f"WITH {SCORED}, batches AS (SELECT avg(nll) AS loss FROM losses GROUP BY batch_id) SELECT round(avg(loss), 6) AS loss, round(exp(avg(loss)), 4) AS perplexity FROM batches",
    "validation_loss_token_weighted": f"WITH {SCORED} SELECT round(avg(nll), 6) AS loss, round(exp(avg(nll)), 4) AS perplexity FROM losses",
    "epoch_loss": "SELECT user_id AS epoch, round(avg(value), 6) AS epoch_loss FROM events GROUP BY user_id",
    "perplexity": f"WITH {SCORED} SELECT batch_id, round(avg(nll), 6) AS loss, round(exp(avg(nll)), 4) AS perplexity FROM losses GROUP BY batch_id",
    "throughput_summary": f"WITH {STEPS} SELECT run_id, sum(tokens)::BIGINT AS total_tokens, round(sum(seconds), 4) AS total_time, round(sum(tokens) / sum(seconds), 4) AS tokens_per_sec, max(mem_mb) AS max_memory_mb FROM steps GROUP BY run_id",
    "step_throughput": f"WITH {STEPS} SELECT run_id, tokens, round(tokens / seconds, 4) AS tokens_per_sec FROM steps",
    "epoch_estimate": f"WITH {STEPS}, {ENCODED}, loader AS (SELECT 16 * 128 * (greatest((n - 129) // 128 + 1, 0) // 16) AS tokens FROM (SELECT sum(len(input_ids))::BIGINT AS n FROM encoded)) SELECT run_id, any_value(loader.tokens)::BIGINT AS tokens_per_epoch, round(any_value(loader.tokens) / (sum(steps.tokens) / sum(seconds)), 4) AS seconds_per_epoch FROM steps, loader GROUP BY run_id",
    "loader_length": "SELECT count(*) // 16 AS batches, 'train' AS loader FROM documents UNION ALL SELECT (count(*) + 15) // 16, 'validation' FROM documents",
    "roundtrip_audit": f"WITH {ENCODED}, decoded AS (SELECT text, decode(unhex(array_to_string(list_transform(ids, lambda i: "
    f"printf('%02X', {_BYTE_OF})), ''))) AS back FROM encoded) SELECT {_bare('text')} = {_bare('back')} AS matches, count(*) AS n FROM decoded GROUP BY ALL",
    "roundtrip_audit_truncated": "SELECT regexp_full_match(substr(hex(encode(text)), 129), '(20)*') AS matches, count(*) AS n FROM documents GROUP BY ALL",
    "generation_diversity": f"WITH {GENERATED} SELECT conv_id, turn, n_tokens, n_chars, round(diversity, 6) AS diversity FROM generated",
    "distribution_histogram": f"WITH {GENERATED}, {SCORED}, prompts AS (SELECT exp(avg(nll)) AS perplexity FROM losses GROUP BY prompt_id) {_histogram('diversity', 'generated', 'diversity', '0.05')} UNION ALL {_histogram('n_chars', 'generated', 'n_chars', '50')} UNION ALL {_histogram('perplexity', 'prompts', 'perplexity', '5')}",
    "length_vs_diversity": f"WITH {GENERATED} SELECT floor(n_tokens / 10)::BIGINT AS bucket, round(avg(diversity), 6) AS mean_diversity, count(*) AS n FROM generated GROUP BY 1",
    "length_diversity_correlation": f"WITH {GENERATED} SELECT round(corr(n_tokens, diversity), 6) AS correlation FROM generated",
    "prompt_perplexity": f"WITH {SCORED} SELECT prompt_id, round(exp(avg(nll)), 4) AS perplexity FROM losses GROUP BY prompt_id",
    "retention_rate": f"WITH {CLEANED} SELECT count(*) AS scanned, count(*) FILTER (WHERE length(text) BETWEEN 150 AND 500) AS kept, round(count(*) FILTER (WHERE length(text) BETWEEN 150 AND 500) / count(*), 6) AS rate FROM cleaned",
    # windows and ordered sequences
    "tail_split": f"WITH {KEPT}, {_split('kept', None)} SELECT split, sample_no, text FROM splits",
    "tail_split_with_validation": f"WITH {WITH_VALIDATION} SELECT split, sample_no, text FROM splits",
    "global_index_by_key": "SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx FROM conversations",
    "sliding_windows": f"WITH {WINDOWS} SELECT window_start, input_ids, labels FROM windows",
    "sliding_windows_every_token": f"WITH {STREAM} SELECT pos AS window_start, input_sum, first_input, last_label FROM (SELECT pos, token_id AS first_input, (sum(token_id) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND 15 FOLLOWING))::BIGINT AS input_sum, lead(token_id, 16) OVER (ORDER BY pos) AS last_label FROM stream) WHERE last_label IS NOT NULL",
    # Blocks of 1,024 positions with the 128 that follow, cut into every window that begins in them.
    "sliding_windows_stride_1": f"WITH {STREAM}, placed AS (SELECT pos // 1024 AS block, pos, token_id FROM stream UNION ALL SELECT pos // 1024 - 1, pos, token_id FROM stream WHERE pos >= 1024 AND pos % 1024 < 128), blocks AS (SELECT block, list(token_id::VARCHAR ORDER BY pos) AS ids FROM placed GROUP BY block), cut AS (SELECT block * 1024 + i - 1 AS window_start, md5(array_to_string(ids[i:i + 127], ' ')) AS inputs, md5(array_to_string(ids[i + 1:i + 128], ' ')) AS labels FROM (SELECT block, ids, unnest(range(1, least(len(ids) - 128, 1024) + 1)) AS i FROM blocks)) SELECT window_start // 4096 AS part, count(*) AS windows, md5(string_agg(inputs, '' ORDER BY window_start)) AS inputs_md5, md5(string_agg(labels, '' ORDER BY window_start)) AS labels_md5 FROM cut GROUP BY window_start // 4096",
    "next_token_labels": f"WITH {ENCODED} SELECT doc_id, {_joined('list_concat(input_ids[2:], [3])')} AS labels FROM encoded",
    "moving_average": f"WITH {LOG} SELECT name, round(avg(value), 6) AS moving_average FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ts DESC, event_id DESC) AS n FROM log) WHERE n <= 100 GROUP BY name",
    "moving_average_series": f"WITH {LOG} SELECT name, event_id, round(avg(value) OVER (PARTITION BY name ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 9) AS moving_average FROM log",
    "best_so_far": f"WITH {LOSSES} SELECT run_id, step, value, best_before, best_before IS NULL OR value < best_before AS is_best FROM (SELECT *, min(value) OVER (PARTITION BY run_id ORDER BY ts, step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM losses)",
    "early_stopping": f"WITH {LOSSES}, {_stops('ts, step')} SELECT run_id, step, counter, early_stop FROM stops",
    "early_stopping_with_delta": f"WITH {STOPS_WITH_DELTA} SELECT run_id, count(*) AS checks, bool_or(stop) AS stopped, coalesce(min(CASE WHEN stop THEN step END), -1) AS stop_step FROM fold GROUP BY run_id",
    "early_stopping_long_runs": f"WITH {_stops_with_delta('0.5', 20, 'ts, step', 'name', LONG_LOSSES)} SELECT name, step AS event_id, counter, stop AS early_stop FROM fold",
    "checkpoint_retention": f"WITH {CATALOG} SELECT run_id, step, path FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS n FROM catalog) WHERE n <= 5",
    "assign_batches": "SELECT doc_id, n // 16 AS batch_id, (n % 16)::INTEGER AS slot FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n, count(*) OVER () AS total FROM documents) WHERE n // 16 < total // 16",
    "assign_batches_keep_last": "SELECT doc_id, n // 16 AS batch_id, (n % 16)::INTEGER AS slot FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents)",
    "nucleus_filter": f"WITH {_sampling('0.5', 40, '0.8')} SELECT vec_id, idx::INTEGER AS idx, round(p, 6) AS p FROM nucleus",
    "document_token_offsets": f"WITH {ENCODED} SELECT doc_id, len(input_ids) AS n_tokens, coalesce(sum(len(input_ids)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_pos FROM encoded",
    # sorts, limits, top-k
    "appended_positions": f"WITH {ENCODED}, sized AS (SELECT doc_id, doc_id // 64 % 3 AS arrival, len(coalesce(ids, []))::BIGINT AS n_tokens FROM encoded) "
    "SELECT doc_id, n_tokens, row_number() OVER ordered - 1 AS position, (sum(n_tokens) OVER ordered - n_tokens)::BIGINT AS start_pos "
    "FROM sized WINDOW ordered AS (ORDER BY arrival, doc_id ROWS UNBOUNDED PRECEDING)",
    "head_per_split": f"WITH {WITH_VALIDATION} SELECT split, sample_no, text FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY sample_no) AS n FROM splits) WHERE n <= CASE split WHEN 'train' THEN 50 ELSE 40 END",
    "shuffle_examples": "SELECT doc_id, row_number() OVER (ORDER BY md5('7|1|' || doc_id), doc_id) - 1 AS place FROM documents",
    "shuffle_permuted": f"SELECT doc_id, {_permuted('idx', 'n', 7, 1)} AS place FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx, count(*) OVER () AS n FROM documents)",
    "training_batches_permuted": f"WITH {WINDOWS}, numbered AS (SELECT *, window_start // 128 AS idx, count(*) OVER () AS n FROM windows), placed AS (SELECT *, {_permuted('idx', 'n', 5, 2)} AS place FROM numbered) SELECT place // 16 AS batch_id, (place % 16)::INTEGER AS slot, window_start, input_ids, labels FROM placed WHERE place // 16 < n // 16",
    "top_k_filter": f"WITH {SCORED} SELECT vec_id, idx::INTEGER AS idx FROM (SELECT *, max(CASE WHEN place = 10 THEN logit END) OVER (PARTITION BY vec_id) AS kth FROM ranked) WHERE logit >= kth",
    "top_n_indices": f"WITH {SCORED} SELECT vec_id, string_agg(idx::VARCHAR, ' ' ORDER BY place) AS top_indices FROM ranked WHERE place <= 5 GROUP BY vec_id",
    "argmax": f"WITH {SCORED} SELECT vec_id, idx::INTEGER AS predicted FROM ranked WHERE place = 1",
    "resolve_checkpoint_best": f"WITH {CATALOG} SELECT run_id, arg_min(path, (val_loss, step)) AS path FROM catalog GROUP BY run_id",
    "resolve_from_catalog": f"WITH {CATALOG} SELECT run_id, arg_max(path, step) AS path FROM catalog GROUP BY run_id",
    "resolve_checkpoint_latest": f"WITH {CATALOG} SELECT run_id, arg_max(path, step) AS path FROM catalog GROUP BY run_id",
    # set operations
    "union_files": "SELECT 0 AS file_no, row_number() OVER (ORDER BY doc_id) - 1 AS line_no, text FROM documents UNION ALL SELECT 1, row_number() OVER (ORDER BY item_id) - 1, text FROM benchmark",
    "concat_token_streams": f"WITH {STREAM} SELECT pos, doc_id, token_id FROM stream",
    "split_complement": "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) AS n FROM documents) WHERE n > 50",
    # encoding and training examples
    "encode_corpus": f"WITH {ENCODED} SELECT doc_id, {_joined('input_ids')} AS input_ids, array_to_string(list_transform(input_ids, lambda x: '0'), ' ') AS token_type_ids, array_to_string(list_transform(input_ids, lambda x: '1'), ' ') AS attention_mask FROM encoded",
    "encode_corpus_merged": f"WITH {TRAINED}, spelled AS (SELECT word, replace(trim(syms, '|'), '||', ' ') AS ids FROM trained WHERE step = 40 UNION ALL SELECT word, ids[1]::VARCHAR FROM coded WHERE len(ids) = 1), said AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS n FROM (SELECT doc_id, regexp_extract_all(text, '{_WORDS}') AS w FROM documents)) SELECT doc_id, '0 ' || string_agg(ids, ' ' ORDER BY n) || ' 1' AS input_ids FROM said JOIN spelled USING (word) GROUP BY doc_id",
    "encode_with_own_tokenizer": f"SELECT doc_id, {_joined('''list_transform(string_split(coalesce(text, ''), ' '), lambda w: length(w))''')} AS ids FROM documents",
    "encode_batches": f"WITH {ENCODED}, sized AS (SELECT doc_id, input_ids, len(input_ids) AS n, max(len(input_ids)) OVER (PARTITION BY doc_id // 16) AS longest FROM encoded) SELECT doc_id, array_to_string(list_concat(input_ids::VARCHAR[], list_transform(range(n, longest), lambda i: '3')), ' ') AS input_ids, array_to_string(list_transform(range(0, longest), lambda i: '0'), ' ') AS token_type_ids, array_to_string(list_transform(range(0, longest), lambda i: CASE WHEN i < n THEN '1' ELSE '0' END), ' ') AS attention_mask FROM sized",
    "add_special": f"WITH {CLEANED} SELECT doc_id, {_joined('list_concat([0], ' + _byte_ids('text') + ', [1])')} AS ids FROM cleaned",
    "truncate": f"WITH {CLEANED} SELECT doc_id, {_joined('list_concat([0], ' + _byte_ids('text') + ', [1])[1:64]')} AS ids FROM cleaned",
    "pad": f"WITH {CLEANED}, listed AS (SELECT doc_id, list_concat([0], {_byte_ids('text')}, [1]) AS ids FROM cleaned) SELECT doc_id, array_to_string(list_concat(ids::VARCHAR[], list_transform(range(len(ids), greatest(1000, len(ids))), lambda i: '3')), ' ') AS ids FROM listed",
    "masks": f"WITH {ENCODED} SELECT doc_id, array_to_string(list_transform(ids, lambda x: '1'), ' ') AS attention_mask, array_to_string(list_transform(ids, lambda x: '0'), ' ') AS token_type_ids FROM encoded",
    "decode_corpus": "SELECT doc_id, text FROM documents",
    "decode_batches": "SELECT doc_id, text FROM documents",
    "prepare_inputs": f"WITH {FITTED} SELECT doc_id, {_joined('input_ids')} AS input_ids, {_FIT_MASKS} FROM fitted",
    "causal_lm_inputs": f"WITH {FITTED} SELECT doc_id, {_joined('input_ids')} AS input_ids, {_joined('list_concat(input_ids[2:], [3])')} AS labels, {_FIT_MASKS} FROM fitted",
    "masked_lm_inputs": f"WITH {MASKED} SELECT doc_id, {_joined('masked.input_ids')} AS input_ids, {_joined('fitted.input_ids')} AS labels, {_FIT_MASKS} FROM fitted JOIN masked USING (doc_id)",
    "masked_token_count": f"WITH {MASKED} SELECT count(*) AS masked_tokens FROM changed WHERE id = 2",
    "example_audit": f"WITH {MASKED} SELECT count(*) AS n_rows, count(*) FILTER (WHERE list_contains(masked.input_ids, 2)) AS with_mask, count(*) FILTER (WHERE len(masked.input_ids) = longest) AS of_length, count(*) FILTER (WHERE len(masked.input_ids) = len(fitted.input_ids)) AS labels_fit FROM masked JOIN fitted USING (doc_id)",
    "custom_collation": f"WITH {WINDOWS} SELECT window_start, array_to_string(list_transform(range(128), lambda i: '1'), ' ') AS attention_mask, split_part(labels, ' ', 1)::INTEGER AS first_label FROM windows",
    "alignment_check": f"WITH {WINDOWS} SELECT {_aligned('labels')} AS aligned FROM windows",
    "alignment_check_unshifted": f"WITH {WINDOWS} SELECT {_aligned('input_ids')} AS aligned FROM windows",
    "sample_next_token": f"WITH {_sampling('0.7', 40, '0.9')}, cumulated AS (SELECT *, sum(p) OVER (PARTITION BY vec_id ORDER BY place) AS upto, {_uniform('''md5('11|' || vec_id)''')} AS u FROM nucleus) SELECT vec_id, coalesce(arg_min(CASE WHEN upto > u THEN idx END, CASE WHEN upto > u THEN place END), arg_max(idx, place))::INTEGER AS next_token FROM cumulated GROUP BY vec_id",
    "training_batches": f"WITH {WINDOWS}, placed AS (SELECT *, row_number() OVER (ORDER BY md5('5|0|' || window_start), window_start) - 1 AS n, count(*) OVER () AS total FROM windows) SELECT n // 16 AS batch_id, (n % 16)::INTEGER AS slot, window_start, input_ids, labels FROM placed WHERE n // 16 < total // 16",
    "validation_batches": f"WITH {WINDOWS}, placed AS (SELECT *, row_number() OVER (ORDER BY window_start) - 1 AS n FROM windows) SELECT n // 16 AS batch_id, (n % 16)::INTEGER AS slot, window_start, input_ids FROM placed",
    # streams
    "stream_metric_tracker_restarted": f"WITH {LOG} SELECT name, round(avg(value), 6) AS average, arg_max(value, (ts, event_id)) AS latest, count(*) AS updates FROM log GROUP BY name",
    "stream_run_catalog": f"WITH {CATALOG}, kept AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS r FROM catalog), "
    "ends AS (SELECT run_id, arg_min(path, (val_loss, step)) FILTER (val_loss IS NOT NULL) AS best_checkpoint, min(val_loss) AS best_metric, "
    "arg_max(path, step) AS last_checkpoint FROM catalog GROUP BY run_id) SELECT run_id::VARCHAR AS run_id, (SELECT string_agg(path, ' ' ORDER BY step) FROM kept "
    "WHERE kept.run_id = ends.run_id AND r <= 5) AS checkpoints, best_checkpoint, best_metric, last_checkpoint, best_checkpoint AS path FROM ends",
    "stream_evicted_checkpoints": f"WITH {CATALOG} SELECT run_id::VARCHAR AS run_id, step, path FROM "
    "(SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS r FROM catalog) WHERE r > 5",
    "stream_metric_tracker": f"WITH {LOG} SELECT name, round(avg(value), 6) AS average, arg_max(value, (ts, event_id)) AS latest, count(*) AS updates FROM log GROUP BY name",
    "stream_early_stopping_late": f"WITH {_stops_with_delta('0.25', 5, 'ts, step')} SELECT run_id, count(*) AS checks, arg_max(counter, n) AS counter, -arg_max(best, n) AS best_loss, bool_or(stop) AS stopped, coalesce(min_by(step, n) FILTER (stop), -1) AS stop_step FROM fold GROUP BY run_id",
    "stream_early_stopping": f"WITH {LOSSES}, {_stops('step')} SELECT run_id, count(*) AS checks, arg_max(counter, step) AS counter, min(value) AS best_loss, bool_or(early_stop) AS stopped, coalesce(min(CASE WHEN early_stop THEN step END), -1) AS stop_step FROM stops GROUP BY run_id",
}
for _name in ("prepare_inputs", "causal_lm_inputs", "masked_lm_inputs", "masked_token_count", "example_audit"):
    ORACLE[f"{_name}_whole"] = ORACLE[_name]
