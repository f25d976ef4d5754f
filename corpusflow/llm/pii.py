"""Personal data in texts: fixed patterns, and patterns of context learned from what these find.

Seeds are the spans of the fixed patterns. The word before an identifier is a lexical
pattern, whatever the identifier looks like, so emails and phones make a word reliable
for written-out addresses, plain phones and other numbers after it. Spark builds the
graph of patterns and instances and scores it in rounds, until none adds a pattern: a
pattern is as reliable as the share of all uses of its word that lead to reliable
instances, an instance as reliable as the reliable patterns make it. Reliable patterns
then report identifiers that no fixed pattern knows.

Nothing of the graph passes through the driver. A null text is empty; rows are
independent, and repeated rows get repeated answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.logits import let
from corpusflow.llm.quality import words_of
from corpusflow.llm.spans import ahead_of, as_text, blocks_of, covered, cut_out, find_spans, tagged
from corpusflow.scratch import materialize

KINDS = ("email", "ip", "card", "phone", "context")
# The patterns, written so that no text takes more than linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Candidates of the contexts: addresses written out or without a full domain, digits in groups, and other runs with digits.
_LOCAL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++"
_AT = r"\x20?(?:@|[(\[{<](?i:at)[)\]}>])\x20?"
_DOT = r"(?:\x20?[(\[{<](?i:dot)[)\]}>]\x20?|\x20(?i:dot)\x20|\.)"
_HOST = r"[A-Za-z0-9-]++"
ADDRESS = rf"{_LOCAL}(?:{_AT}{_HOST}(?:{_DOT}{_HOST})*+|\x20(?i:at)\x20{_HOST}(?:{_DOT}{_HOST})++)"
GROUPS = (r"(?<![A-Za-z0-9])\+?\(?[0-9]{1,4}+(?![A-Za-z0-9])(?:\)?(?:[\x20./-]|\x20-\x20)?\(?[0-9]{2,6}+(?![A-Za-z0-9]))++"
          r"(?![./_:-]?[A-Za-z0-9])")
IDENTIFIER = r"(?<![A-Za-z0-9])[A-Za-z]*+[0-9][A-Za-z0-9]*+(?:[./_:-][A-Za-z0-9]++)*+"
CANDIDATE = f"{ADDRESS}|{GROUPS}|{IDENTIFIER}"

LEAST_DIGITS = 5  # digits of an identifier that no fixed pattern knows
LEAST_CONFIDENCE = 0.5
LEAST_INSTANCES = 5
BROADCAST_WORDS = 100_000
INSTANCES = "array<struct<start:int,end:int,word:string,instance:bigint,seed:boolean>>"


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a string of digits is right."""

    def value(i: Column) -> Column:
        digit = F.substring(number, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(digit > 9, digit - 9).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda s, i: s + value(i))
    return total % 10 == 0


def valid_card(found: Column) -> Column:
    return let(digits(found), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))


def valid_ip(found: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+(?=.)", "")
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(999)) <= 255)

    return F.forall(F.split(found, r"\."), small)


def base_spans(text: Column) -> Column:
    return F.struct(
        tagged(find_spans(text, EMAIL), "email", 0).alias("email"),
        tagged(find_spans(text, IP, valid_ip), "ip", 1).alias("ip"),
        tagged(find_spans(text, CARD, valid_card), "card", 2).alias("card"),
        tagged(find_spans(text, PHONE, lambda m: F.length(digits(m)).between(9, 15)), "phone", 3).alias("phone"),
    )


def by_kind(spans: Column) -> Column:
    """Spans ordered by kind, then place."""
    turned = F.sort_array(F.transform(spans, lambda s: F.struct(s["order"].alias("order"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return turned


def context_of(blocks: Column, start: Column) -> Column:
    """The word before a place, lower-cased, digits as 9; of a long one, what lies in the 60 characters before the place."""
    before = cut_out(blocks, F.greatest(start - 60, F.lit(0)), start)
    word = F.regexp_extract(before, r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*\z", 1)
    return F.regexp_replace(F.lower(word), "[0-9]", "9")


def is_candidate(found: Column) -> Column:
    """Whether a match of CANDIDATE is an address or has enough digits."""
    return (F.length(digits(found)) >= LEAST_DIGITS) | found.rlike(rf"\A(?:{ADDRESS})\z")


def _found(df: DataFrame, key: str) -> DataFrame:
    """Per row: base spans, and identifiers with context and whether a base span covers part of them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = df.select(F.col(key), text.alias("_t"))
    likely = F.col("_t").rlike("[0-9@]")
    scanned = plain.select(key, "_t", F.when(likely, base_spans(F.col("_t"))).alias("_b"))
    lists = {k: F.coalesce(F.col(f"_b.{k}"), F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")) for k in KINDS[:4]}
    spans = scanned.select(key, "_t", *[F.size(lists[k]).cast("bigint").alias(f"n_{k}") for k in KINDS[:4]],
                           by_kind(F.concat(*lists.values())).alias("base"))

    def instance(blocks: Column, start: Column, end: Column, found: Column, seed: bool) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), context_of(blocks, start).alias("word"),
                        F.xxhash64(F.lower(found)).alias("instance"), F.lit(seed).alias("seed"))

    free = F.filter(covered(find_spans(F.col("_t"), CANDIDATE, is_candidate), F.col("base")), lambda r: ~r["covered"])

    def instances(blocks: Column, others: Column) -> Column:
        seeds = F.transform("base", lambda s: instance(blocks, s["start"], s["end"], cut_out(blocks, s["start"], s["end"]), True))
        return F.concat(seeds, F.transform(others, lambda r: instance(blocks, r["start"], r["end"], r["found"], False)))

    none = F.array().cast(INSTANCES)
    told = let(free, lambda f: F.when(F.size(f) + F.size("base") == 0, none).otherwise(
        let(blocks_of(F.col("_t")), lambda x: instances(x, f))))
    return spans.select(key, *[f"n_{k}" for k in KINDS[:4]], "base", told.alias("instances"))


def reliable_patterns(found: DataFrame, texts: DataFrame) -> DataFrame:
    """The words that reach LEAST_CONFIDENCE with LEAST_INSTANCES reliable instances.

    A round scores the words that are not reliable yet, so a word never vouches for itself. Words keep the
    confidence with which they became reliable; the rounds end when none is added.
    """
    uses = found.select(F.explode("instances").alias("i")).select("i.*").filter("word != ''")
    edges = materialize(uses.groupBy("word", "instance").agg(
        F.count("*").alias("uses"), F.max(F.col("seed").cast("int")).alias("seed")), "pii-edges")
    # A word with fewer instances can't become reliable; seeds are not needed, as reliable words bring others up.
    words = edges.groupBy("word").agg(F.count_distinct("instance").alias("n")).filter(F.col("n") >= LEAST_INSTANCES).select("word")
    words = materialize(words, "pii-words")
    token = F.regexp_replace(F.lower(F.col("word")), "[0-9]", "9")
    said = texts.select(F.explode(words_of(F.coalesce("text", F.lit("")))).alias("word")).select(token.alias("word"))
    known = F.broadcast(words) if words.count() <= BROADCAST_WORDS else words
    frequency = materialize(said.join(known, "word").groupBy("word").agg(F.count("*").alias("said")), "pii-said")
    seeds = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("score"))
    edges = materialize(edges.join(frequency, "word").drop("seed").join(seeds, "instance"), "pii-graph")
    strong: DataFrame | None = None
    scored = edges
    while True:
        patterns = scored.groupBy("word").agg(
            F.least(F.lit(1.0), F.sum(F.col("uses") * F.col("score")) / F.max("said")).alias("confidence"),
            F.sum(F.when(F.col("score") >= LEAST_CONFIDENCE, 1).otherwise(0)).alias("support"))
        new = patterns.filter((F.col("confidence") >= LEAST_CONFIDENCE) & (F.col("support") >= LEAST_INSTANCES)).select("word", "confidence")
        new = materialize(new, "pii-patterns")
        if strong is not None and new.isEmpty():
            return strong.select("word")
        strong = new if strong is None else materialize(strong.unionByName(new), "pii-strong")
        doubt = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999999)))).alias("doubt")
        told = edges.join(strong, "word").groupBy("instance").agg(doubt)
        open_edges = edges.join(strong, "word", "left_anti").join(told, "instance", "left")
        scored = open_edges.withColumn("score", F.greatest("score", 1 - F.exp(F.coalesce("doubt", F.lit(0.0)))))


def scan_pii(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """`(key, n_email, n_ip, n_card, n_phone, base, all)` for every row of `df(key, text)`, spans ordered by kind and place."""
    found = materialize(_found(df, key).withColumn("_row", F.monotonically_increasing_id()), "pii")
    patterns = reliable_patterns(found, df)
    free = found.select("_row", F.explode(F.filter("instances", lambda i: ~i["seed"])).alias("i")).select("_row", "i.*")
    hits = free.join(patterns, "word").select("_row", F.struct(
        F.lit(4).alias("order"), "start", "end", F.lit(KINDS[4]).alias("kind")).alias("span"))
    more = hits.groupBy("_row").agg(F.sort_array(F.collect_set("span")).alias("more"))
    joined = found.drop("instances").join(more, "_row", "left")
    every = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more"))
    return joined.select(key, *[f"n_{k}" for k in KINDS[:4]], "base", every.alias("all"))


def digest_of(spans: Column) -> Column:
    return F.sha2(F.encode(as_text(spans), "UTF-8"), 256)


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of spans that overlap, the first covers the others."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def shortened(blocks: Column, order: Column, ahead: Column) -> Column:
        placed = F.transform(order, lambda s, i: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), F.get(ahead, i).alias("ahead")))
        parts = F.transform(F.filter(placed, lambda s: s["start"] >= s["ahead"]), lambda s: F.concat(
            cut_out(blocks, s["ahead"], s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]")))
        rest = cut_out(blocks, F.array_max(F.transform(order, lambda s: s["end"])), F.length(text))
        return F.concat(F.array_join(parts, ""), rest)

    cut = let(blocks_of(text), lambda b: let(ordered, lambda o: let(ahead_of(o), lambda a: shortened(b, o, a))))
    return F.when(F.size(spans) == 0, text).otherwise(cut)


def mask(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """`df` with the spans of its `text` masked, and `n_chars`, if there, counted anew; rows without a span stay as they are.

    Rows are matched with their spans by id and text, so null and repeated ids are told apart.
    """
    row = F.xxhash64(F.col(key), F.col("text"))
    told = scan_pii(df.withColumn("_pii", row), "_pii").filter(F.size("all") > 0).select("_pii", "all").dropDuplicates(["_pii"])
    named = told.select(F.col("_pii").alias("_pii_row"), F.col("all").alias("_pii_spans"))
    joined = df.join(named, row == F.col("_pii_row"), "left")
    text = F.when(F.col("_pii_spans").isNull(), F.col("text")).otherwise(masked(F.col("text"), F.col("_pii_spans")))
    out = {c: F.col(c) for c in df.columns} | {"text": text}
    if "n_chars" in out:
        changed = F.col("_pii_spans").isNotNull()
        out["n_chars"] = F.when(changed, F.length(text)).otherwise(F.col("n_chars")).cast(df.schema["n_chars"].dataType)
    return joined.select(*[c.alias(n) for n, c in out.items()])
