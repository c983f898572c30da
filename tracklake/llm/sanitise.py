"""Information-theoretic sanitisation of personal data, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.storage import discard, materialize

KINDS = ("email", "ip", "card", "phone")
# Each finds what the plain pattern finds from left to right. The guard in front lets a search start
# only at the head of a run or where the last match ended, and the possessive repeats never step
# back, so that long runs take linear time and no stack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TRIGGERS = {"email": lambda t: F.contains(t, F.lit("@")), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"), "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"), "phone": lambda t: F.contains(t, F.lit("+"))}
SPAN = "array<struct<begin:int,stop:int,value:string>>"
WORD = r"[^\x20\x09-\x0D]+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        bare = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return ~F.exists(bare, lambda p: (F.length(p) > 3) | (F.lpad(p, 3, "0") > "255"))
    if kind == "card":
        return F.length(_digits(value)).between(16, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """The spans of one kind in code points, end exclusive; matches that fail the kind's test are left out."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        stop = begin + F.length(x["value"])
        own = F.array(F.struct(begin.alias("begin"), stop.alias("stop"), x["value"].alias("value")))
        return F.struct(stop.alias("at"), F.concat(acc["out"], own).alias("out"))

    spans = F.filter(F.aggregate(pairs, start, step, lambda acc: acc["out"]), lambda s: _holds(kind, s["value"]))
    return F.when(TRIGGERS[kind](text), spans).otherwise(F.array().cast(SPAN))


def listed(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["begin"], s["stop"]))


def _entities(kind: str) -> Column:
    return F.transform(kind, lambda s: F.concat(F.lit(f"{kind}:"), F.lower(s["value"])))


def find_private(docs: DataFrame, threshold: float = 0.8, support: int = 3) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, the spans of each kind, and ``term``, further spans.

    The base spans' values are the protected entities. Over the corpus, a term t (a lower-cased word
    with a letter) tells of an entity e the pointwise mutual information of their occurrence in texts,
    log(N n(t,e) / (n(t) n(e))). Where that reaches ``threshold`` of the entity's own information
    log(N / n(e)), and both stand together in ``support`` different texts at least, t discloses e:
    in all texts that hold e, each occurrence of t outside of the base spans is a term span. Pairs
    are made only of terms and entities of the same text, of which terms that are too frequent to reach the
    threshold are left out first; texts that are equal count once in all four counts.

    Null and empty texts have no spans. A null doc_id stays null; repeated rows are handled each.
    An empty table gives no rows. Other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = rows.select("doc_id", "row", "text", *(base_spans(F.col("text"), k).alias(k) for k in KINDS))
    values = F.array_distinct(F.flatten(F.array(*(_entities(k) for k in KINDS))))
    own = F.size("entities") > 0
    rows = rows.withColumn("entities", values).withColumn("digest", F.xxhash64("text")).withColumn("text", F.when(own, F.col("text")))
    rows = materialize(rows, "private")
    holders = rows.where(own)
    n_docs = rows.select("digest").distinct().count()

    def terms(t: Column) -> Column:
        return F.filter(F.array_distinct(F.split(F.lower(t), r"[\x20\x09-\x0D]+")), lambda w: w.rlike(r"\p{L}"))

    distinct = docs.select(text.alias("text")).withColumn("digest", F.xxhash64("text")).dropDuplicates(["digest"])
    n_term = materialize(distinct.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term")).where(F.col("n_term") >= support), "terms-counted")
    pairs = holders.select("row", "digest", F.explode("entities").alias("entity"))
    own_texts = holders.dropDuplicates(["digest"])
    n_entity = own_texts.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= support)
    n_entity = materialize(n_entity, "entities")
    known = materialize(pairs.join(n_entity, "entity"), "holders")
    of_texts = known.dropDuplicates(["digest", "entity"]).select("digest", "entity", "n_entity")
    counted = own_texts.select("digest", F.explode(terms(F.col("text"))).alias("term")).join(n_term, "term")
    # n_both is n_entity at most, so no term more frequent than this can reach the threshold with the entity
    rare = F.col("n_term") <= F.pow(F.col("n_entity").cast("double"), F.lit(threshold)) * float(max(1, n_docs)) ** (1 - threshold) * (1 + 1e-9)
    both = of_texts.join(counted, "digest").where(rare).groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.first("n_entity").alias("n_entity"), F.first("n_term").alias("n_term"))
    both = both.where((F.col("n_both") >= support) & ~F.contains("entity", "term"))
    told = F.log(F.lit(float(n_docs)) * F.col("n_both") / (F.greatest("n_term", "n_both") * F.col("n_entity")))
    shares = told >= threshold * F.log(F.lit(float(n_docs)) / F.col("n_entity"))
    flagged = materialize(both.where(shares).select("entity", "term", F.lit(True).alias("flagged")), "flagged")
    # the words of the texts that hold an entity with a flagged term, with their places
    tellers = known.join(flagged.select("entity").distinct(), "entity").groupBy("row").agg(F.collect_set("entity").alias("held")).join(holders.select("row", "text"), "row")
    parts = F.arrays_zip(F.split("text", WORD, -1).alias("gap"), F.regexp_extract_all("text", F.lit(WORD), 0).alias("word"))
    placed = tellers.select("row", "held", F.posexplode(parts).alias("k", "x")).where("x.word IS NOT NULL").select("row", "held", "k", F.col("x.word").alias("word"), F.length("x.gap").alias("gap"))
    reach = Window.partitionBy("row").orderBy("k")
    placed = placed.withColumn("stop", F.sum(F.col("gap") + F.length("word")).over(reach).cast("int")).withColumn("term", F.lower("word")).where(F.col("word").rlike(r"\p{L}"))
    hits = placed.select("row", "stop", "word", "term", F.explode("held").alias("entity")).join(flagged, ["entity", "term"])
    hits = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.struct((F.col("stop") - F.length("word")).alias("begin"), "stop", F.col("word").alias("value")))).alias("term"))
    found = rows.join(materialize(hits, "terms"), "row", "left")
    discard(n_term, n_entity, known, flagged)
    base = F.concat(*KINDS)
    free = F.filter("term", lambda t: ~F.exists(base, lambda b: (b["begin"] < t["stop"]) & (t["begin"] < b["stop"])))
    return found.select("doc_id", *KINDS, F.coalesce(free, F.array().cast(SPAN)).alias("term"))


def sanitised(text: Column, spans: dict[str, Column]) -> Column:
    """``text`` with each span generalised to its kind in brackets; spans must not overlap but within one another's kind order."""

    def labelled(kind: str, own: Column) -> Column:
        return F.transform(own, lambda x: F.struct(x["begin"].alias("begin"), x["stop"].alias("stop"), F.lit(f"[{kind}]").alias("label")))

    named = F.flatten(F.array(*(labelled(k, s) for k, s in spans.items())))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        late = x["begin"] >= acc["at"]
        grown = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["begin"] - acc["at"]), x["label"])
        return F.struct(F.when(late, x["stop"]).otherwise(acc["at"]).alias("at"), F.when(late, grown).otherwise(acc["out"]).alias("out"))

    return F.aggregate(F.array_sort(named), start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
