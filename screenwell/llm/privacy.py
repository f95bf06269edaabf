"""Personal data: fixed kinds by pattern, and terms that reveal them by co-occurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwell.llm.store import Scratch, small

#: What counts as personal data, as patterns whose loops never go back, so that their time is linear
#: and their stack flat on any text. A match may begin where the last one ended, or where no
#: character of the same run stands before.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without a match of this has none of the kind either.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
TERM = "term"
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"
SUPPORT, THRESHOLD = 3, 0.8


def luhn(digits: Column) -> Column:
    """True when the weighted digit sum is a multiple of ten."""
    n = F.length(digits)
    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(OCTETS)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def located(kind: str, gaps: Column, found: Column) -> Column:
    """Spans of the matches ``found`` between the texts ``gaps``, in code points, end exclusive."""
    start = F.struct(F.length(F.get(gaps, F.lit(0))).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(state: Column, i: Column) -> Column:
        value = F.get(found, i - 1)
        end = state["at"] + F.length(value)
        span = F.struct(F.lit(kind).alias("kind"), state["at"].alias("start"), end.alias("end"), value.alias("value"))
        return F.struct((end + F.length(F.get(gaps, i))).alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    return F.when(F.size(found) > 0, F.aggregate(F.sequence(F.lit(1), F.size(found)), start, step, lambda s: s["out"])
                  ).otherwise(F.array().cast(SPAN))


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus column ``_base``: spans of the four kinds, by kind and then by start."""
    value = F.coalesce(F.col(text), F.lit(""))
    out = docs
    for kind, pattern in KINDS.items():
        has = value.contains(NEEDS[kind]) if kind == "email" else value.rlike(NEEDS[kind])
        out = out.withColumn(f"_{kind}_found", F.when(has, F.regexp_extract_all(value, F.lit(pattern), F.lit(0))))
    for kind, pattern in KINDS.items():
        found = F.col(f"_{kind}_found")
        out = out.withColumn(f"_{kind}_gaps", F.when(F.size(found) > 0, F.split(value, pattern, -1)))
    def right(kind: str) -> Column:
        spans = located(kind, F.col(f"_{kind}_gaps"), F.col(f"_{kind}_found"))
        return F.coalesce(F.filter(spans, lambda s: valid(kind, s["value"])), F.array().cast(SPAN))

    spans = [right(kind) for kind in KINDS]
    return out.withColumn("_base", F.concat(*spans)).drop(*[f"_{k}_{x}" for k in KINDS for x in ("found", "gaps")])


def disclosing(held: DataFrame, docs: DataFrame, scratch: Scratch, support: int = SUPPORT,
               threshold: float = THRESHOLD, text: str = "text") -> DataFrame | None:
    """(entity, term) of terms that reveal a protected entity, None when there are none.

    All counts are of different texts, copies dropped: N texts, n(e) with entity e, n(t) with term t
    anywhere outside personal data, n(e, t) with both. The term discloses
    log2(n(e, t) N / (n(e) n(t))) bits of the log2(N / n(e)) that the entity's identity has. It counts
    when that share reaches ``threshold`` and ``support`` different texts hold both.

    As n(e, t) <= n(e), only terms with n(t) <= N (n(e) / N) ** threshold can count; others are left
    out before they meet the entities of a text.
    """
    own = scratch.cut(held.dropDuplicates(["text_key"]).select(
        "text_key", F.array_distinct(F.transform("_base", entity_of)).alias("entities"),
        F.array_distinct(terms_of(outside(F.col("text"), F.col("_base")))).alias("terms"),
        F.array_distinct(terms_of(F.col("text"))).alias("all_terms")))
    often = scratch.cut(own.select("text_key", F.explode("entities").alias("entity")).groupBy("entity")
                        .agg(F.count(F.lit(1)).alias("n_entity")).where(F.col("n_entity") >= support))
    if often.isEmpty():
        return None
    once = different(docs.select(F.col(text).alias("text")), scratch)
    total = float(max(2, once.select(F.lit(1)).count()))

    def most(n: Column) -> Column:
        return total * F.pow(n / total, F.lit(threshold)) * (1 + 1e-9)

    top = often.where(F.col("n_entity") < total).agg(F.max("n_entity")).first()[0]
    if top is None:
        return None
    # terms that stand in a text's personal data alone are taken off again
    hidden = own.select(F.explode(F.array_except("all_terms", "terms")).alias("term"), F.lit(-1).alias("w"))
    counts = (once.select(F.explode_outer(F.array_distinct(terms_of(F.col("text")))).alias("term"), F.lit(1).alias("w"))
              .unionByName(hidden).groupBy("term").agg(F.sum("w").alias("n_term"))
              .where((F.col("n_term") >= support) & (F.col("n_term") <= most(F.lit(top)))))
    entities = (own.select("text_key", F.explode("entities").alias("entity")).join(small(often), "entity")
                .groupBy("text_key").agg(F.collect_list(F.struct("entity", "n_entity")).alias("found")))
    rows = (own.select("text_key", "terms").join(entities, "text_key").select("found", F.explode("terms").alias("term"))
            .join(small(scratch.cut(counts)), "term").select(F.explode("found").alias("e"), "term", "n_term")
            .select("e.entity", "e.n_entity", "term", "n_term").where(F.col("n_term") <= most(F.col("n_entity"))))
    terms = rows.groupBy("entity", "n_entity", "term", "n_term").agg(F.count(F.lit(1)).alias("n_both")).where(
        F.col("n_both") >= support)
    bits = F.log2(F.col("n_both") * total / (F.col("n_entity") * F.col("n_term")))
    whole = F.log2(total / F.col("n_entity"))
    found = scratch.cut(terms.where((whole > 0) & (bits >= threshold * whole)).select("entity", "term"))
    return None if found.isEmpty() else found


def different(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Column text without nulls and copies; only texts that have copies are moved."""
    rows = texts.where("text is not null").withColumn("h", F.xxhash64("text"))
    copied = small(scratch.cut(rows.groupBy("h").count().where("count > 1").select("h")))
    return rows.join(copied, "h", "left_anti").unionByName(
        rows.join(copied, "h", "left_semi").dropDuplicates(["h"])).select("text")


def entity_of(span: Column) -> Column:
    return F.concat(span["kind"], F.lit(":"), F.lower(span["value"]))


def outside(text: Column, spans: Column) -> Column:
    """The text with a space in place of each span; spans may overlap."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def step(state: Column, s: Column) -> Column:
        gap = F.substr(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], F.array(gap)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(order, start, step, lambda s: F.concat_ws(" ", s["out"], F.substr(text, s["at"] + 1, F.length(text))))


def terms_of(text: Column) -> Column:
    """Lower-cased words of four letters or more."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: F.length(w) >= 4)


def term_spans(held: DataFrame, pairs: DataFrame) -> DataFrame:
    """(doc_id, text_key, _terms): where disclosing terms stand in the texts that hold their entity."""
    own = (held.select("doc_id", "text_key", F.explode("_base").alias("span"))
           .select("doc_id", "text_key", entity_of(F.col("span")).alias("entity")).distinct()
           .join(pairs, "entity").groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("term")).alias("terms")))
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("terms", "|"), F.lit(r")(?!\p{L})"))
    rows = (held.dropDuplicates(["doc_id", "text_key"]).join(own.withColumnsRenamed({"doc_id": "_d", "text_key": "_k"}),
            F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_k")))
            .withColumn("pattern", pattern)
            .withColumn("found", F.regexp_extract_all("text", F.col("pattern"), F.lit(0)))
            .withColumn("gaps", F.split("text", F.col("pattern"), -1)))
    clear = F.filter(located(TERM, F.col("gaps"), F.col("found")), lambda t: ~F.exists(
        "_base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return rows.select("doc_id", "text_key", clear.alias("_terms"))


def with_spans(docs: DataFrame, text: str = "text", support: int = SUPPORT, threshold: float = THRESHOLD,
               keep_text: bool = True) -> tuple[DataFrame, Scratch]:
    """``docs`` plus ``_base`` and ``_terms``, and the owner of the tables behind them.

    Without ``keep_text`` the result has doc_id and the spans only. Null and empty texts have no
    spans; a null doc_id is an id like others; repeated rows get the same spans.
    """
    scratch = Scratch(docs.sparkSession)
    key = F.xxhash64(text).alias("text_key")
    first = with_base(docs.select("doc_id", F.col(text).alias("text")))
    first = scratch.cut(first.select("doc_id", F.xxhash64("text").alias("text_key"), "_base",
                                     F.when(F.size("_base") > 0, F.col("text")).alias("text")))
    held = first.where("text is not null")
    pairs = disclosing(held, docs, scratch, support, threshold, text)
    rows = with_base(docs, text).withColumn("text_key", key) if keep_text else first.drop("text")
    if pairs is None:
        return rows.withColumn("_terms", F.array().cast(SPAN)).drop("text_key"), scratch
    terms = scratch.cut(term_spans(held, pairs)).withColumnsRenamed({"doc_id": "_d", "text_key": "_k"})
    out = rows.join(small(terms), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_k")), "left")
    return out.withColumn("_terms", F.coalesce("_terms", F.array().cast(SPAN))).drop("_d", "_k", "text_key"), scratch


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts of each kind, base_sha256 and all spans as text."""
    out, scratch = with_spans(docs, keep_text=False)
    def number(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS]
    return scratch.finish(out.select("doc_id", *counts, F.sha2(written(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
                                     written(F.concat("_base", "_terms")).alias("spans")))


def sanitised(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each base span removed (a tag of its kind stands in its place) and disclosing
    terms generalised to ``[term]``; overlapping spans go as one. n_chars, if there, is renewed."""
    rows, _ = with_spans(docs, text)
    spans = F.array_sort(F.transform(F.concat("_base", "_terms"), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(state: Column, s: Column) -> Column:
        gap = F.substr(text, state["at"] + 1, s["start"] - state["at"])
        new = s["start"] >= state["at"]
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(
            new, F.concat(state["out"], F.array(gap, F.concat(F.lit("["), s["kind"], F.lit("]"))))
        ).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    clean = F.aggregate("_spans", start, step, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substr(text, s["at"] + 1, F.length(text))))
    rows = rows.withColumn("_spans", spans)
    rows = rows.withColumn(text, F.when(F.size("_spans") > 0, clean).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.size("_spans") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars")))
    return rows.select(*[f"`{c}`" for c in docs.columns])
