"""Information-theoretic sanitisation of personal data, DataFrame functions only.

Protected entities are the identifiers that patterns find (e-mail and IP addresses, card numbers by Luhn, phone
numbers) and the classes they belong to: mail domains, networks, card issuers, phone prefixes, the four kinds, and
any identifier at all, for an identifier that stands in one text alone can have no evidence of its own. The corpus
then tells which ordinary terms reveal one: for each entity e and each term t outside identifiers, documents are
counted that hold both, e, and t, anywhere in their whole text. A term discloses e as far as their pointwise mutual
information reaches the entity's information content:
    ratio = log2(n(e,t) N / (n(e) n(t))) / log2(N / n(e)).
If that is at least `threshold` and at most `residue` bits of the entity are left to guess (-log2 n(e,t) / n(t)), the
term is generalised wherever it stands in any document, from the ratio `remove` on it is removed (a
term goes by its highest ratio); identifiers are replaced by their kind. A pair seen in fewer than `support` different
texts is no evidence, for a class in fewer than `class_support`, as chance makes more of such pairs.

Each text is scanned once, for its identifiers and its distinct terms. Texts with identifiers are shuffled once, to
count equal ones together, and texts once to meet the disclosing terms they hold; other shuffles carry
spans, terms and counts with map-side combining. Spans are listed in the row, in time linear in the text and quadratic
in the number of spans alone. Entities in too few texts go before they meet terms, so a text full
of unique identifiers makes no pairs, and joins on an entity have one row per entity on one side, so a frequent one
only makes rows that adaptive execution may split. Patterns cannot backtrack over long runs.

Edge cases: null or empty text has no spans; repeated rows each get theirs; a null id is kept; overlapping
spans of different kinds are all reported, and replaced as one; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.common import Scratch, let

KINDS = ("email", "ip", "card", "phone", "term")
# Each finds what its plain form finds, leftmost and without overlap; runs are entered at their start only.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?+[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"\p{L}[\p{L}\p{N}]{2,}+"
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"
TERMS = "array<struct<start:int,end:int,ratio:double>>"


def find(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of all matches, in code points."""

    def placed(gaps: Column, hits: Column) -> Column:
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

        def step(acc: Column, k: Column) -> Column:
            hit = F.get(hits, k)
            start = acc["at"] + F.length(F.get(gaps, k))
            end = start + F.length(hit)
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), hit.alias("value")))).alias("out"))

        return F.when(F.size(hits) == 0, none["out"]).otherwise(F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), none, step)["out"])

    return let(F.split(text, pattern, -1), lambda gaps: let(F.regexp_extract_all(text, F.lit(pattern), 0), lambda hits: placed(gaps, hits)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def total(d: Column) -> Column:
        digit = lambda k: F.substr(F.reverse(d), k, F.lit(1)).cast("int")
        twice = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda a, k: a + F.when(k % 2 == 0, twice(digit(k))).otherwise(digit(k)))

    return let(_digits(value), lambda d: F.when(F.length(d).between(14, 19), total(d) % 10 == 0).otherwise(F.lit(False)))


def _small_parts(value: Column) -> Column:
    stripped = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return F.forall(F.split(value, r"\."), lambda p: F.when(F.length(stripped(p)) > 3, F.lit(False)).otherwise(stripped(p).cast("int") <= 255))


def identifiers(text: Column) -> Column:
    """Sorted spans of the four kinds; texts without their telling characters are not scanned again."""
    none = F.array().cast(SPAN)
    ok = {"email": lambda v: F.lit(True), "ip": _small_parts, "card": _luhn, "phone": lambda v: F.length(_digits(v)).between(10, 15)}
    hint = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]++\.[0-9]"), "card": text.rlike(CARD), "phone": F.contains(text, F.lit("+"))}

    def of(k: int, kind: str, pattern: str) -> Column:
        hits = F.filter(find(text, pattern), lambda s: ok[kind](s["value"]))
        spans = F.transform(hits, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
        return F.when(hint[kind], spans.cast(SPAN)).otherwise(none)

    found = [of(k, kind, pattern) for k, (kind, pattern) in enumerate(zip(KINDS, (EMAIL, IP, CARD, PHONE)))]
    return F.array_sort(F.concat(*found))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _terms(rows: DataFrame, *key: str) -> DataFrame:
    """(key..., term, start, end) of each term in `text` that is outside `base`; linear in the words."""
    parts = F.arrays_zip(F.split("text", TERM, -1).alias("gap"), F.regexp_extract_all("text", F.lit(TERM), F.lit(0)).alias("hit"))
    words = rows.select(*key, F.posexplode(parts).alias("at", "w")).select(*key, "at", F.length("w.gap").alias("gap"), F.col("w.hit").alias("hit"))
    size = F.coalesce(F.length("hit"), F.lit(0))
    words = words.withColumn("end", F.sum(F.col("gap") + size).over(Window.partitionBy(*key).orderBy("at")).cast("int")).where("hit is not null")
    words = words.select(*key, F.lower("hit").alias("term"), (F.col("end") - F.length("hit")).alias("start"), "end")
    spans = rows.where(F.size("base") > 0).select(*key, "base")
    outside = F.col("base").isNull() | ~F.exists("base", lambda b: (F.col("start") < b["end"]) & (F.col("end") > b["start"]))
    return words.join(spans, list(key), "left").where(outside).select(*key, "term", "start", "end")


def term_spans(text: Column, base: Column, telling: Column) -> Column:
    """array<struct<start, end, ratio>> of the words among `telling` that are outside `base`."""

    def placed(gaps: Column, words: Column, terms: Column) -> Column:
        def step(acc: Column, k: Column) -> Column:
            start = acc["at"] + F.length(F.get(gaps, k))
            end = start + F.length(F.get(words, k))
            nth = F.array_position(terms, F.lower(F.get(words, k)))
            outside = ~F.exists(base, lambda b: (start < b["end"]) & (end > b["start"]))
            span = F.struct(start.alias("start"), end.alias("end"), F.get(telling, nth.cast("int") - 1)["ratio"].alias("ratio"))
            return F.struct(end.alias("at"), F.when((nth > 0) & outside, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

        none = F.struct(F.lit(0).alias("at"), F.array().cast(TERMS).alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(words) - 1), none, step)["out"]

    return let(F.split(text, TERM, -1), lambda gaps: let(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda words: let(F.transform(telling, lambda t: t["term"]), lambda terms: placed(gaps, words, terms))))


def entities(base: Column) -> Column:
    """Names of the entities of a text: "=kind:value" for an identifier, "~..." for the classes it belongs to."""
    kinds = F.array(*map(F.lit, KINDS))

    def of(b: Column) -> Column:
        value, kind = F.lower(b["value"]), F.get(kinds, b["kind"])
        group = F.when(b["kind"] == 0, F.substring_index(value, "@", -1)).when(b["kind"] == 1, F.substring_index(value, ".", 2)).when(b["kind"] == 2, F.substring(_digits(value), 1, 6)).otherwise(F.substring(_digits(value), 1, 4))
        return F.array(F.concat(F.lit("="), kind, F.lit(":"), value), F.concat(F.lit("~"), kind, F.lit(":"), group), F.concat(F.lit("~"), kind), F.lit("~any"))

    return F.array_distinct(F.flatten(F.transform(base, of)))


def _disclosing(scanned: DataFrame, scratch: Scratch, threshold: float, residue: float, support: int, class_support: int) -> DataFrame:
    """(term, ratio) of the terms that disclose an entity, the highest over all entities; n counts documents, support different texts."""
    texts = scanned.where(F.size("base") > 0).groupBy("th").agg(F.count("*").alias("n"), F.first(F.struct("text", "base")).alias("f")).select("th", "n", "f.*")
    texts = scratch.write(texts, "texts")
    holders = scratch.write(texts.select("th", "n", F.explode(entities(F.col("base"))).alias("entity")), "holders")
    needed = F.when(F.col("entity").startswith("="), support).otherwise(class_support)
    known = holders.groupBy("entity").agg(F.sum("n").alias("n_e"), F.count("*").alias("texts")).withColumn("needed", needed).where("texts >= needed").drop("texts")
    held = _terms(texts, "th").select("th", "term").distinct()
    pairs = holders.join(known, "entity").join(held, "th").groupBy("entity", "term", "n_e", "needed").agg(F.sum("n").alias("n_et"), F.count("*").alias("texts")).where("texts >= needed")
    terms = scanned.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    every = F.lit(float(scanned.count()))
    ratio = F.log2(F.col("n_et") * every / (F.col("n_e") * F.col("n_t"))) / F.log2(every / F.col("n_e"))
    joined = pairs.where(F.col("n_e") < every).join(terms, "term")
    left = F.log2(F.col("n_t") / F.col("n_et"))
    return joined.select("term", ratio.alias("ratio"), left.alias("left")).where((F.col("ratio") >= threshold) & (F.col("left") <= residue)).groupBy("term").agg(F.max("ratio").alias("ratio"))


def disclosures(docs: DataFrame, threshold: float = 0.8, residue: float = 1.0, support: int = 3, class_support: int = 10, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per row: doc_id, base (identifier spans), terms (array of start, end, ratio)[, text]."""
    scratch = Scratch(docs.sparkSession, "pii")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), F.lower))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumns({"base": identifiers(F.col("text")), "uid": F.monotonically_increasing_id(), "th": F.xxhash64("text"), "terms": words})
    scanned = scratch.write(rows, "scanned")
    telling = scratch.write(_disclosing(scanned, scratch, threshold, residue, support, class_support), "telling")
    hits = scanned.select("uid", F.explode("terms").alias("term")).join(telling, "term")
    marked = scratch.write(hits.groupBy("uid").agg(F.collect_list(F.struct("term", "ratio")).alias("telling")), "marked")  # of one document
    found = scanned.drop("terms").join(marked, "uid", "left").withColumn("terms", F.when(F.col("telling").isNotNull(), term_spans(F.col("text"), F.col("base"), F.col("telling"))).otherwise(F.array().cast(TERMS)))
    return found.select("doc_id", "base", "terms", *(["text"] if with_text else []))


def all_spans(base: Column, terms: Column) -> Column:
    added = F.transform(terms, lambda t: F.struct(t["start"].alias("start"), F.lit(4).alias("kind"), t["end"].alias("end"), F.lit("").alias("value")))
    return F.array_sort(F.concat(base, added.cast(SPAN)))


def sanitise(docs: DataFrame, remove: float = 1.0, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """doc_id and the sanitised text: identifiers become their kind, disclosing terms "[term]" or nothing."""
    found = disclosures(docs, id_col=id_col, text_col=text_col, with_text=True, **settings)
    marks = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    cuts = F.array_sort(F.concat(
        F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), F.get(marks, b["kind"]).alias("put"))),
        F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(t["ratio"] >= remove, F.lit("")).otherwise(F.lit("[term]")).alias("put"))),
    ))
    first = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, c: Column) -> Column:
        fresh = c["start"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], F.substr(F.col("text"), acc["at"] + 1, c["start"] - acc["at"]), c["put"])).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.greatest(acc["at"], c["end"]).alias("at"))

    done = let(F.aggregate(cuts, first, step), lambda a: F.concat(a["out"], F.substr(F.col("text"), a["at"] + 1, F.length("text"))))
    return found.select("doc_id", done.alias("text"))
