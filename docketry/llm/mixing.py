"""Mixing sources to target weights by Poisson replication, DataFrame functions only.

A source's mean repetition rate is its target share of all characters over its present share. Each document
draws a count from a Poisson distribution with that mean by inversion: the uniform number is taken from a
hash of seed, id and text, so a retried task draws the same, and the count is the number of cumulative
probabilities below it. The cumulative table is made once per source, each probability from its own logarithm (so no
rate is too large for it), over the counts within 12 standard deviations and 20 of the mean. Copies are exploded and shuffled
globally: a second hash of the copy deals it to a partition and orders it there, so equal documents part, no
key is hot, and no sampling pass is needed.

Targets: a weight per source (missing ones keep their present share, all are normalised); without targets,
shares are tempered: proportional to (characters of the source) ** `temper`.

Edge cases: a null source is a source; a null text has no characters and draws like any other of its source; a
source without characters keeps rate 1 and one of weight 0 goes; a column of `docs` named like an added one gives way to it; repeated rows draw the same count (their copies are numbered alike);
empty tables give empty results; the columns of `docs` pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import Scratch

UNIT = float(1 << 48)


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the first 48 bits of an MD5; any engine with MD5 can repeat it."""
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(UNIT)


def log_factorial(k: Column) -> Column:
    """ln k!; beyond 20 by Stirling's series, whose error there is below 1e-12."""
    x = k + 1.0
    series = (x - 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return F.when(k <= 20, F.ln(F.factorial(F.least(k, F.lit(20))).cast("double"))).otherwise(series)


def source_rates(docs: DataFrame, targets: dict[str, float] | None, temper: float, source: Column, text: Column, scratch: Scratch) -> DataFrame:
    """(src, rate, first, cdf): one row per source; cdf holds the cumulative Poisson probabilities from the count `first` on."""
    sizes = docs.groupBy(source.alias("src")).agg(F.sum(F.coalesce(F.length(text), F.lit(0)).cast("long")).alias("chars"))
    sizes = scratch.write(sizes, "sizes")
    every = float(sizes.agg(F.sum("chars")).first()[0] or 0) or 1.0
    if targets:
        known = F.create_map(*[F.lit(x) for kv in targets.items() for x in kv])
        sizes = sizes.withColumn("weight", F.coalesce(known[F.col("src")].cast("double"), F.col("chars") / F.lit(every)))
    else:
        sizes = sizes.withColumn("weight", F.pow(F.col("chars").cast("double"), F.lit(float(temper))))
    weights = float(sizes.agg(F.sum("weight")).first()[0] or 0) or 1.0
    rates = sizes.withColumn("rate", F.when(F.col("chars") > 0, F.col("weight") / F.lit(weights) * F.lit(every) / F.col("chars")).otherwise(F.lit(1.0)))
    wide = 12 * F.sqrt("rate") + 20
    rates = rates.withColumns({"first": F.greatest(F.lit(0), F.floor(F.col("rate") - wide)).cast("int"), "most": F.ceil(F.col("rate") + wide).cast("int")})
    chance = lambda k: F.exp(k * F.ln("rate") - F.col("rate") - log_factorial(k))
    each = F.when(F.col("rate") > 0, F.transform(F.sequence("first", "most"), chance)).otherwise(F.array(F.lit(1.0)))
    summed = F.aggregate(each, F.array().cast("array<double>"), lambda a, p: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0.0)) + p)))
    return rates.select("src", "rate", "first", summed.alias("cdf"))


def mix_sources(docs: DataFrame, targets: dict[str, float] | None = None, temper: float = 0.5, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", details: bool = True) -> DataFrame:
    """`docs` with each row repeated by its draw, globally shuffled; details adds copy (from 1), rate and shuffle_key."""
    scratch = Scratch(docs.sparkSession, "mixing")
    text, source = F.col(text_col).cast("string"), F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    named = {f"={k}": v for k, v in targets.items()} if targets else None
    rates = scratch.write(source_rates(docs, named, temper, source, text, scratch), "rates")
    key = F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), source.alias("src"), key.alias("_key"))
    drawn = packed.join(rates, "src").withColumn("_u", uniform(F.lit(str(seed)), F.col("_key"))).withColumn("_n", F.size(F.filter("cdf", lambda c: c < F.col("_u"))))
    drawn = drawn.withColumn("_n", F.when(F.col("rate") > 0, F.col("first") + F.col("_n")).otherwise(0))
    copies = drawn.where("_n > 0").select("_row", "_key", "rate", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy"))
    copies = copies.withColumn("shuffle_key", uniform(F.lit(f"{seed}:order"), F.col("_key"), F.col("copy").cast("string")))
    dealt = copies.repartition("shuffle_key", "copy").sortWithinPartitions("shuffle_key", "copy")
    added = ["copy", "rate", "shuffle_key"] if details else []
    return dealt.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in added], *added)
