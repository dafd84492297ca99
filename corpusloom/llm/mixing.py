"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

Sources in order of their code points, NULL last, get the weights in turn. Together they receive `share` times all
words; a source stops at `most` times its own words, and what it leaves goes to the others by weight.

Within a source every document first gets the whole copies that are certain (the target over the source's words,
rounded down). For the rest a sample is drawn: a document has an inclusion probability between f * f and f * (2 - f),
f being the fraction left, higher for longer documents, so that the expected words are exactly the rest of the target.
Documents are ranked by the odds of a keyed uniform number over the odds of inclusion, and are taken in that order
up to the rest of the target, to the nearest document. The number depends on the document's id and the seed only,
so reruns agree.

The running sum of words along the ranking is taken in two steps: sums over ranges of the ranking, about
`range_rows` documents each, then inside each range. So a source with a third of all rows is many groups. The text is
read once; only ids, sources and sizes move.

Defined cases: NULL and empty texts have size 0. A source without words has target 0. Rows with a NULL id draw one number together.
Rows of equal id, source and size are taken together or not at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.store import cut

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixOptions:
    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most: int = 2
    seed: str = "mix"
    range_rows: int = 20_000


def sized(df: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    return df.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"))


def targets(docs: DataFrame, options: MixOptions) -> DataFrame:
    """docs: source, size. `source, source_size, mean, target` for every source."""
    sizes = docs.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.greatest(F.expr("sum(size) div count(1)"), F.lit(1)).alias("mean")
    )
    # One row per source, so ordering all of them is small work; documents never meet in one task.
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(w) for w in options.weights]), F.pmod(order, F.lit(len(options.weights))))
    sources = cut(sizes.withColumn("weight", weight), "sources")
    total = options.share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, full_before = 0.0, -1
    capped = F.lit(False)
    while True:
        n_full, taken, weights = sources.agg(
            F.coalesce(F.sum(F.when(capped, 1)), F.lit(0)),
            F.coalesce(F.sum(F.when(capped, options.most * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)),
        ).first()
        if n_full == full_before or not weights:
            break
        level, full_before = (total - taken) / weights, n_full
        capped = options.most * F.col("source_size") <= F.lit(level) * F.col("weight")
    target = F.least((options.most * F.col("source_size")).cast("double"), F.lit(level) * F.col("weight"))
    return sources.select("source", "source_size", "mean", target.alias("target"))


def _uniform(doc_id: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from 52 bits of a hash."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left rows with the columns of their one right row; NULL keys are equal."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}" if c in keys else c) for c in right.columns])
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, same, "left").drop(*[f"_r_{k}" for k in keys])


def _ranked(units: DataFrame, goals: DataFrame, options: MixOptions) -> DataFrame:
    """units: doc_id, source, size, n. Adds `whole`, the words left for the sample, and the place `rank` in (0, 1)."""
    size, mean = F.col("size"), F.col("mean")
    lean = F.expr("(1000 * size) div (size + mean)")  # integers, so that sums are exact in any order
    known = _joined(units, goals, ["source"]).withColumn("lean", lean)
    leans = known.groupBy("source").agg(
        F.try_divide(F.sum(F.col("n") * size * F.col("lean")).cast("double"), F.sum(F.col("n") * size)).alias("lean_mean")
    )
    known = _joined(known, leans, ["source"])
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    known = known.withColumn("whole", F.floor(ratio)).withColumn("left", ratio - F.floor(ratio))
    f, u = F.col("left"), _uniform(F.col("doc_id"), options.seed)
    inclusion = f + f * (1 - f) * ((F.col("lean") - F.coalesce("lean_mean", F.lit(0.0))) / 1000)
    known = known.withColumn("inclusion", inclusion)
    # Odds of the number over odds of inclusion; times the odds of f, the same for a whole source, to spread them evenly.
    odds = (u / (1 - u)) * ((f / (1 - f)) / (F.col("inclusion") / (1 - F.col("inclusion"))))
    known = known.withColumn("odds", F.when(f > 0, odds))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    return known.withColumn("rank", F.col("odds") / (1 + F.col("odds"))).withColumn("rest", rest)


def copies(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """docs: doc_id, source, size. One row per distinct row, with `source_size`, `target` and `copies`."""
    goals = targets(docs, options)
    units = docs.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    ranges = max(1, -(-docs.count() // options.range_rows))
    ranked = cut(
        _ranked(units, goals, options)
        .withColumn("range", F.least(F.floor(F.col("rank") * ranges), F.lit(ranges - 1)))
        .select("doc_id", "source", "size", "n", "source_size", "target", "whole", "rest", "rank", "range"),
        "ranked",
    )
    words = F.col("n") * F.col("size")
    drawn = ranked.filter("rank is not null")
    sums = drawn.groupBy("source", "range").agg(F.sum(words).alias("in_range"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "range", F.coalesce(F.sum("in_range").over(upto), F.lit(0)).alias("before"))
    inside = (
        Window.partitionBy("source", "range").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("before") + F.coalesce(F.sum(words).over(inside), F.lit(0))
    taken = (2 * before + words <= 2 * F.col("rest")).cast("bigint")
    sampled = _joined(drawn, sums, ["source", "range"]).withColumn("copies", F.col("whole") + taken)
    certain = ranked.filter("rank is null").withColumn("copies", F.col("whole"))
    names = ["doc_id", "source", "size", "source_size", "target", "copies"]
    return sampled.select(names).unionByName(certain.select(names))


def mixed(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """docs: doc_id, source, size. Every row with `source_size`, `target` and `taken`, the words the mix takes of it."""
    docs = cut(docs, "sized")
    found = _joined(docs, copies(docs, options), ["doc_id", "source", "size"])
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def expanded(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", options: MixOptions = MixOptions()
) -> DataFrame:
    """The rows of the mix with the columns of `df`: a document taken twice is two rows."""
    counted = cut(copies(cut(sized(df, doc_id, text, source), "sized"), options).filter("copies > 0"), "copies")
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    renamed = counted.select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "source", "size", "copies")])
    same = (
        F.col(doc_id).eqNullSafe(F.col("_doc_id")) & F.col(source).eqNullSafe(F.col("_source")) & size.eqNullSafe(F.col("_size"))
    )
    again = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return df.join(renamed, same).withColumn("_copy", again).select(*df.columns)
