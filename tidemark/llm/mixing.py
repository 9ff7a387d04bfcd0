"""Mixing sources to target weights by Poisson replication, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Means above this are drawn as sums of independent Poisson numbers, so that exp(-mean) never vanishes.
PART_MEAN = 16.0
#: Beyond so many, a Poisson number of mean PART_MEAN has a tail below the resolution of the uniform numbers.
PART_MOST = 96
#: Sources up to this many are joined by broadcast; beyond, by a shuffle on source and salt.
BROADCAST_SOURCES = 10_000
SALTS = 64


def uniform(seed: str, *keys: Column) -> Column:
    """A uniform number in (0, 1) from the first 52 bits of a SHA-256 over seed and keys."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("~")) for k in keys])
    return (F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def poisson(mean: Column, u: Column) -> Column:
    """The smallest k whose cumulative Poisson probability is above u; mean at most PART_MEAN."""
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"), F.lit(0).cast("long").alias("k"))

    def step(acc: Column, i: Column) -> Column:
        p = acc["p"] * mean / i
        more = u >= acc["cdf"]
        return F.struct(
            F.when(more, p).otherwise(acc["p"]).alias("p"),
            F.when(more, acc["cdf"] + p).otherwise(acc["cdf"]).alias("cdf"),
            F.when(more, i.cast("long")).otherwise(acc["k"]).alias("k"),
        )

    # Enough terms for the mean at hand: the chance of more is below 2^-52.
    terms = F.least(F.lit(PART_MOST), F.ceil(mean * 2 + 10 * F.sqrt(mean) + 24).cast("int"))
    return F.aggregate(F.sequence(F.lit(1), terms), start, step, lambda acc: acc["k"])


def mix(docs: DataFrame, weights: dict[str, float] | None = None, *, total: float | None = None, id_col: str = "doc_id", source_col: str = "source", seed: str = "mix", shuffle: bool = True) -> DataFrame:
    """Repeat each document a Poisson number of times so that sources get their target weights.

    A source's mean rate is its share of the weights times ``total`` (by default the number of documents), divided
    by its own number of documents. ``weights`` None: all sources alike; a source that ``weights`` leaves out gets
    none. Returns ``(row, source, rate, copies, copy, mix_key)``: ``row`` is a struct of the input row, ``copy``
    counts from 0; the rows are dealt out and sorted by the uniform ``mix_key`` of document and copy.

    Null sources are one source of their own, keyed "". Rows with equal ids draw alike. Empty input: empty output.
    """
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    counts = docs.groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        counts = counts.withColumn("weight", F.lit(1.0))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()] or [("", 0.0)], "source string, weight double")
        counts = counts.join(F.broadcast(given), "source", "left").fillna(0.0, ["weight"])  # as long as the argument
    sums = counts.agg(F.sum("n").alias("all_n"), F.sum("weight").alias("all_w"), F.count(F.lit(1)).alias("sources")).first()
    goal, all_w = float(sums["all_n"] or 0) if total is None else float(total), float(sums["all_w"] or 0.0)
    rates = counts.select("source", (F.col("weight") * goal / (F.lit(all_w or 1.0) * F.col("n"))).alias("rate"))
    kept = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), source.alias("source"), F.col(id_col).alias("id"))
    if sums["sources"] <= BROADCAST_SOURCES:
        rated = kept.join(F.broadcast(rates), "source")
    else:
        rated = kept.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))).join(
            rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["source", "salt"]
        )
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_MEAN).cast("int"))
    draws = F.transform(F.sequence(F.lit(1), parts), lambda j: poisson(F.col("rate") / parts, uniform(seed, F.col("id"), j)))
    out = (
        rated.withColumn("copies", F.aggregate(draws, F.lit(0).cast("long"), lambda a, x: a + x))
        .where("copies > 0")
        .select("row", "source", "rate", "copies", "id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
        .withColumn("mix_key", uniform(seed + "-order", F.col("id"), F.col("copy")))
        .select("row", "source", "rate", "copies", "copy", "mix_key", "id")
    )
    if shuffle:
        # Dealt out by the hash of document and copy, and sorted by the uniform key within each part.
        out = out.repartition(F.col("mix_key")).sortWithinPartitions("mix_key", "id", "copy")
    return out.drop("id")
