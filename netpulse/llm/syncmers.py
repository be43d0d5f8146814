"""Document fingerprints from closed syncmers over words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netpulse.llm.common import long_array, position_in

#: Words in a k-mer and in the inner substrings of which the least must lie at an edge.
K, S = 8, 2
#: Intervals of doc_id per shuffle partition; several to a task even out their sizes.
INTERVALS_PER_PARTITION = 8
#: Bounds of intervals that the driver holds at most.
MAX_INTERVALS = 20_000


def anchors(text: Column) -> Column:
    """Distinct anchors of a text in order of first place, as bigint below 2 ** 32.

    A run of K words is an anchor when the least of its K - S + 1 inner runs of S words, by hash, is
    its first or last. That depends on the run alone, so an edit changes only the anchors that touch
    it. A text without such a run has its run of least hash as its anchor, one of fewer than K words
    the hash of all of them; only texts without words have none.
    """
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return _anchors_of(hashes)


def _anchors_of(hashes: Column) -> Column:
    # an array of one element binds the value: higher-order functions evaluate their argument once
    def chosen(h: Column) -> Column:
        inner = F.zip_with(h, F.slice(h, F.lit(2), F.greatest(F.size(h) - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))

        def runs(m: Column) -> Column:
            last = K - S
            edge = F.filter(
                F.sequence(F.lit(1), F.size(h) - K + 1),
                lambda i: F.array_min(F.slice(m, i, F.lit(last + 1))).isin(
                    F.get(m, i - 1), F.get(m, i - 1 + last)
                ),
            )
            run = lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(h, i, F.lit(K))), 32)
            every = F.transform(F.sequence(F.lit(1), F.size(h) - K + 1), run)
            least = lambda found: F.when(F.size(found) > 0, found).otherwise(F.array(F.array_min(every)))
            return F.flatten(F.transform(F.array(F.transform(edge, run)), least))

        several = F.flatten(F.transform(F.array(inner), runs))
        one = F.array(F.shiftrightunsigned(F.xxhash64(h), 32))
        return F.when(F.size(h) >= K, several).when(F.size(h) > 0, one).otherwise(F.expr("cast(array() as array<bigint>)"))

    return F.array_distinct(F.flatten(F.transform(F.array(hashes), chosen)))


def fingerprint_text(found: Column) -> Column:
    """Eight lowercase hex digits per anchor, in order."""
    return F.lower(F.array_join(F.transform(found, lambda a: F.lpad(F.hex(a), 8, "0")), ""))


def likeness(left: Column, right: Column) -> Column:
    """Jaccard similarity of two anchor sets; 1 for two empty ones, which only texts without words have."""
    both = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - both
    return F.when(either > 0, both / either).otherwise(1.0).cast("double")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, found, next_text, next_found: each document beside the next one by descending doc_id.

    The order is cut into intervals of about equally many ids (the bounds are a sketch's quantiles,
    a bounded list). Every text is shuffled once, to the interval of its id; the first document of an
    interval also goes to the interval before it, whose last document it follows. The document after
    the last is the first. Null ids come last; rows that share an id follow in order of text.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = min(MAX_INTERVALS, INTERVALS_PER_PARTITION * partitions)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n).alias("cuts")).first()["cuts"]
    bounds = sorted(set(cuts or []))
    interval = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(position_in(bounds, F.col("doc_id")) + 1)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), interval.alias("interval"))
    heads = {r.interval: r.head for r in rows.groupBy("interval").agg(F.max("doc_id").alias("head")).collect()}
    filled = sorted(heads)
    above = {i: filled[(k + 1) % len(filled)] for k, i in enumerate(filled)}
    every = range(len(bounds) + 2)
    head_of = F.get(long_array([heads.get(i) or 0 for i in every]), F.col("interval"))
    goes_to = F.get(long_array([above.get(i, 0) for i in every]), F.col("interval")).cast("int")
    first = F.when(F.col("interval") == 0, F.col("doc_id").isNull()).otherwise(F.col("doc_id") == head_of)
    at, guest = F.col("interval").alias("interval"), F.lit(True).alias("guest")
    own = F.struct(at, F.lit(False).alias("guest"))
    places = F.when(first, F.array(own, F.struct(goes_to.alias("interval"), guest))).otherwise(F.array(own))
    sent = rows.select("doc_id", "text", F.explode(places).alias("place")).select("doc_id", "text", "place.*")
    dealt = sent.repartition(partitions, "interval").withColumn("found", anchors(F.col("text")))
    order = Window.partitionBy("interval").orderBy("guest", F.desc_nulls_last("doc_id"), "text")
    following = dealt.withColumns(
        {"next_text": F.lead("text").over(order), "next_found": F.lead("found").over(order)}
    )
    return following.where("NOT guest").drop("guest", "interval")


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by the first as many of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row.

    A null text is empty. Extra columns are ignored; an empty table gives no rows.
    """
    changed = with_next(docs).select(
        "doc_id", "found", "next_found", F.length("text").cast("bigint").alias("n_chars"),
        edited(F.col("text"), F.col("next_text")).alias("changed"),
    )
    both = changed.withColumn("changed_found", anchors(F.col("changed")))
    return both.select(
        "doc_id", "n_chars", F.sha2(F.col("changed").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_text(F.col("found")).alias("fingerprint"),
        fingerprint_text(F.col("changed_found")).alias("edited_fingerprint"),
        likeness(F.col("found"), F.col("changed_found")).alias("near_edited"),
        likeness(F.col("found"), F.col("next_found")).alias("near_next"),
    )
