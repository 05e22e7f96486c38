"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a share of the token budget by weight, stopped at a limit
of epochs and the excess reshared. A document's key is exponential with its
quality weight as rate. A source takes complete epochs of all its documents
first; the rest of its target goes to the documents with the smallest keys,
up to the point where the running sum of sizes meets the rest.

That point is found without sorting a source in one task: sizes are summed
by key bucket, and only the bucket that the point lies in is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regline.llm.common import WORD, free_name, text_or_empty, written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Size of the mix as a share of all sizes.
BUDGET_SHARE = 1.5
#: No source is taken more often than this.
MAX_EPOCHS = 2
#: Key buckets of a source.
BUCKETS = 4096
SEED = "mixing"
NOT_CLEAN = "#*$%&|<>@^~\\{}[]_=+`!"


def size_in_words(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("bigint")


def quality_weight(text: Column) -> Column:
    """Between 0.05 and 1.05: falls steeply with the share of symbols in the text."""
    whole = text_or_empty(text)
    clean = F.length(F.translate(whole, NOT_CLEAN, "")) / F.greatest(F.length(whole), F.lit(1))
    return F.when(whole == "", F.lit(1.05)).otherwise(F.pow(clean, 8) + 0.05)


def sampling_key(ident: Column, text: Column, weight: Column) -> Column:
    """Exponential with rate ``weight``; the uniform number under it is a hash of id and text."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), ident, text_or_empty(text)), 11) + 1) / float(1 << 53)
    return -F.log(uniform) / weight


def ranked(sources: DataFrame) -> DataFrame:
    """Add ``place``, 0 for the smallest ``source`` in code point order, null last; no task sorts them all."""
    spark = sources.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("source").asc_nulls_last()
    dealt = written(sources.repartitionByRange(tasks, order).withColumn("part", F.spark_partition_id()), "sources")
    parts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = parts.select(
        "part", (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("base")
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return dealt.join(before, "part").withColumn("place", F.col("base") + inside).drop("part", "base")


def with_targets(
    sources: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    budget_share: float = BUDGET_SHARE,
    max_epochs: float = MAX_EPOCHS,
) -> DataFrame:
    """``(source, source_size)`` -> the same with ``target``.

    Level by level: every source whose share is above its limit stops there,
    and what is left is shared by weight among the others. Only the level and
    two sums pass through the driver.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * float(max_epochs)
    known = written(ranked(sources).select("source", "source_size", weight.alias("weight"), limit.alias("limit")), "weights")
    total = (known.agg(F.sum("source_size")).first()[0] or 0) * budget_share
    level, stopped = 0.0, -1
    while True:
        full = F.col("limit") <= level * F.col("weight")
        now, taken, rest = known.agg(
            F.count_if(full), F.sum(F.when(full, F.col("limit"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if now == stopped or not rest:
            break
        level, stopped = (total - (taken or 0.0)) / rest, now
    return known.select("source", "source_size", F.least(F.col("limit"), F.col("weight") * level).alias("target"))


def key_bucket(key: Column) -> Column:
    """Rises with the key."""
    return F.least(F.floor((1 - F.exp(-key)) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")


def plan(rows: DataFrame, **shares) -> DataFrame:
    """``(source, size, key)`` rows -> per source ``source_size, target, epochs, last_bucket, last_key``.

    A row is taken ``epochs`` times, and once more if its key's bucket is at
    most ``last_bucket`` or its key at most ``last_key`` (null: no row). The last row taken is the one whose middle
    the rest of the target reaches, so the words taken differ from the target
    by at most half a document, or by the copies that share one key.
    """
    rows = rows.withColumn("bucket", key_bucket(F.col("key")))
    sums = written(rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")), "buckets")
    sources = sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = with_targets(sources, **shares).withColumn("epochs", epochs.cast("int"))
    targets = written(targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")

    # The bucket in which the running sum passes the rest: at most one per source.
    so_far = F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    running = sums.withColumn("after", so_far).withColumn("before", F.col("after") - F.col("bucket_size"))
    met = running.withColumnsRenamed({"source": "of", "bucket": "at"}).join(targets, F.col("of").eqNullSafe(F.col("source")))
    crossing = written(
        met.where("before < rest AND rest < after").select("of", "at", "before", "rest"), "crossing"
    )
    inside = rows.join(crossing, F.col("of").eqNullSafe(F.col("source")) & (F.col("at") == F.col("bucket")))
    in_order = Window.partitionBy("of").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("before") + F.sum("size").over(in_order) - F.col("size") / 2
    last_inside = inside.withColumn("middle", middle).where("middle <= rest").groupBy("of").agg(F.max("key").alias("last_key"))
    # Buckets that end before it are taken whole.
    whole = met.where("rest > 0 AND after <= rest").groupBy("of").agg(F.max("at").alias("last_bucket"))
    last = whole.withColumnRenamed("of", "of_whole").join(
        last_inside, F.col("of").eqNullSafe(F.col("of_whole")), "full"
    ).select(F.coalesce("of", "of_whole").alias("of"), "last_bucket", "last_key")
    found = targets.join(last, F.col("of").eqNullSafe(F.col("source")), "left")
    return written(found.select("source", "source_size", "target", "epochs", "last_bucket", "last_key"), "mix-plan")


def with_plan(rows: DataFrame, planned: DataFrame, source_col: str, key: Column, names: dict[str, str]) -> DataFrame:
    """Join rows with their source's plan (one row per source; broadcast only if Spark finds it small) and add the copies."""
    plan_of = planned.select(*[F.col(c).alias(names[c]) for c in planned.columns])
    joined = rows.join(plan_of, rows[source_col].eqNullSafe(plan_of[names["source"]]))
    in_whole = F.coalesce(key_bucket(key) <= F.col(names["last_bucket"]), F.lit(False))
    once_more = (in_whole | F.coalesce(key <= F.col(names["last_key"]), F.lit(False))).cast("int")
    return joined.withColumn(names["copies"], F.col(names["epochs"]) + once_more)


def mixed_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **shares) -> DataFrame:
    """One row per document: ``id, size, source_size, target, taken``, sizes in words, repeats counted.

    Null and empty texts have size 0. Null is a source of its own, last in
    order. Rows equal in id and text share a key and are taken alike. A
    source without words has target 0. No documents give no rows.
    """
    text = F.col(text_col)
    rows = written(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").alias("source"),
            size_in_words(text).alias("size"),
            sampling_key(F.col(id_col), text, quality_weight(text)).alias("key"),
        ),
        "sizes",
    )
    names = {c: f"p_{c}" for c in ("source", "source_size", "target", "epochs", "last_bucket", "last_key", "copies")}
    judged = with_plan(rows, plan(rows.drop("id"), **shares), "source", F.col("key"), names)
    return judged.select(
        "id",
        "size",
        F.col("p_source_size").alias("source_size"),
        F.col("p_target").alias("target"),
        (F.col("size") * F.col("p_copies")).alias("taken"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **shares) -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as it is taken, with its own columns."""
    text = F.col(text_col)
    key = sampling_key(F.col(id_col), text, quality_weight(text))
    source = F.col(source_col).cast("string")
    rows = docs.select(source.alias("source"), size_in_words(text).alias("size"), key.alias("key"))
    planned = plan(written(rows, "sizes"), **shares)
    wanted = ("source", "source_size", "target", "epochs", "last_bucket", "last_key", "copies", "key", "own", "copy")
    names = {c: free_name(docs, f"mix_{c}") for c in wanted}
    keyed = docs.withColumns({names["own"]: source, names["key"]: key})
    judged = with_plan(keyed, planned, names["own"], F.col(names["key"]), names)
    copies = F.explode(F.array_repeat(F.lit(1), F.col(names["copies"])))
    return judged.select(*docs.columns, copies.alias(names["copy"])).select(*docs.columns)
