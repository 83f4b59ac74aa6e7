"""Mixing sources to target word counts by entropy balancing.

Sources get weights and share a budget of words; a target never exceeds twice its source's
size (the excess is shared anew by weight). Document rates are the ones closest in relative
entropy to 1 that give every source its target: min(2, exp(lambda * size / mean size)), with
one lambda per source. The convex dual is solved by distributed Newton steps, kept inside a
bracket, over the table (source, size, documents), which the documents are counted into
once. Rates are then rounded to 0, 1 or 2 copies by a hash of the row; the words that this
rounding leaves over or short per source are taken back in a few passes that add or drop
one copy of documents in hash order, none larger than what is left.

Only DataFrame functions run. Joins by source are left to Spark: the per-source tables are
written first, so their size is known; a hot source is counted map-side and its rows are
never gathered. Defined results: a NULL source is a source of its own, last in order; a
document without words takes nothing; repeated rows are rounded alike; without words at all
every target is 0; an empty table gives an empty result; other columns are kept by
:func:`mix` and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlens.llm.tables import table
from demandlens.operators.joins import bounded_broadcast
from demandlens.session import materialize

# Fixed values of the mix: weights by source order, budget share, most copies.
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2

NEWTON_STEPS = 40
TOLERANCE = 1e-7
PASSES = 5


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _key(source: Column) -> Column:
    """The source as a join key without NULL."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """(key, source_size, target) per source of ``sizes`` (source, size).

    The windows run over one row per source: targets are proportional to the weights up to
    the caps, so the capped sources are a prefix in the order of cap / weight."""
    by_source = sizes.groupBy(_key(F.col("source")).alias("key"), "source").agg(F.sum("size").alias("source_size"), F.max("size").alias("largest"))
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1
    s = by_source.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place)).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    s = s.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(budget)))
    order = Window.orderBy(F.col("cap") / F.col("w"), "key")
    s = s.withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("from_here", F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    s = s.withColumn("full", F.col("cap") * F.col("from_here") <= (F.col("budget") - F.col("before")) * F.col("w"))
    left = F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything)
    free = F.sum(F.when(~F.col("full"), F.col("w")).otherwise(0.0)).over(everything)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least(left * F.col("w") / F.when(free > 0, free), F.col("cap")))
    return s.select("key", F.col("source_size").cast("bigint").alias("source_size"), target.alias("target"))


def solve_rates(sizes: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """``targets`` with ``mean`` and ``lam`` per source: sum of size * min(most, exp(lam *
    size / mean)) over the source's documents is the target."""
    counted = materialize(sizes.where("size > 0").groupBy(_key(F.col("source")).alias("key"), "size").agg(F.count(F.lit(1)).cast("double").alias("n")), "mix_sizes")
    moments = counted.groupBy("key").agg(
        (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"),
        F.min("size").alias("least"),
        F.sum(F.col("n") * F.col("size") * F.col("size")).alias("squares"),
    )
    top = F.log(F.lit(float(most))) * F.col("mean") / F.col("least")  # every document at the most
    ratio = F.log(F.greatest(F.col("target"), F.lit(1e-300)) / F.col("source_size"))
    state = targets.where("source_size > 0").join(moments, "key").select(
        "key", "target", "source_size", "mean",
        F.when(F.col("target") < F.col("source_size"), ratio * F.col("mean") / F.col("least")).otherwise(F.lit(0.0)).alias("lo"),
        F.when(F.col("target") > F.col("source_size"), top).otherwise(F.lit(0.0)).alias("hi"),
        (ratio * F.col("mean") * F.col("source_size") / F.col("squares")).alias("lam"),
        F.lit(None).cast("double").alias("error"),
    )
    state = state.withColumn("lam", F.greatest("lo", F.least("hi", "lam")))
    state = materialize(state, "mix_dual")
    rate = F.least(F.lit(float(most)), F.exp(F.col("lam") * F.col("size") / F.col("mean")))
    words = F.col("n") * F.col("size") * rate
    slope = F.when(rate < most, words * F.col("size") / F.col("mean")).otherwise(0.0)
    for step in range(NEWTON_STEPS):
        moved = counted.join(state, "key").groupBy("key").agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        s = state.drop("error").join(moved, "key")
        s = s.withColumn("gap", F.col("words") - F.col("target"))
        s = s.withColumn("lo", F.when(F.col("gap") <= 0, F.greatest("lo", "lam")).otherwise(F.col("lo")))
        s = s.withColumn("hi", F.when(F.col("gap") >= 0, F.least("hi", "lam")).otherwise(F.col("hi")))
        newton = F.col("lam") - F.col("gap") / F.when(F.col("slope") > 0, F.col("slope"))
        inside = newton.isNotNull() & (newton >= F.col("lo")) & (newton <= F.col("hi"))
        near = F.abs(F.col("gap")) <= TOLERANCE * F.col("target")
        following = F.when(near, F.col("lam")).when(inside, newton).otherwise((F.col("lo") + F.col("hi")) / 2)
        s = s.select("key", "target", "source_size", "mean", "lo", "hi", following.alias("lam"), (F.abs(F.col("gap")) / F.greatest(F.col("target"), F.lit(1.0))).alias("error"))
        state = materialize(s, "mix_dual")
        if step % 2 and (state.agg(F.max("error")).first()[0] or 0.0) <= TOLERANCE:
            break
    else:
        worst = state.agg(F.max("error")).first()[0] or 0.0
        if worst > 1e-3:
            raise RuntimeError(f"rates miss a target by {worst:.1%} after {NEWTON_STEPS} steps")
    return targets.join(state.select("key", "mean", "lam"), "key", "left")


# ------------------------------------------------------------------ rounding
_PASSES = "array<struct<n:int,sign:int,limit:double,level:int>>"


def _uniform(n: Column) -> Column:
    h = F.xxhash64(F.col("_id"), F.col("_size"), F.col("_digest"), F.col("_copy"), n)
    return (F.shiftrightunsigned(h, 11).cast("double") + 0.5) * F.lit(2.0**-53)


def _level(n: Column) -> Column:
    """Documents in hash order by eighths of a power of two: the last levels hold single ones."""
    return F.floor(F.log2(_uniform(n)) * -8).cast("int")


def _may_flip(copies: Column, sign: Column, limit: Column, most: int) -> Column:
    return (F.col("_size") > 0) & (F.col("_size") <= limit) & (copies + sign).between(0, most)


def _copies(most: int) -> Column:
    """Copies of a document of the columns _id, _size, _digest and _copy beside its source's plan."""
    rate = F.when(F.col("_size") > 0, F.least(F.lit(float(most)), F.exp(F.col("lam") * F.col("_size") / F.col("mean")))).otherwise(0.0)
    first = (F.floor(rate) + (_uniform(F.lit(0)) < rate - F.floor(rate)).cast("int")).cast("int")
    flip = lambda c, q: F.when(_may_flip(c, q["sign"], q["limit"], most) & (_level(q["n"]) >= q["level"]), c + q["sign"]).otherwise(c)
    return F.aggregate("passes", first, flip)


def mix_plan(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """One row per source: target, rate parameters and the rounding passes.

    ``sizes`` (see :func:`document_sizes`) should be written: it is read a dozen times."""
    plan = solve_rates(sizes, materialize(source_targets(sizes, weights, budget, most), "mix_targets"), most)
    plan = materialize(plan.withColumn("passes", F.array().cast(_PASSES)), "mix_rates")
    rows = sizes.select(_key(F.col("source")).alias("key"), F.col("doc_id").alias("_id"), F.col("size").alias("_size"), F.col("digest").alias("_digest"), F.col("copy").alias("_copy"))
    taken = rows.join(plan, "key").groupBy("key").agg(F.sum(_copies(most) * F.col("_size")).alias("taken"))
    plan = plan.join(taken, "key").withColumn("left", F.col("target") - F.col("taken")).drop("taken")
    for p in range(1, PASSES + 1):
        # One copy more or less of the first documents in this pass's hash order, as many as fit.
        plan = materialize(plan.withColumn("sign", F.when(F.col("left") >= 0, 1).otherwise(-1)).withColumn("limit", F.abs("left")), "mix_plan")
        can = rows.join(plan, "key").withColumn("copies", _copies(most)).where(_may_flip(F.col("copies"), F.col("sign"), F.col("limit"), most))
        by_level = can.groupBy("key", _level(F.lit(p)).alias("level"), "limit").agg(F.sum("_size").alias("words"))
        upto = by_level.withColumn("sum", F.sum("words").over(Window.partitionBy("key").orderBy(F.col("level").desc())))
        chosen = upto.where(F.col("sum") <= F.col("limit")).groupBy("key").agg(F.min("level").alias("level"), F.max("sum").alias("flipped"))
        one = F.struct(F.lit(p).alias("n"), "sign", "limit", F.coalesce("level", F.lit(1 << 20)).alias("level"))
        plan = plan.join(chosen, "key", "left").withColumn("passes", F.concat("passes", F.array(one).cast(_PASSES)))
        plan = plan.withColumn("left", F.col("left") - F.col("sign") * F.coalesce("flipped", F.lit(0))).drop("flipped", "level", "sign", "limit")
    return materialize(plan, "mix_plan")


def document_sizes(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size, digest, copy) of every row: the digest is that of the whole row, equal
    rows are numbered (1..n) as copies, so that no two rows are rounded alike. Rows are
    counted map-side before they are numbered."""
    rows = documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64(F.struct("*")).alias("digest"))
    counted = rows.groupBy("doc_id", "source", "size", "digest").agg(F.count(F.lit(1)).alias("_n"))
    return counted.select("doc_id", "source", "size", "digest", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("copy"))


def with_copies(rows: DataFrame, plan: DataFrame, most: int = MOST) -> DataFrame:
    """(_row, _size, source_size, target, _copies) of rows (_row, _id, _size, _digest, _copy, key)."""
    return rows.join(plan, "key").select("_row", "_size", "source_size", "target", _copies(most).alias("_copies"))


def size_rows(sizes: DataFrame) -> DataFrame:
    """The rows of :func:`document_sizes` as :func:`with_copies` takes them."""
    return sizes.select(
        F.struct("doc_id", "source", "size").alias("_row"), F.col("doc_id").alias("_id"), F.col("size").alias("_size"), F.col("digest").alias("_digest"),
        F.col("copy").alias("_copy"), _key(F.col("source")).alias("key"))


def _numbered(documents: DataFrame, sizes: DataFrame) -> DataFrame:
    """The rows of ``documents`` as :func:`with_copies` takes them. Rows that have no equal are
    number 1; only the others (found by ``sizes``, by digest) meet to be numbered."""
    rows = documents.select(F.struct("*").alias("_row"), F.xxhash64(F.struct("*")).alias("_digest"))
    again = bounded_broadcast(materialize(sizes.where("copy = 2").select(F.col("digest").alias("_digest")).distinct(), "mix_repeated"))
    once = rows.join(again, "_digest", "left_anti").withColumn("_copy", F.lit(1).cast("bigint"))
    more = rows.join(again, "_digest", "left_semi").groupBy("_row", "_digest").agg(F.count(F.lit(1)).alias("_n"))
    more = more.select("_row", "_digest", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_copy"))
    size = word_count(F.col("_row.text")).alias("_size")
    return once.select(*more.columns).union(more).select("_row", F.col("_row.doc_id").alias("_id"), size, "_digest", "_copy", _key(F.col("_row.source")).alias("key"))


def mix(documents: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """The mixed rows of ``documents`` (doc_id, source, text and any other columns): each row
    as often as its copies say."""
    sizes = materialize(document_sizes(documents), "mix_documents")
    rows = with_copies(_numbered(documents, sizes), mix_plan(sizes, weights, budget, most), most)
    return rows.where("_copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).select("_row.*")


def op2_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, beside its size and its source's target."""
    documents = table(spark, sf_dir, "documents")
    sizes = materialize(document_sizes(documents), "mix_documents")
    rows = with_copies(size_rows(sizes), mix_plan(sizes))
    return rows.select("_row.doc_id", "_row.size", "source_size", "target", (F.col("_copies") * F.col("_size")).alias("taken"), F.col("_row.source").alias("source"), F.col("_copies").alias("copies"))
