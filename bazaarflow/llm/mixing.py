"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words. Inside a source, a document's expected number of copies grows with its
size class and is at most ``most_copies``; the whole part of it is taken for certain. The rest is a fixed-size sample
with unequal probabilities: documents are ranked by their random odds divided by their inclusion odds, and taken in that
order while they fit into the words left. A document that does not fit is passed over, and the order goes on with those that do,
until less than ``NEAR`` of the target is missing or nothing fits. Where what is left is too long then, documents that are short enough get
one copy more in the same way, never above the bound. The random number is a hash of the document, so reruns agree.

A cut in the ranking is found without sorting a source: words are summed by narrow bins of the rank, then only the bin
that holds the cut is ranked, about a thousand documents for any size of source. What is passed over at one cut leaves less than one
document missing, so a few cuts do, and after the first one only sources take part of which one document is more than ``NEAR``.
At the end the one document left whose words come nearest to what is missing is added if that brings the source nearer.

Defined cases: a null or empty text has size 0 and is never taken; null is a source of its own, the last one; documents
that agree in id and text share one random number and are taken together or not; columns named as the output's are replaced,
other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .frames import row_key, stored

# A word, and the weights that sources get in turn.
WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
SOURCE = ["s0", "s1"]
OUTPUT = ["size", "source_size", "target", "copies"]
# Share of a target that may be missing before the search for documents that fit ends.
NEAR = 0.001


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def lean(size: Column) -> Column:
    """How much more often than the smallest documents one of this size is taken: 1 to about 2, by powers of two."""
    return 1.0 + F.floor(F.log2(1.0 + size)) / 16.0


def _ranked(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Columns s0, s1 (the source as a key), size, lean and the random odds of each row, and the row itself as a struct."""
    source = F.col(f"`{source_col}`").cast("string")
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(3), *row_key(id_col, text_col)), 11) + 0.5) / float(1 << 53)
    out = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in OUTPUT]).alias("row"),
        source.isNull().cast("int").alias("s0"),
        F.coalesce(source, F.lit("")).alias("s1"),
        word_count(F.col(f"`{text_col}`").cast("string")).alias("size"),
        (u / (1 - u)).alias("odds"),
    )
    return out.withColumn("lean", lean(F.col("size")))


def targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """``sources`` (s0, s1, source_size) with their targets.

    A target is weight times level, or ``most`` times the size if that is less. Sources that reach their bound come first
    in the order of bound by weight, so the level follows from running sums over that order; one row per source.
    """
    # fmt: off
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), ((F.row_number().over(W.orderBy("s0", "s1")) - 1) % len(WEIGHTS) + 1).cast("int"))
    # fmt: on
    bounded = sources.withColumn("weight", weight).withColumn("bound", F.col("source_size") * float(most))
    ratio = F.col("bound") / F.col("weight")
    order = W.orderBy("ratio", "s0", "s1")
    every, before = W.partitionBy(F.lit(0)), order.rowsBetween(W.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) * float(share) - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levels = bounded.withColumn("ratio", ratio).withColumn("level", level)
    # The first level in the order that fits its own source is the one for all that follow.
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "s0", "s1", "level"))
    reached = levels.withColumn("level", F.min(fits).over(every)["level"])
    target = F.least(F.coalesce(F.col("weight") * F.col("level"), F.col("bound")), F.col("bound"))
    return reached.select(*SOURCE, "source_size", "n_docs", target.alias("target"))


def _copies(rate: Column, most: float) -> Column:
    return F.least(F.lit(float(most)), rate * F.col("lean"))


def plan(ranked: DataFrame, share: float, most: float) -> DataFrame:
    """One row per source: source_size, target, rate (expected copies by lean) and cut (rank of the last one taken)."""
    classes = ranked.groupBy(*SOURCE, "lean").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    classes = stored(classes, "size-classes")
    goals = targets(classes.groupBy(*SOURCE).agg(F.sum("words").alias("source_size"), F.sum("n").alias("n_docs")), share, most)
    goals = stored(goals, "targets")
    # Large documents reach ``most`` copies first; the rate follows from running sums over the classes of a source.
    order = W.partitionBy(*SOURCE).orderBy(F.desc("lean"))
    before, every = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy(*SOURCE)
    weighed = F.col("lean") * F.col("words")
    left = F.col("target") - float(most) * F.coalesce(F.sum("words").over(before), F.lit(0))
    over = F.sum(weighed).over(every) - F.coalesce(F.sum(weighed).over(before), F.lit(0.0))
    rate = F.when(over > 0, F.greatest(left, F.lit(0.0)) / over)
    rates = classes.join(goals, SOURCE).select(*SOURCE, "lean", rate.alias("rate")).filter(F.col("rate") * F.col("lean") <= float(most))
    rates = rates.groupBy(*SOURCE).agg(F.max_by("rate", "lean").alias("rate"))
    # Where no rate fits, every document is taken ``most`` times.
    rates = goals.join(rates, SOURCE, "left").withColumn("rate", F.coalesce("rate", F.lit(float(most))))
    rates = stored(rates.withColumn("bins", F.ceil(F.col("n_docs") / 1000)), "rates")
    # What is left for the sample, from the same sums for any order of the rows: whole copies are whole words.
    whole = ranked.select(*SOURCE, "size", "lean").join(rates.select(*SOURCE, "rate"), SOURCE)
    whole = whole.groupBy(*SOURCE).agg(F.sum(F.floor(_copies(F.col("rate"), most)) * F.col("size")).alias("whole"))
    rates = stored(rates.join(whole, SOURCE).withColumn("missing", F.col("target") - F.col("whole")), "rests")
    rated = rank(ranked.join(rates.select(*SOURCE, "rate", "bins"), SOURCE), most)
    first = rated.filter("rank is not null and size > 0").select(*SOURCE, "size", "rank", "bins")
    plan_ = _with_steps(rates, "steps", first, rates.select(*SOURCE, "target", "missing"))
    # Where all that is left is too long, another copy of documents that are short enough, in a random order.
    again = _copied(rank(ranked.join(plan_.filter(F.col("missing") > NEAR * F.col("target")), SOURCE), most), most)
    again = again.filter((F.col("copies") < most) & (F.col("size") > 0)).select(*SOURCE, "size", F.col("odds").alias("rank"), "bins")
    plan_ = _with_steps(plan_, "more", again, plan_.select(*SOURCE, "target", "missing"))
    # The one copy more that brings a source nearest.
    spare = _copied(rank(ranked.join(plan_.filter("missing > 0"), SOURCE), most), most).filter(F.col("copies") < most)
    error = F.abs(F.col("size") - F.col("missing"))
    spare = spare.filter(error < F.col("missing")).groupBy(*SOURCE, "odds").agg(F.min(error).alias("error"), F.count("*").alias("n"))
    spare = spare.filter("n = 1").groupBy(*SOURCE).agg(F.min_by("odds", F.struct("error", "odds")).alias("last"))
    return stored(plan_.join(spare, SOURCE, "left"), "mix-plan")


def _with_steps(plan_: DataFrame, name: str, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``plan_`` with the steps at which ``rows`` (size, rank) are taken in the order of rank, and what is missing after them."""
    place = F.least(F.floor(F.col("rank") / (1 + F.col("rank")) * F.col("bins")), F.col("bins") - 1)
    rows = rows.withColumn("bin", place).drop("bins")
    open_ = wanted.filter(F.col("missing") > NEAR * F.col("target")).withColumn("after", F.lit(0.0))
    steps = done = None
    while not open_.isEmpty():
        now = stored(open_, "mix-open")
        fits = rows.join(now, SOURCE).filter("rank > after and size <= missing").select(*SOURCE, "size", "rank", "bin")
        # After the first cut a few documents of few sources are left.
        rows = stored(fits, "mix-left")
        cut = stored(now.join(_cut(rows, now), SOURCE, "left"), "mix-cut")
        step = cut.filter("upto is not null").select(*SOURCE, F.struct("after", "upto", F.col("missing").alias("most")).alias("step"))
        steps = step if steps is None else steps.unionByName(step)
        left = cut.select(*SOURCE, "target", (F.col("missing") - F.coalesce("got", F.lit(0))).alias("missing"), "misfit")
        goes_on = F.col("misfit").isNotNull() & (F.col("missing") > NEAR * F.col("target"))
        ended = left.filter(~goes_on).select(*SOURCE, F.col("missing").alias("still"))
        done = ended if done is None else done.unionByName(ended)
        open_ = left.filter(goes_on).select(*SOURCE, "target", "missing", F.col("misfit").alias("after"))
    if steps is None:
        return plan_.withColumn(name, F.lit(None).cast("array<struct<after:double,upto:double,most:double>>"))
    found = plan_.join(steps.groupBy(*SOURCE).agg(F.collect_list("step").alias(name)), SOURCE, "left").join(done, SOURCE, "left")
    return stored(found.withColumn("missing", F.coalesce("still", "missing")).drop("still"), "mix-steps")


def _cut(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source the rank up to which ``rows`` fit into ``missing``, their words, and the rank of the first that does not fit.

    Rows of equal rank count as one.
    """
    bins = rows.groupBy(*SOURCE, "bin").agg(F.sum("size").alias("words"), F.max("rank").alias("top"))
    sofar = W.partitionBy(*SOURCE).orderBy("bin")
    before = sofar.rowsBetween(W.unboundedPreceding, -1)
    bins = bins.withColumns(
        {"upto": F.sum("words").over(sofar), "base": F.coalesce(F.sum("words").over(before), F.lit(0)), "below": F.max("top").over(before)}
    ).join(wanted.select(*SOURCE, "missing"), SOURCE)
    edge = bins.filter((F.col("upto") > F.col("missing")) & (F.col("base") <= F.col("missing")))
    whole = bins.groupBy(*SOURCE).agg(F.max("upto").alias("all"), F.max("top").alias("end"))
    near = rows.join(edge.select(*SOURCE, "bin", "missing", "base"), [*SOURCE, "bin"])
    ranked = W.partitionBy(*SOURCE).orderBy("rank").rangeBetween(W.unboundedPreceding, 0)
    near = near.withColumn("sum", F.col("base") + F.sum("size").over(ranked))
    fits = F.col("sum") <= F.col("missing")
    near = near.groupBy(*SOURCE).agg(
        F.max(F.when(fits, F.col("rank"))).alias("in_bin"), F.max(F.when(fits, F.col("sum"))).alias("sum"), F.min(F.when(~fits, F.col("rank"))).alias("misfit")
    )
    out = whole.join(edge.select(*SOURCE, "base", "below"), SOURCE, "left").join(near, SOURCE, "left")
    upto = F.when(F.col("misfit").isNull(), F.col("end")).otherwise(F.coalesce("in_bin", "below"))
    got = F.when(F.col("misfit").isNull(), F.col("all")).otherwise(F.coalesce("sum", "base"))
    return out.select(*SOURCE, upto.alias("upto"), got.alias("got"), "misfit")


def _taken(steps: str, order: str) -> Column:
    """Whether a document is taken at one of the steps of its source, each for documents up to what was missing."""
    at = lambda s: (F.col(order) > s["after"]) & (F.col(order) <= s["upto"]) & (F.col("size") <= s["most"])
    return F.coalesce(F.exists(steps, at) & F.col(order).isNotNull(), F.lit(False)) & (F.col("size") > 0)


def _copied(rated: DataFrame, most: float) -> DataFrame:
    """Rows of ``rank`` with ``copies`` so far: whole ones, the sample's, and those of the steps that ``rated`` already has."""
    out = rated.withColumn("copies", F.col("whole") + F.when(_taken("steps", "rank"), 1).otherwise(0))
    if "more" in rated.columns:
        out = out.withColumn("copies", F.col("copies") + F.when((F.col("copies") < most) & _taken("more", "odds"), 1).otherwise(0))
    if "last" in rated.columns:
        out = out.withColumn("copies", F.col("copies") + F.when((F.col("copies") < most) & F.coalesce(F.col("odds") == F.col("last"), F.lit(False)), 1).otherwise(0))
    return out


def rank(rated: DataFrame, most: float) -> DataFrame:
    """Whole copies, and the rank of a document that may get one more: its random odds over its inclusion odds."""
    copies = _copies(F.col("rate"), most)
    part = copies - F.floor(copies)
    rank_of = F.when(part > 0, F.col("odds") * (1 - part) / part)
    return rated.withColumn("whole", F.floor(copies)).withColumn("rank", rank_of)


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = 1.5,
    most_copies: int = 2,
) -> DataFrame:
    """``docs`` with size, source_size, target and copies (0 to ``most_copies``) of each row."""
    ranked = _ranked(docs, id_col, text_col, source_col)
    sources = plan(stored(ranked.select(*SOURCE, "size", "odds", "lean"), "sizes"), share, most_copies)
    found = _copied(rank(ranked.join(sources.select(*SOURCE, "source_size", "target", "rate", "steps", "more", "last"), SOURCE), most_copies), most_copies)
    copies = F.when(F.col("size") > 0, F.col("copies")).otherwise(0)
    return found.select("row.*", "size", "source_size", "target", copies.cast("int").alias("copies"))
