"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Every source gets a token target: its weighted share of the budget, held at
``cap`` times its size, the excess reshared by weight (water filling). Among
all document rates between 0 and ``cap`` that meet the targets, the ones
nearest to 1 in entropy are exponential tilts: rate = min(cap, exp(lambda *
size / mean size)), with one multiplier per source from the convex dual. Newton
steps, bracketed by bisection, find the multipliers.

A rate depends on (source, size) alone, so the steps run over the histogram of
sizes; each is one join and one aggregate with map-side partial sums, and the
sums are decimals, so reruns agree bit for bit. Rates become copies by
systematic rounding along the sizes of a source (the error of a source's words
stays within its longest document), then single copies are moved where this
brings the source nearer to its target. Within a cell of equal size the
documents with the smallest hash take the odd copies; the hash that divides
them is found by ranks inside hash buckets of bounded size, so that a cell with
a third of all rows is not one group.

Defined edge cases: null text has size 0; null is a source of its own, ranked
last; documents of size 0 take 0 words; without any word all targets are 0;
rows that repeat a doc_id and size share one hash and are told apart by the number
under which they were written, so any number of them meets its target; an empty
table gives an empty result; further columns do not matter.
The distinct (source, size) pairs bound the iterated table, and the number of
sources the one unpartitioned window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD, cut, release, row_key

WEIGHTS = (5.0, 2.0, 1.0)
BUCKET_ROWS = 2_000  # documents of a cell that are ranked together
SALTS = 16  # parts in which the documents of a cell meet its numbers
NEWTON_BLOCK, NEWTON_BLOCKS = 6, 10
TOLERANCE = 1e-7


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _exact(c: Column) -> Column:
    """For sums whose result must not depend on the order of the rows."""
    return c.cast("decimal(30,6)")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """From key, size, n: key, source_size, target, mean (words of a document
    that has any)."""
    totals = sizes.groupBy("key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"),
                                      F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("filled"))
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          ((F.row_number().over(Window.orderBy("key")) - 1) % len(weights) + 1).cast("int"))
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), "key")
    room = F.lit(cap) * F.col("source_size")
    before = F.coalesce(F.sum(room).over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing))
    budget = F.lit(share) * F.sum("source_size").over(Window.partitionBy())
    # words per weight if exactly the sources before this one are held; the true level is the largest
    level = F.max("level").over(Window.partitionBy())
    return (totals.withColumn("weight", weight).withColumn("level", (budget - before) / rest)
            .withColumn("target", F.least(room, level * F.col("weight")))
            .select("key", "source_size", "target",
                    (F.col("source_size") / F.coalesce("filled", F.lit(1))).alias("mean")))


def _rate(cap: float) -> Column:
    return F.least(F.lit(cap), F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0))))


def _newton(sizes: DataFrame, state: DataFrame, cap: float) -> DataFrame:
    """One safeguarded Newton step on log(words(lambda)) = log(target)."""
    raw = F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0)))
    words = F.col("n") * F.col("size")
    slope = F.when(raw < cap, words * raw * F.col("size") / F.col("mean")).otherwise(0.0)
    sums = (sizes.join(state, "key").groupBy("key", "target", "mean", "lam", "lo", "hi")
            .agg(F.sum(_exact(words * F.least(F.lit(cap), raw))).cast("double").alias("f"),
                 F.sum(_exact(slope)).cast("double").alias("g")))
    over = F.col("f") > F.col("target")
    step = F.col("lam") - (F.log("f") - F.log("target")) * F.col("f") / F.col("g")
    lo = F.when(over, F.col("lo")).otherwise(F.col("lam"))
    hi = F.when(over, F.col("lam")).otherwise(F.col("hi"))
    middle = (F.when(F.col("lo1").isNull(), F.col("hi1") - 2 * F.abs("hi1") - 1)
              .when(F.col("hi1").isNull(), F.col("lo1") + 2 * F.abs("lo1") + 1)
              .otherwise((F.col("lo1") + F.col("hi1")) / 2))
    inside = ((F.col("g") > 0) & (F.col("lo1").isNull() | (step > F.col("lo1")))
              & (F.col("hi1").isNull() | (step < F.col("hi1"))))
    error = F.abs(F.col("f") / F.col("target") - 1)
    return (sums.withColumn("lo1", lo).withColumn("hi1", hi)
            .select("key", "target", "mean",
                    F.when(error <= TOLERANCE, F.col("lam")).when(inside, step).otherwise(middle).alias("lam"),
                    F.col("lo1").alias("lo"), F.col("hi1").alias("hi"), error.alias("error")))


def multipliers(sizes: DataFrame, goal: DataFrame, cap: float) -> DataFrame:
    """key, lam: the dual solution; null where the target is the cap itself."""
    null = F.lit(None).cast("double")
    solvable = (F.col("target") > 0) & (F.col("target") < cap * F.col("source_size") * (1 - 1e-12))
    state = (goal.where(solvable).select("key", "target", "mean", F.log(F.col("target") / F.col("source_size")).alias("lam"),
                                         null.alias("lo"), null.alias("hi"), F.lit(1.0).alias("error")))
    for _ in range(NEWTON_BLOCKS):
        for _ in range(NEWTON_BLOCK):
            state = _newton(sizes, state.drop("error"), cap)
        state = cut(state, "mix-multipliers")
        worst = state.agg(F.max("error")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    return state.select("key", "lam")


def cell_copies(sizes: DataFrame, goal: DataFrame, lam: DataFrame, cap: float, moves: int = 4) -> DataFrame:
    """key, size, n, m: the copies that the n documents of a size take together."""
    along = Window.partitionBy("key").orderBy("size")
    source = Window.partitionBy("key")
    top = F.floor(F.lit(cap) * F.col("n"))
    upto = F.sum(F.col("n") * F.col("rate")).over(along)
    cells = (sizes.join(goal, "key").join(lam, "key", "left")
             .withColumn("rate", F.when(F.col("lam").isNull(), F.lit(cap)).otherwise(_rate(cap)).cast("decimal(18,12)"))
             .withColumn("end", F.floor(upto + F.lit(0.5).cast("decimal(2,1)")))
             .withColumn("m", F.least(F.col("end") - F.coalesce(F.lag("end").over(along), F.lit(0)), top)))
    for _ in range(moves):
        gap = F.col("target") - F.col("words")
        up = F.when((F.col("m") < top) & (F.col("size") > 0), F.struct(F.abs(gap - F.col("size")), F.col("size"), F.lit(1)))
        down = F.when((F.col("m") > 0) & (F.col("size") > 0), F.struct(F.abs(gap + F.col("size")), F.col("size"), F.lit(-1)))
        best = F.min(F.least(up, down)).over(source)
        cells = (cells.withColumn("words", F.sum(F.col("m") * F.col("size")).over(source))
                 .withColumn("best", best)
                 .withColumn("m", F.col("m") + F.when((F.col("best.col1") < F.abs(gap)) & (F.col("best.size") == F.col("size")),
                                                      F.col("best.col3")).otherwise(0)))
    return cells.select("key", "size", "n", F.col("m").cast("long").alias("m"))


def _hash() -> Column:
    return F.xxhash64(F.lit("mix"), F.col("doc_id"), F.col("size"))


def _met(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows with key, size and nth joined to their cell; a cell that holds many of
    all rows is met in SALTS parts."""
    parts = cells.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("nth"), F.lit(SALTS)).cast("int")).join(parts, ["key", "size", "salt"]).drop("salt")


def cell_limits(sized: DataFrame, cells: DataFrame) -> DataFrame:
    """key, size, base, limit, tied: every document of the cell takes ``base`` copies, those whose
    hash is below ``limit`` one more, and of those that have this hash the ones up to number ``tied``
    (all if null)."""
    cells = (cells.withColumn("base", F.floor(F.col("m") / F.col("n")))
             .withColumn("odd", F.col("m") - F.col("base") * F.col("n"))
             .withColumn("buckets", F.ceil(F.col("n") / BUCKET_ROWS)))
    # hash buckets are hash ranges, so that ranks run on from bucket to bucket
    bucket = F.least(F.floor((F.shiftright("hash", 11) / F.lit(2.0 ** 53) + 0.5) * F.col("buckets")), F.col("buckets") - 1)
    rows = _met(sized.select("key", "size", "nth", _hash().alias("hash")), cells.where("odd > 0").select("key", "size", "odd", "buckets"))
    # documents that share a hash are one row with a count
    ranked = (rows.groupBy("key", "size", "odd", "buckets", "hash").agg(F.count("*").alias("rows"))
              .withColumn("bucket", bucket).drop("buckets"))
    counts = ranked.groupBy("key", "size", "bucket", "odd").agg(F.sum("rows").alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("key", "size").orderBy("bucket"))
    # the one bucket of a cell in which the last odd copy falls
    last = (counts.withColumn("upto", upto).where((F.col("upto") >= F.col("odd")) & (F.col("upto") - F.col("rows") < F.col("odd")))
            .select("key", "size", "bucket", (F.col("odd") - F.col("upto") + F.col("rows")).alias("place")))
    upto = F.sum("rows").over(Window.partitionBy("key", "size", "bucket").orderBy("hash"))
    limit = (ranked.drop("odd").join(last, ["key", "size", "bucket"]).withColumn("upto", upto)
             .where((F.col("upto") >= F.col("place")) & (F.col("upto") - F.col("rows") < F.col("place")))
             .select("key", "size", F.col("hash").alias("limit"), "rows", (F.col("place") - F.col("upto") + F.col("rows")).alias("rest")))
    limit = cut(limit, "mix-limits")
    return (cells.select("key", "size", "base").join(limit.select("key", "size", "limit"), ["key", "size"], "left")
            .join(_tied(rows, limit.where("rest < rows")), ["key", "size"], "left"))


def _tied(rows: DataFrame, limit: DataFrame) -> DataFrame:
    """key, size, tied: the number up to which documents that share the limiting hash take an odd copy, ``rest``
    of them. Numbers hold the partition in which a row was written; the partitions' counts tell in which
    one the last copy falls, and only this one's rows are ranked."""
    part = F.shiftright("nth", 33)
    same = (rows.select("key", "size", "nth", "hash").join(limit.select("key", "size", F.col("limit").alias("hash"), "rest"), ["key", "size", "hash"])
            .select("key", "size", "nth", part.alias("part"), "rest"))
    counts = same.groupBy("key", "size", "part", "rest").agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("key", "size").orderBy("part"))
    last = (counts.withColumn("upto", upto).where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("rows") < F.col("rest")))
            .select("key", "size", "part", (F.col("rest") - F.col("upto") + F.col("rows")).alias("place")))
    place = F.row_number().over(Window.partitionBy("key", "size", "part").orderBy("nth"))
    return (same.drop("rest").join(last, ["key", "size", "part"]).withColumn("at", place).where("at = place")
            .select("key", "size", F.col("nth").alias("tied")))


def plan(sized: DataFrame, *, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """From doc_id, key, size and nth (a written number of the row): the targets by key and the copies by (key, size)."""
    release(sized.sparkSession)
    sizes = cut(sized.groupBy("key", "size").agg(F.count("*").alias("n")), "mix-histogram")
    goal = cut(targets(sizes, weights, share, cap), "mix-targets")
    cells = cut(cell_copies(sizes, goal, multipliers(sizes, goal, cap), cap), "mix-cells")
    return goal, cell_limits(sized, cells)


def _copies() -> Column:
    odd = (F.col("hash") < F.col("limit")) | ((F.col("hash") == F.col("limit")) & (F.col("tied").isNull() | (F.col("nth") <= F.col("tied"))))
    return F.col("base") + F.when(odd, 1).otherwise(0)


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row."""
    sized = cut(docs.select("doc_id", "source", row_key("source").alias("key"), size_of().alias("size"),
                            F.monotonically_increasing_id().alias("nth")), "mix-sizes")
    goal, limits = plan(sized, **options)
    return (_met(sized.withColumn("hash", _hash()), limits).join(goal, "key")
            .withColumn("copies", F.when(F.col("size") > 0, _copies()).otherwise(0))
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).cast("long").alias("taken")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in the mix: each as often as it has copies, with
    its own columns; rows without a word stay once."""
    names = docs.columns
    wide = cut(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id"), row_key("source").alias("key"),
                           size_of().alias("size"), F.monotonically_increasing_id().alias("nth")), "mix-rows")
    _, limits = plan(wide.select("doc_id", "key", "size", "nth"), **options)
    copies = F.when(F.col("size") > 0, _copies()).otherwise(1).cast("int")
    return (_met(wide.withColumn("hash", _hash()), limits)
            .withColumn("copies", copies).where("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*"))
