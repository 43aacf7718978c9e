"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled by a keyed hash. A document's copy has
the virtual finish time ``(words of its source up to its end) / target``; all
copies of all sources, sorted by it, are taken until the budget is used up, so
every source has its share at each moment. A source whose target exceeds its
size goes round again, up to ``MOST`` times.

Running sums never need a whole source in one task: a source is cut into
slices of the hash, slices are summed, and a document adds its place in the
slice to the slices before. The cut through the sorted copies is found the same
way: copies are counted by ranges of virtual time, and only the range in which
the budget ends is sorted. The driver learns one row: the last copy taken.

Cases: a null text has size 0 and is taken with 0 words; a null source is a
source of its own and comes last; equal rows are told apart by nothing, so
either may be the one that is taken; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"
#: Documents per slice of a source, and copies per range of virtual time, on average.
SLICE = 4000

#: Orders the sources by code point, null last.
SOURCE = ["no_source", "source_key"]
ORDER = [*SOURCE, "shuffled", "doc_order", "size"]


def _marks(text: Column, seed: str) -> dict[str, Column]:
    identity = F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    return {
        "no_source": F.col("source").isNull().cast("int"),
        "source_key": F.coalesce("source", F.lit("")),
        "shuffled": F.md5(identity),
        "doc_order": F.coalesce("doc_id", F.lit(-(2**63))),
    }


def shuffled(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Id, source, size in words and place in the shuffle; the text counts, so that equal ids spread."""
    key = _marks(F.coalesce(F.col("text"), F.lit("")), seed)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), *[column.alias(name) for name, column in key.items()])


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source: size, rows and target; what exceeds ``most`` times a size is shared again by weight.

    A source reaches its bound the sooner, the smaller bound / weight is. With the
    sources in that order the first ones are bound; the others share the rest by
    weight. One row per source, so the windows without a key are small.
    """
    per = sizes.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    place = F.row_number().over(Window.orderBy(*SOURCE)) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    bound = per.withColumn("weight", weight).withColumn("bound", most * F.col("source_size"))
    everyone = Window.orderBy(F.col("bound") / F.col("weight"), *SOURCE)
    before = everyone.rowsBetween(Window.unboundedPreceding, -1)
    behind = everyone.rowsBetween(0, Window.unboundedFollowing)
    whole = everyone.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("bound").over(before), F.lit(0))
    rate = left / F.sum("weight").over(behind)
    ranked = bound.withColumn("rate", rate).withColumn("fits", F.col("rate") * F.col("weight") < F.col("bound"))
    # from the first source that stays below its bound on, all share at its rate
    shared = ranked.withColumn("rate", F.first(F.when(F.col("fits"), F.col("rate")), True).over(whole))
    own = F.least(F.col("bound").cast("double"), F.coalesce(F.col("rate") * F.col("weight"), F.col("bound").cast("double")))
    return shared.select(*SOURCE, "source_size", "source_rows", own.alias("target"))


def _number(hexadecimal: Column) -> Column:
    return F.conv(F.substring(hexadecimal, 1, 8), 16, 10).cast("long")


def queued(sizes: DataFrame, shares: DataFrame) -> DataFrame:
    """Documents with their words' end in the shuffled source, counted from its start."""
    slices = F.ceil(F.col("source_rows") / SLICE)
    placed = sizes.join(shares, SOURCE).withColumn("slice", F.shiftright(_number(F.col("shuffled")) * slices, 32))
    per = placed.groupBy(*SOURCE, "slice").agg(F.sum("size").alias("slice_size"))
    ahead = Window.partitionBy(*SOURCE).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select(*SOURCE, "slice", F.coalesce(F.sum("slice_size").over(ahead), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*SOURCE, "slice").orderBy("shuffled", "doc_order", "size").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("inside", F.sum("size").over(inside))
    return summed.join(starts, [*SOURCE, "slice"]).withColumn("words_to_end", F.col("start") + F.col("inside"))


def _finish(epoch: Column | int) -> Column:
    end = F.col("words_to_end") + epoch * F.col("source_size")
    return F.when(F.col("target") > 0, end / F.col("target")).otherwise(F.lit(0.0))


def _last_taken(queue: DataFrame, budget: int) -> dict | None:
    """The last copy, in order of virtual time, with which the copies' words stay within the budget."""
    n_ranges = max(1, queue.count() * MOST // SLICE)
    copies = queue.withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(MOST)])))
    copies = copies.withColumn("finish", _finish(F.col("epoch"))).withColumn("range", F.floor(F.col("finish") * n_ranges))
    per = copies.groupBy("range").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    along = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    # the ranges number a few thousandths of the rows
    cut = per.withColumn("to_end", F.sum("words").over(along)).filter(F.col("to_end") > budget).orderBy("range").first()
    if cut is None:
        return None
    order = ["finish", *ORDER]
    along = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    near = copies.filter((F.col("range") == cut["range"])).select(*order).withColumn("sum", F.sum("size").over(along))
    left = budget - (cut["to_end"] - cut["words"])
    last = near.filter(F.col("sum") <= left).orderBy(*[F.col(c).desc() for c in order]).first()
    return last.asDict() if last else {"finish": cut["range"] / n_ranges, "no_source": -1, "source_key": "", "shuffled": "", "doc_order": 0, "size": 0}


def _counted(docs: DataFrame, weights: tuple[int, ...], seed: str) -> DataFrame:
    sizes = stage(shuffled(docs, seed), "mix-sizes")
    shares = stage(targets(sizes, weights), "mix-targets")
    queue = stage(queued(sizes, shares), "mix-queue")
    budget = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    last = _last_taken(queue, budget)
    n_copies = F.lit(MOST)
    if last is not None:
        order = ["finish", *ORDER]
        end = F.struct(*[F.lit(last[c]).cast("double" if c == "finish" else queue.schema[c].dataType).alias(c) for c in order])
        taken = [F.struct(_finish(e).alias("finish"), *[F.col(c) for c in ORDER]) <= end for e in range(MOST)]
        n_copies = sum((t.cast("long") for t in taken), F.lit(0).cast("long"))
    return queue.withColumn("n_copies", n_copies.cast("long"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """One row per document: ``doc_id``, source, size, source_size, target, the copies and the words taken."""
    rows = _counted(docs, weights, seed).withColumn("taken", F.col("size") * F.col("n_copies"))
    return rows.select("doc_id", "source", "size", "source_size", "target", "n_copies", "taken")


def sample(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """The mixed documents, each as often as it is taken, with the columns of ``docs``.

    Rows of equal id, source and text count as copies of one of them, whose other columns are taken.
    """
    marks = [*SOURCE, "shuffled", "doc_order"]
    times = _counted(docs, weights, seed).groupBy(*[F.col(c).alias(f"_mix_{c}") for c in marks]).agg(F.sum("n_copies").alias("_mix_n"))
    text = F.coalesce(F.col("text"), F.lit(""))
    key = _marks(text, seed)
    rows = docs.select(F.struct("*").alias("_mix_row"), *[key[c].alias(f"_mix_{c}") for c in marks])
    one = rows.groupBy(*[f"_mix_{c}" for c in marks]).agg(F.first("_mix_row").alias("_mix_row"))
    taken = one.join(times.filter(F.col("_mix_n") > 0), [f"_mix_{c}" for c in marks])
    return taken.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_mix_n"))).select("_mix_row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLE = rf"""WITH d AS (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
  CASE WHEN source IS NULL THEN 1 ELSE 0 END AS no_source, coalesce(source, '') AS source_key, coalesce(doc_id, {-(2**63) + 1} - 1) AS doc_order,
  md5(concat_ws('|', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')))) AS shuffled FROM documents),
s AS (SELECT no_source, source_key, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1, 2),
w AS (SELECT *, [{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY no_source, source_key) - 1) % {len(WEIGHTS)} + 1] AS weight, {MOST} * source_size AS bound FROM s),
r AS (SELECT *, row_number() OVER o AS n, CAST(sum(source_size) OVER () - coalesce(sum(bound) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
  / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rate
  FROM w WINDOW o AS (ORDER BY bound / weight, no_source, source_key)),
l AS (SELECT arg_min(rate, n) FILTER (rate * weight < bound) AS rate FROM r),
t AS (SELECT r.no_source, r.source_key, r.source_size, least(CAST(bound AS DOUBLE), coalesce(l.rate * weight, CAST(bound AS DOUBLE))) AS target FROM r, l),
q AS (SELECT row_number() OVER () AS id, *, CAST(sum(size) OVER (PARTITION BY no_source, source_key ORDER BY shuffled, doc_order, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM d JOIN t USING (no_source, source_key)),
c AS (SELECT *, CASE WHEN target > 0 THEN (upto + epoch * source_size) / target ELSE 0 END AS finish FROM q, (SELECT unnest(range({MOST})) AS epoch) e),
k AS (SELECT id, sum(size) OVER (ORDER BY finish, no_source, source_key, shuffled, doc_order, size ROWS UNBOUNDED PRECEDING) AS upto FROM c),
n AS (SELECT id, count(*) AS n FROM k WHERE upto <= (SELECT sum(size) FROM d) GROUP BY id)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * coalesce(n, 0) AS BIGINT) AS taken FROM q LEFT JOIN n USING (id)"""
