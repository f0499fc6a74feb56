"""Mixing sources to target weights by histograms over hash thresholds.

Every document gets a 60-bit hash of its id. The words of each source are summed
by the leading bits of the hash; the bucket in which a budget runs out is the
only one that is opened further, twelve bits at a time, until one hash value is
left. A document takes part if its hash lies below its source's threshold, so
nothing is sorted, the choice does not depend on partitioning, and the choice
for a smaller budget is contained in that for a larger one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagweave.llm.common import WORD, documents, free_name
from tagweave.operators.ordering import ordered_index
from tagweave.sources.tables import materialize

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
HASH_BITS = 60
STEP_BITS = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_key(doc_id: Column) -> Column:
    """Sixty bits of MD5, the same in any engine; rows of one id share it."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int], most: int, share: float) -> DataFrame:
    """Add the words each source should give: ``target``, and exact whole parts of it.

    ``sources`` has source, source_size and weight. The free words are shared by
    weight; a source stops at ``most`` times its size, and what it leaves is
    shared again. Only three numbers a round reach the driver, and each round
    but the last stops at least one more source.
    """
    size = F.col("source_size").cast("decimal(38,0)")
    weight = F.col("weight").cast("decimal(38,0)")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    wanted = int(total * share)
    free, parts, stopped = wanted, None, -1
    while True:
        full = F.lit(False) if parts is None else size * most * parts < weight * free
        row = sources.agg(
            F.count(F.when(full, True)),
            F.sum(F.when(full, F.col("source_size"))),
            F.sum(F.when(~full, F.col("weight"))),
        ).first()
        if row[0] == stopped:
            break
        stopped, free, parts = row[0], wanted - most * (row[1] or 0), row[2] or 1
    whole = weight * free
    repeats = F.when(full | (F.col("source_size") == 0), most).otherwise(F.floor(whole / (size * parts)))
    return sources.withColumns(
        {
            "target": F.when(full, (size * most).cast("double")).otherwise(whole.cast("double") / parts),
            "repeats": repeats.cast("long"),
        }
    ).withColumn(
        "budget",
        F.when(full, F.lit(0)).otherwise(F.floor(whole / parts).cast("long") - F.col("repeats") * F.col("source_size")),
    )


def thresholds(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """The hash below which a source's documents are taken once more, per plan row.

    A hash value's documents belong to it if more than half of their words still
    fit the budget. Histograms hold at most 4,096 rows per source and level.
    """
    state = plan.select(
        "source", "share_no", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before")
    )
    rows = sized.select("source", "key", "size")
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        edge = rows.join(state.withColumnRenamed("source", "of"), _in_bucket(shift + STEP_BITS))
        buckets = edge.groupBy("source", "share_no", F.shiftright("key", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.first("budget").alias("budget"), F.first("before").alias("start")
        )
        up_to = Window.partitionBy("source", "share_no").orderBy("bucket")
        placed = buckets.withColumn("after", F.col("start") + F.sum("words").over(up_to))
        state = materialize(
            placed.where(F.col("after") > F.col("budget"))
            .groupBy("source", "share_no")
            .agg(F.min_by(F.struct("bucket", "budget", "words", "after"), "bucket").alias("b"))
            .select(
                "source",
                "share_no",
                "b.budget",
                F.col("b.bucket").alias("prefix"),
                (F.col("b.after") - F.col("b.words")).alias("before"),
                "b.words",
            ),
            "mix-state",
        )
        if shift == HASH_BITS - STEP_BITS:
            edges = state.select(F.col("source").alias("of"), "prefix").distinct()
            rows = materialize(rows.join(edges, _in_bucket(shift), "left_semi"), "mix-edge")
    fits = 2 * (F.col("budget") - F.col("before")) > F.col("words")
    return state.select("source", "share_no", (F.col("prefix") + fits.cast("long")).alias("threshold"))


def _in_bucket(shift: int) -> Column:
    return F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("key", shift) == F.col("prefix"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return materialize(
        docs.select(
            docs[id_col].alias("doc_id"),
            docs[source_col].cast("string").alias("source"),
            word_count(docs[text_col]).alias("size"),
            hash_key(docs[id_col]).alias("key"),
        ),
        "mix-sizes",
    )


def _plans(sized: DataFrame, shares: Sequence[float], weights: Sequence[int], most: int) -> DataFrame:
    """One row per source: ``_of`` and ``_plans``, in the order of ``shares``."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = ordered_index(totals, [F.col("source").asc_nulls_last()], "place").withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1)
    )
    sources = materialize(sources, "mix-sources")
    plan = None
    for i, share in enumerate(shares):
        part = source_targets(sources, weights, most, share).withColumn("share_no", F.lit(i))
        plan = part if plan is None else plan.unionByName(part)
    plan = materialize(plan, "mix-plan")
    cut = thresholds(sized, plan).select(F.col("source").alias("of"), F.col("share_no").alias("nth"), "threshold")
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("share_no") == F.col("nth"))
    fields = F.struct("share_no", "source_size", "target", "repeats", "budget", "threshold")
    return materialize(
        plan.join(cut, same, "left").groupBy(F.col("source").alias("_of")).agg(F.sort_array(F.collect_list(fields)).alias("_plans")),
        "mix-plans",
    )


def _times(plan: Column, key: Column) -> Column:
    """How often a document is taken; without a threshold its source ends before the budget does."""
    more = (plan.budget > 0) & (plan.threshold.isNull() | (key < plan.threshold))
    return plan.repeats + more.cast("long")


def mix(
    docs: DataFrame,
    shares: Sequence[float] = (1.0,),
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_REPEATS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How many words of every document the mix takes, for each nested share of all words.

    Sources, in order of their code points with null last, weigh ``weights``,
    repeating. Returns one row per input row: doc_id, source, size, and
    ``mixes``, an array over ``shares`` of (source_size, target, taken). A null
    or blank text has size 0 and gives nothing; rows with the same or no id are
    taken or left together; an empty table gives an empty result.
    """
    sized = _sized(docs, id_col, text_col, source_col)
    plans = _plans(sized, shares, weights, most)
    return sized.join(plans, F.col("source").eqNullSafe(F.col("_of"))).select(
        "doc_id",
        "source",
        "size",
        F.transform(
            "_plans",
            lambda p: F.struct(
                p.source_size.alias("source_size"),
                p.target.alias("target"),
                (F.col("size") * _times(p, F.col("key"))).alias("taken"),
            ),
        ).alias("mixes"),
    )


def take(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_REPEATS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken. Rows without words are not taken."""
    plans = _plans(_sized(docs, id_col, text_col, source_col), (1.0,), weights, most)
    of, plan, copy = (free_name(docs, name) for name in ("of", "plan", "copy"))
    plans = plans.select(F.col("_of").alias(of), F.col("_plans")[0].alias(plan))
    times = F.when(word_count(docs[text_col]) > 0, _times(F.col(plan), hash_key(docs[id_col]))).otherwise(0)
    joined = docs.join(plans, docs[source_col].cast("string").eqNullSafe(F.col(of)))
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(0), times.cast("int")))).drop(of, plan, copy)


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    first = F.col("mixes")[0]
    return mix(documents(spark, folder)).select(
        "doc_id",
        "size",
        first.source_size.alias("source_size"),
        first.target.alias("target"),
        first.taken.alias("taken"),
    )


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::HUGEINT AS s,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::HUGEINT AS w
  FROM sized GROUP BY source
), filled AS (
  SELECT *, sum(s) OVER () - 3 * (sum(s) OVER up_to - s) AS f, sum(w) OVER () - (sum(w) OVER up_to - w) AS p
  FROM sources WINDOW up_to AS (ORDER BY s::DOUBLE / w, source ROWS UNBOUNDED PRECEDING)
), flagged AS (SELECT *, 3 * s * p < w * f AS full_up FROM filled
), free AS (
  SELECT (SELECT sum(s) FROM flagged) - 3 * coalesce(sum(s) FILTER (full_up), 0) AS f,
         sum(w) FILTER (NOT full_up) AS p FROM flagged
), plan AS (
  SELECT source, s, CASE WHEN full_up THEN (3 * s)::DOUBLE ELSE (w * free.f)::DOUBLE / free.p::DOUBLE END AS target,
         CASE WHEN full_up OR s = 0 THEN 3 ELSE (w * free.f) // (s * free.p) END AS repeats,
         CASE WHEN full_up THEN 0 ELSE (w * free.f) // free.p END AS whole
  FROM flagged, free
), placed AS (
  SELECT d.*, p.s, p.target, p.repeats, p.whole - p.repeats * p.s AS budget,
         sum(size) OVER (PARTITION BY d.source ORDER BY key) AS after,
         sum(size) OVER (PARTITION BY d.source, key) AS words
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, s::BIGINT AS source_size, target,
       (size * (repeats + CASE WHEN budget > 0 AND 2 * (budget - (after - words)) > words THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""
