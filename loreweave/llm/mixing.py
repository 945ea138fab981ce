"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

Each source gets a mean repetition rate: its target share of the wanted characters over the characters it has. A row's
number of copies is the inverse of the Poisson distribution with that mean at a number in [0, 1) hashed from seed and
key, so runs, retries and partitions agree, and rows of the same key repeat alike. Copies are shuffled globally: dealt
and ordered by a hash of seed, key and copy.

Rules: a null source is a source of its own; a null text has no characters; a source without any characters has rate 1;
a source that is missing from ``weights`` or has a weight of 0 gets rate 0. Null keys hash alike. Empty tables give empty
results. Columns of the input stay as they are; ``copy_no`` and ``mix_order`` come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loreweave.llm.queries import query, table
from loreweave.session import written

SEED = 42
# target share of a source: its size to this power, over the sum for all sources (temperature sampling)
POWER = 0.5
# wanted size over the size at hand
EPOCHS = 1.0
# counts of copies whose probability is kept beyond the mean: mean + SPAN * sqrt(mean) + 30; the tail has less than 2^-52
SPAN = 12.0
# rows of the distribution table that may be broadcast; a larger table is joined by source instead
BROADCAST_ROWS = 20_000


def target_rates(df: DataFrame, source: str, text: str, weights: dict | None = None, power: float = POWER, epochs: float = EPOCHS) -> DataFrame:
    """``(source, rate)`` for every source of ``df``; ``weights`` gives target shares, else sizes to the power decide."""
    sizes = df.groupBy(F.col(source).cast("string").alias("source")).agg(F.coalesce(F.sum(F.length(text).cast("long")), F.lit(0).cast("long")).alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(power)))
    else:
        total = float(sum(weights.values())) or 1.0
        entries = [x for k, w in weights.items() for x in (F.lit(k), F.lit(float(w) / total))]
        share = F.element_at(F.create_map(*entries), F.coalesce("source", F.lit(""))) if entries else F.lit(0.0)
        weighed = sizes.withColumn("weight", F.coalesce(F.when(F.col("source").isNotNull(), share), F.lit(0.0)))
    weighed = written(weighed, "sizes")
    sums = weighed.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    rate = F.lit(epochs) * F.lit(float(sums["size"] or 0)) * F.col("weight") / F.lit(float(sums["weight"] or 0) or 1.0) / F.col("size")
    return weighed.select("source", F.when(F.col("size") == 0, 1.0).otherwise(rate).alias("rate"))


def distribution(rates: DataFrame) -> DataFrame:
    """``(source, copies, below)``: ``below`` is the probability of at most ``copies`` copies."""
    most = F.ceil(F.col("rate") + F.lit(SPAN) * F.sqrt("rate") + 30).cast("long")
    counts = rates.filter("rate > 0").select("source", "rate", F.explode(F.sequence(F.lit(0).cast("long"), most)).alias("copies"))
    to_here = Window.partitionBy("source").orderBy("copies").rowsBetween(Window.unboundedPreceding, 0)
    log_factorial = F.sum(F.log(F.greatest(F.col("copies"), F.lit(1)).cast("double"))).over(to_here)
    logs = counts.select("source", "copies", (F.col("copies") * F.log("rate") - F.col("rate") - log_factorial).alias("log_p"))
    return logs.select("source", "copies", F.sum(F.exp("log_p")).over(to_here).alias("below"))


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) of 52 bits, hashed from seed and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def mix(
    df: DataFrame, key: str, source: str, text: str, weights: dict | None = None, seed: int = SEED, epochs: float = EPOCHS, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The rows of ``df``, each as often as its Poisson count says, plus ``copy_no`` (from 0) and ``mix_order``."""
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    k, s = (F.col(f"c{names.index(x)}") for x in (key, source))
    below = written(distribution(target_rates(df, source, text, weights, epochs=epochs)), "distribution")
    rows = plain.withColumn("u", uniform(k, seed))
    lists = below.groupBy("source").agg(F.array_sort(F.collect_list("below")).alias("steps"))
    if below.limit(broadcast_rows + 1).count() <= broadcast_rows:
        lists = F.broadcast(lists)  # at most broadcast_rows numbers
    counted = rows.join(lists, s.cast("string").eqNullSafe(F.col("source")))
    copies = F.size(F.filter("steps", lambda p: p <= F.col("u")))
    numbered = counted.withColumn("copies", F.least(copies, F.size("steps") - 1)).filter("copies > 0")
    repeated = numbered.select(*[f"c{i}" for i in range(len(names))], F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    order = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(k.cast("string"), F.lit("")), F.lit("/"), F.col("copy").cast("string")))
    dealt = repeated.withColumn("order", order).repartition(F.col("order")).sortWithinPartitions("order")
    return dealt.toDF(*names, "copy_no", "mix_order")


def mix_documents(df: DataFrame) -> DataFrame:
    """The mixture with the columns of ``df`` alone."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    at = {x: f"c{df.columns.index(x)}" for x in ("doc_id", "source", "text")}
    return mix(plain, at["doc_id"], at["source"], at["text"]).drop("copy_no", "mix_order").toDF(*df.columns)


@query(
    "op9_mixing",
    f"""WITH sizes AS (SELECT source, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS size FROM documents GROUP BY 1),
    weighed AS (SELECT *, pow(size::DOUBLE, {POWER}) AS weight FROM sizes),
    rates AS (SELECT source, CASE WHEN size = 0 THEN 1.0::DOUBLE ELSE {EPOCHS}::DOUBLE * (SELECT sum(size) FROM weighed)::DOUBLE * weight / (SELECT sum(weight) FROM weighed) / size END AS rate FROM weighed),
    counts AS (SELECT source, rate, unnest(range(0, CAST(ceil(rate + {SPAN} * sqrt(rate) + 30) AS BIGINT) + 1)) AS copies FROM rates WHERE rate > 0),
    logs AS (SELECT source, copies, copies * ln(rate) - rate - sum(ln(greatest(copies, 1)::DOUBLE)) OVER (PARTITION BY source ORDER BY copies) AS log_p FROM counts),
    steps AS (SELECT source, list(below ORDER BY below) AS steps FROM (
      SELECT source, sum(exp(log_p)) OVER (PARTITION BY source ORDER BY copies) AS below FROM logs) GROUP BY 1),
    counted AS (SELECT d.*, least(len(list_filter(steps, lambda p: p <= u)), len(steps) - 1) AS copies FROM (
      SELECT *, ('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / {1 << 52}.0 AS u FROM documents) d
      JOIN steps ON d.source IS NOT DISTINCT FROM steps.source),
    repeated AS (SELECT * EXCLUDE (copies, u), unnest(range(0, copies)) AS copy_no FROM counted WHERE copies > 0)
    SELECT *, md5('{SEED}/' || coalesce(doc_id::VARCHAR, '') || '/' || copy_no) AS mix_order FROM repeated""",
)
def mixing_query(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"), "doc_id", "source", "text")
