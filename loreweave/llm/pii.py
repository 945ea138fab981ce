"""Personal data: candidate spans, boosted trees over format and context, calibrated thresholds. DataFrame functions only.

Two generators per kind propose spans, leftmost and without overlap within a generator. The base generator follows the strict rule
of its kind; its valid matches always stay. The wide generator also proposes spelled-out addresses, any dotted quads, any long digit
groups and national phone numbers. Boosted trees are trained on the wide candidates: a candidate is positive if it overlaps a valid base match.
Their inputs are coarse counts, so the candidates of a whole corpus come down to a small table of feature combinations, which
is what reaches the driver (at most ``COMBINATIONS`` rows, the most frequent ones); the trees go back as one expression. For each kind the threshold is the
lowest score from which on ``TARGET_PRECISION`` of the candidates are positive. Wide candidates at or above it that overlap no base
span of their kind are added.

Rules: null counts as empty. Offsets are code points, ends exclusive. Rows are independent: repeated rows and null ids are no special
cases. Empty tables give empty results; other columns are not read. Patterns loop possessively, so a long run of one sign costs time in
proportion to its length and no stack.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loreweave.llm.queries import query, table
from loreweave.session import written

KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # 12 digits or more: shorter groups are dropped anyway
    "card": r"[0-9](?:[ -]?+[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?i)(?:\G|(?<![a-z0-9._%+-]))[a-z0-9._%+-]{1,64}+ ?+(?:@|\[at\]|\(at\)|\{at\}|<at>) ?+[a-z0-9-]{1,63}+(?: ?+(?:\.|\[dot\]|\(dot\)|\{dot\}|<dot>) ?+[a-z0-9-]{1,63}+){1,4}+",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"[0-9](?:[ -]?+[0-9]){11,}+",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?(?<![0-9])\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9])00[0-9](?:[ ().-]{0,2}[0-9]){7,12}+(?![0-9])",
}
# a text without any of these signs has no candidate
SIGNS = r"[0-9@]|(?i)[\[({<]at[\])}>]|(?i)(?:[0-9a-f]{1,4}:){7}"
MARK, INSTEAD = "", ""
CONTEXT = 24
FEATURES = ("digits", "breaks", "length", "bracket", "checked", "before", "after", "hint")
COMBINATIONS = 50_000
ROUNDS = 12
LEARNING_RATE = 0.4
TARGET_PRECISION = 0.9
SHRINK = 1.0


def cut(text: Column, pattern: str, kind: int, wide: bool) -> Column:
    """Array of a generator's matches with the length of the text before each and some context on both sides."""

    def match(parts: Column, i: Column) -> Column:
        gap, hit, rest = (F.get(parts, i + k) for k in (-1, 0, 1))
        return F.struct(
            F.lit(kind).alias("kind"),
            F.lit(wide).alias("wide"),
            i.alias("at"),
            F.char_length(gap).alias("gap"),
            hit.alias("hit"),
            F.right(gap, F.lit(CONTEXT)).alias("left"),
            F.left(rest, F.lit(CONTEXT)).alias("right"),
        )

    def matches(parts: Column) -> Column:
        odd = F.filter(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: (i % 2 == 1) & (i < F.size(parts)))
        return F.transform(odd, lambda i: match(parts, i))

    # the parts are an element of an array so that they are made once for a text, not once for a match
    parts = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)
    return F.flatten(F.transform(F.array(parts), matches))


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    """Whether the digits pass the Luhn check: every second one from the right counts double, less 9 above 9."""
    d = F.reverse(digits_of(hit))

    def add(total: Column, i: Column) -> Column:
        x = F.substr(d, i, F.lit(1)).cast("int")
        twice = F.when(x > 4, x * 2 - 9).otherwise(x * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def small_parts(hit: Column) -> Column:
    """Whether all dotted parts are numbers up to 255."""
    return F.forall(F.split(hit, r"\."), lambda x: F.regexp_replace(x, "^0+(?=.)", "").rlike(r"^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def valid(kind: Column, hit: Column) -> Column:
    """The strict rule of each kind, on a match of its base pattern."""
    n = F.length(digits_of(hit))
    return (
        F.when(kind == 0, F.lit(True))
        .when(kind == 1, small_parts(hit))
        .when(kind == 2, F.when(n.between(12, 19), luhn(hit)).otherwise(False))
        .otherwise(n.between(9, 15))
    )


def features(c: dict[str, Column]) -> dict[str, Column]:
    """Coarse counts of a candidate's format and context: a handful of values each."""
    kind, hit, left, right = (c[x] for x in ("kind", "hit", "left", "right"))
    n = F.length(digits_of(hit))
    breaks = F.length(F.regexp_replace(hit, r"[^ .()\-\[\]{}<>:@]", ""))

    def around(x: Column) -> Column:
        return F.when(x == "", 0).when(x.rlike(r"^\s$"), 1).when(x.rlike("^[0-9]$"), 2).when(x.rlike(r"^\p{L}$"), 3).when(x.rlike(r"^[=:\"'#/_]$"), 4).otherwise(5)

    # a plus sign belongs to the strict phone rule, so it is not told to the trees
    before = F.when(kind == 3, F.lit(0)).otherwise(around(F.right(left, F.lit(1))))
    checked = F.when(kind == 1, hit.rlike(":").cast("int") + 2 * (F.length(hit) <= 15).cast("int")).when(kind == 2, (n <= 19).cast("int")).otherwise(0)
    return {
        "digits": F.least(n, F.lit(20)),
        "breaks": F.least(breaks, F.lit(8)),
        "length": F.least(F.floor(F.length(hit) / 8), F.lit(6)).cast("int"),
        "bracket": hit.rlike(r"[\[({<]").cast("int"),
        "checked": checked,
        "before": before,
        "after": around(F.left(right, F.lit(1))),
        "hint": left.rlike(r"(?i)(?:mail|phone|tel|call|fax|card|visa|ip|addr)\S*\W*$").cast("int"),
    }


def candidates(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(row, doc_id, kind, wide, start, end, base, known, features...)`` of all texts with a sign, written once.

    ``row`` tells rows apart; a text without candidates has one row with a null ``kind``. ``known`` is whether a candidate overlaps a valid
    base match of its kind.
    """
    rows = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).filter(F.col("text").rlike(SIGNS))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.replace("text", F.lit(MARK), F.lit(INSTEAD)).alias("text"))
    cuts = [cut(F.col("text"), patterns[k], i, patterns is WIDE) for i, k in enumerate(KINDS) for patterns in (BASE, WIDE)]
    found = rows.select("row", "doc_id", F.explode_outer(F.concat(*cuts)).alias("m")).select("row", "doc_id", "m.*")
    # a match starts where the gaps and matches before it end
    before = Window.partitionBy("row", "kind", "wide").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    length = F.char_length("hit")
    placed = found.withColumn("end", F.sum(F.col("gap") + length).over(before)).withColumn("start", F.col("end") - length)
    # a base match that breaks its rule stays as a row that nothing selects, so that its text keeps a row
    placed = placed.withColumn("base", F.coalesce(~F.col("wide") & valid(F.col("kind"), F.col("hit")), F.lit(False)))
    # both frames grow from their first row on; one that ends at the last row would start anew at every row
    own_kind = Window.partitionBy("row", "kind")
    back = own_kind.orderBy("start", "wide").rowsBetween(Window.unboundedPreceding, 0)
    ahead = own_kind.orderBy(F.desc("start"), F.desc("wide")).rowsBetween(Window.unboundedPreceding, 0)
    known = (F.max(F.when(F.col("base"), F.col("end"))).over(back) > F.col("start")) | (F.min(F.when(F.col("base"), F.col("start"))).over(ahead) < F.col("end"))
    own = features({x: F.col(x) for x in ("kind", "hit", "left", "right")})
    columns = [F.when(F.col("wide"), v.cast("int")).alias(k) for k, v in own.items()]
    return written(placed.select("row", "doc_id", "kind", "wide", "start", "end", "base", F.coalesce(known, F.lit(False)).alias("known"), *columns), "candidates")


Tree = tuple  # (feature, limit, low, high); low and high are trees or numbers


def split_best(rows: list[tuple], slopes: list[float], curves: list[float], depth: int):
    """A tree of the given depth over rows of features, by the gain of Newton steps."""
    g, h = sum(slopes), sum(curves)
    best = (1e-6, None, None)
    if depth:
        for f in range(len(FEATURES)):
            sums: dict[int, list[float]] = {}
            for r, a, b in zip(rows, slopes, curves):
                s = sums.setdefault(r[f], [0.0, 0.0])
                s[0] += a
                s[1] += b
            lg = lh = 0.0
            for limit in sorted(sums)[:-1]:
                lg, lh = lg + sums[limit][0], lh + sums[limit][1]
                gain = lg * lg / (lh + SHRINK) + (g - lg) ** 2 / (h - lh + SHRINK) - g * g / (h + SHRINK)
                if gain > best[0]:
                    best = (gain, f, limit)
    if best[1] is None:
        return -LEARNING_RATE * g / (h + SHRINK)
    _, f, limit = best
    sides = []
    for low in (True, False):
        at = [i for i, r in enumerate(rows) if (r[f] <= limit) == low]
        sides.append(split_best([rows[i] for i in at], [slopes[i] for i in at], [curves[i] for i in at], depth - 1))
    return (f, limit, *sides)


def value(tree, row: tuple) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def boost(rows: list[tuple], n: list[int], positive: list[int]) -> tuple[list, float, float]:
    """``(trees, first, threshold)`` from feature combinations with their numbers of candidates and of positives."""
    total, good = sum(n), sum(positive)
    first = math.log((good + 0.5) / (total - good + 0.5))
    scores = [first] * len(rows)
    trees = []
    for _ in range(ROUNDS):
        p = [1 / (1 + math.exp(-s)) for s in scores]
        trees.append(split_best(rows, [m * q - k for m, q, k in zip(n, p, positive)], [max(1e-9, m * q * (1 - q)) for m, q in zip(n, p)], 2))
        scores = [s + value(trees[-1], r) for s, r in zip(scores, rows)]
    # the lowest score from which on the wanted share is positive; above all scores if there is none
    threshold, seen, hits = math.inf, 0, 0
    for s in sorted(set(scores), reverse=True):
        at = [i for i, x in enumerate(scores) if x == s]
        seen += sum(n[i] for i in at)
        hits += sum(positive[i] for i in at)
        if hits >= TARGET_PRECISION * seen:
            threshold = s
    return trees, first, threshold


def expression(tree) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    f, limit, low, high = tree
    return F.when(F.col(FEATURES[f]) <= limit, expression(low)).otherwise(expression(high))


def selected(found: DataFrame) -> Column:
    """Condition on candidates: the trees of their kind score them at or above its threshold."""
    wide = found.filter("wide").groupBy("kind", *FEATURES).agg(F.count("*").alias("n"), F.sum(F.col("known").cast("int")).alias("good"))
    table_ = wide.orderBy(F.desc("n"), "kind", *FEATURES).limit(COMBINATIONS).collect()
    choice = F.lit(False)
    for kind in range(len(KINDS)):
        own = [r for r in table_ if r["kind"] == kind]
        if not any(r["good"] for r in own):
            continue
        trees, first, threshold = boost([tuple(r[f] for f in FEATURES) for r in own], [r["n"] for r in own], [r["good"] for r in own])
        if math.isfinite(threshold):
            score = reduce(lambda a, b: a + b, map(expression, trees), F.lit(first))
            choice = F.when(F.col("kind") == kind, score >= threshold - 1e-9).otherwise(choice)
    return choice


def personal_data(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` for every row; counts are of base spans."""
    found = candidates(df, key, text)
    added = F.col("wide") & ~F.col("known") & selected(found)
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    span = F.struct("start", "kind", "end", F.concat_ws(":", name, F.col("start").cast("string"), F.col("end").cast("string")).alias("said"))

    def listed(chosen: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(chosen, span))), lambda s: s["said"]), ",")

    counts = [F.count(F.when(F.col("base") & (F.col("kind") == i), 1)).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    some = (
        found.groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), *counts, listed(F.col("base")).alias("base"), listed(F.col("base") | added).alias("spans"))
        .select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")
    )
    none = df.filter(~F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(SIGNS)).select(
        F.col(key).alias("doc_id"), *[F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(F.lit(""), 256).alias("base_sha256"), F.lit("").alias("spans")
    )
    return some.union(none)


@query("op2_pii")
def pii_query(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))
