"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Among all document rates r with sum(r * size) equal to the target of each source and r at most the cap,
entropy balancing takes the one closest to 1 in relative entropy. Its dual is convex and splits by source:
r = min(cap, exp(lambda * size / scale)). Newton steps on the logarithm of each source's sum, kept inside
a bracket, find every lambda at once. A rate depends on source and size alone, so the steps run over the
histogram of (source, size), not over documents.

Rates become copies by systematic rounding in the order of size: a source's words then miss their target
by about one document. What is missing, or too much, is then made up by one copy more, or less, of single documents, from
the largest size that fits downwards, so that a source ends nearer to its target than the size of its smallest
document that can still change. Sums are decimals, so their order cannot change a result and reruns agree.

Defined results: null and empty texts have size 0 and are taken once, adding no words; a null source is a
source of its own, after all others; rows that repeat are separate documents; an empty table gives an empty
result. Other columns pass through whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglattice.session import cut_lineage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
TOLERANCE = 1e-6
MAX_STEPS = 60
# Documents of one source and size are rounded in groups of about this many.
ROUND_GROUP = 1000
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, key: str) -> DataFrame:
    """Add `rank`, from 0 in the order of key with null last, without sorting in one task."""
    spread = cut_lineage(
        df.repartitionByRange(F.col(key).asc_nulls_last()).withColumn("_part", F.spark_partition_id())
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = spread.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(key).asc_nulls_last()))
    return (
        spread.withColumn("_row", inside)
        .join(starts, "_part")
        .withColumn("rank", F.col("_start") + F.col("_row") - 1)
        .drop("_part", "_start", "_row")
    )


def source_targets(
    hist: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """Rows (src, source_size, target): share of all sizes by weight, none above cap times its source.

    What a capped source leaves goes to the others by weight until none is above its cap.
    """
    sources = hist.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    listed = F.array(*[F.lit(w) for w in weights])
    sources = cut_lineage(
        ranked(sources, "src").withColumn(
            "weight", F.element_at(listed, (F.col("rank") % len(weights)).cast("int") + 1)
        )
    )
    limit = F.col("source_size") * cap
    total = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = (total[0] or 0) * share
    level = wanted / total[1] if total[1] else 0.0
    while True:
        above = F.col("weight") * level > limit
        held = sources.agg(
            F.sum(F.when(above, F.col("source_size")).otherwise(0)),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))),
        ).first()
        risen = (wanted - cap * (held[0] or 0)) / held[1] if held[1] else level
        if risen <= level:
            break
        level = risen
    return sources.select("src", "source_size", F.least(F.col("weight") * level, limit).alias("target"))


def _rate(cap: float) -> Column:
    return F.when(F.col("lam").isNull(), F.lit(cap)).otherwise(
        F.least(F.lit(cap), F.exp(F.col("lam") * F.col("size") / F.col("scale")))
    )


def _exact(value: Column) -> Column:
    return F.sum(value.cast("decimal(38,9)")).cast("double")


def balanced_rates(hist: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """Rows (src, size, n, source_size, target, rate) by Newton steps on the dual of all sources at once."""
    h = hist.withColumnRenamed("src", "hist_src")
    same = F.col("hist_src").eqNullSafe(F.col("src"))
    scale = h.filter("size > 0").groupBy("hist_src").agg(
        (_exact(F.col("n") * F.col("size").cast("double") * F.col("size")) / _exact(F.col("n") * F.col("size"))).alias("scale")
    )
    t = targets.join(scale, same, "left").drop("hist_src").filter(F.col("target") > 0)
    full = F.col("target") >= F.col("source_size") * cap
    # A size is 1 at least, so at lambda = scale * ln(cap) every rate is at its cap.
    state = t.select(
        "src", "source_size", "target", "scale",
        F.when(~full, F.log(F.col("target") / F.col("source_size"))).alias("lam"),
        F.lit(-700.0).alias("low"),
        (F.col("scale") * math.log(cap)).alias("high"),
    )
    state = cut_lineage(state)
    for _ in range(MAX_STEPS):
        rate = _rate(cap)
        words = F.col("n") * F.col("size") * rate
        sums = (
            h.join(state.filter(F.col("lam").isNotNull()), same)
            .groupBy("src")
            .agg(
                _exact(words).alias("got"),
                _exact(F.when(rate < cap, words * F.col("size") / F.col("scale")).otherwise(0.0)).alias("slope"),
            )
            .withColumnRenamed("src", "sum_src")
        )
        gap = F.when(F.col("got").isNotNull(), F.log(F.greatest("got", F.lit(1e-9)) / F.col("target")))
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap < 0, F.col("high")).otherwise(F.col("lam"))
        step = F.col("lam") - gap * F.col("got") / F.col("slope")
        inside = (F.col("slope") > 0) & (step > low) & (step < high)
        state = cut_lineage(
            state.join(sums, F.col("src").eqNullSafe(F.col("sum_src")), "left").select(
                "src", "source_size", "target", "scale",
                F.when(F.abs(gap) < TOLERANCE, F.col("lam"))
                .when(inside, step)
                .when(F.col("lam").isNotNull(), (low + high) / 2)
                .alias("lam"),
                F.coalesce(low, "low").alias("low"),
                F.coalesce(high, "high").alias("high"),
                F.coalesce(F.abs(gap), F.lit(0.0)).alias("gap"),
            )
        )
        worst = state.agg(F.max("gap")).first()[0]
        state = state.drop("gap")
        if worst is None or worst < TOLERANCE:
            break
    plain = targets.select(F.col("src").alias("t_src"), "source_size", "target")
    solved = state.select("src", "lam", "scale", F.lit(True).alias("solved"))
    return (
        h.join(plain, F.col("hist_src").eqNullSafe(F.col("t_src")))
        .join(solved, same, "left")
        .select(
            F.col("hist_src").alias("src"), "size", "n", "source_size", "target",
            F.round(F.when((F.col("size") == 0) | F.col("solved").isNull(), 1.0).otherwise(_rate(cap)), 9)
            .cast("decimal(20,9)")
            .alias("rate"),
        )
    )


def _copied(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Add group and copies: the rates of a source's documents, in the order of size, rounded systematically."""
    spread = F.ceil(F.col("n") / ROUND_GROUP)
    joined = rows.join(
        rates, F.col("src").eqNullSafe(F.col("rate_src")) & (F.col("size") == F.col("rate_size"))
    ).withColumn("group", F.pmod(F.col("order"), spread))
    place = F.row_number().over(Window.partitionBy("src", "size", "group").orderBy("order"))
    # A single group goes on where smaller sizes stopped; the groups of a frequent size start anywhere.
    own_start = (F.pmod(F.xxhash64("src", "size", "group"), F.lit(1000)) / 1000).cast("decimal(38,9)")
    begin = F.when(F.col("n") > ROUND_GROUP, own_start).otherwise(F.col("start") + F.lit(0.5).cast("decimal(2,1)"))

    def upto(k: Column) -> Column:
        return F.floor(F.col("begin") + (k * F.col("rate")).cast("decimal(38,9)"))

    copies = (upto(F.col("place")) - upto(F.col("place") - 1)).cast("long")
    return joined.withColumn("place", place).withColumn("begin", begin.cast("decimal(38,9)")).withColumn("copies", copies)


def _changes(groups: DataFrame) -> DataFrame:
    """Rows (src, size, group, sign, quota): how many documents of a group take one copy more or less.

    A source's gap is filled from the largest size that fits downwards; the sizes that can fit are fewer than the gap is wide.
    """
    gaps = groups.groupBy("src").agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap")).select(
        F.col("src").alias("gap_src"), F.signum("gap").cast("long").alias("sign"), F.floor(F.abs("gap")).alias("gap")
    )
    here = groups.filter("size > 0").join(gaps, F.col("src").eqNullSafe(F.col("gap_src"))).select(
        "src", "size", "group", "sign", "gap", F.when(F.col("sign") > 0, F.col("more")).otherwise(F.col("fewer")).alias("able")
    ).filter("able > 0 and size <= gap")
    sizes = here.groupBy("src", "gap", "size").agg(F.sum("able").alias("able"))
    listed = sizes.groupBy("src", "gap").agg(F.sort_array(F.collect_list(F.struct("size", "able")), asc=False).alias("sizes"))

    def step(state: Column, x: Column) -> Column:
        n = F.least(x["able"], F.floor(state["gap"] / x["size"]))
        picks = F.when(n > 0, F.concat(state["picks"], F.array(F.struct(x["size"].alias("size"), n.alias("n"))))).otherwise(state["picks"])
        return F.struct((state["gap"] - n * x["size"]).alias("gap"), picks.alias("picks"))

    empty = F.array().cast("array<struct<size:bigint,n:bigint>>")
    chosen = listed.select(
        F.col("src").alias("pick_src"), F.explode(F.aggregate("sizes", F.struct(F.col("gap"), empty.alias("picks")), step)["picks"]).alias("pick")
    )
    before = Window.partitionBy("src", "size").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    picked = here.join(chosen, F.col("src").eqNullSafe(F.col("pick_src")) & (F.col("size") == F.col("pick.size")))
    left = F.col("pick.n") - F.coalesce(F.sum("able").over(before), F.lit(0))
    return picked.withColumn("quota", F.least("able", left)).filter("quota > 0").select("src", "size", "group", "sign", "quota")


def mix_sources(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, carry: list[str] | None = None,
) -> DataFrame:
    """Rows (row, size, source_size, target, rate, copies, taken); row holds the carried input columns."""
    rows = cut_lineage(
        docs.select(
            F.struct(*(carry or docs.columns)).alias("row"),
            F.col(source).alias("src"),
            word_count(text).alias("size"),
            # Rows that share an id, or have none, are apart unless they are equal in text too.
            F.xxhash64(F.col(doc_id), F.col(text)).alias("order"),
        )
    )
    hist = cut_lineage(rows.groupBy("src", "size").agg(F.count("*").alias("n")))
    rates = balanced_rates(hist, source_targets(hist, weights, share, cap), cap)
    before = Window.partitionBy("src").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    mass = (F.col("n") * F.col("rate")).cast("decimal(38,9)")
    zero = F.lit(0).cast("decimal(38,9)")
    rates = cut_lineage(
        rates.withColumn("start", F.coalesce(F.sum(mass).over(before).cast("decimal(38,9)"), zero))
        .withColumnsRenamed({"src": "rate_src", "size": "rate_size"})
    )
    most = int(cap)
    groups = cut_lineage(
        _copied(rows.select("src", "size", "order"), rates).groupBy("src", "size", "group", "target").agg(
            F.sum("copies").alias("copies"), F.count_if(F.col("copies") < most).alias("more"), F.count_if(F.col("copies") > 0).alias("fewer")
        )
    )
    changes = cut_lineage(_changes(groups))
    names = {c: f"c_{c}" for c in ("src", "size", "group")}
    same = (F.col("src").eqNullSafe(F.col("c_src"))) & (F.col("size") == F.col("c_size")) & (F.col("group") == F.col("c_group"))
    told = _copied(rows, rates).join(changes.withColumnsRenamed(names), same, "left")
    able = F.when(F.col("sign") > 0, F.col("copies") < most).when(F.col("sign") < 0, F.col("copies") > 0).otherwise(False)
    turn = F.row_number().over(Window.partitionBy("src", "size", "group").orderBy(F.col("able").desc(), "order"))
    changed = told.withColumn("able", able).withColumn("turn", turn)
    copies = F.col("copies") + F.when(F.col("able") & (F.col("turn") <= F.col("quota")), F.col("sign")).otherwise(0)
    return changed.withColumn("copies", copies.cast("long")).select(
        "row", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"),
    )
