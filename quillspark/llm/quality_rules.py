"""Quality rules (operator 6): robust multivariate outliers, in built-in functions only.

Statistics of each text are transformed to a vector; a minimum-covariance-determinant estimate is made
for each language and source, and texts are rejected by their Mahalanobis distance.  The estimate is searched
from three deterministic starts (median deviations alone, with correlations of squashed values, with those of
directions) by concentration steps: of the h rows that are nearest take mean and covariance, measure anew, until the
determinant falls no more; the start that ends at the least determinant counts.

Values are counted in whole units and sums are sums of whole numbers, so results are the same however
rows are dealt over partitions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_settled, settle

#: Base rules.
MIN_WORDS = 50
MOST_REPEATED = 50
#: Rows of a group used for its estimate, as a share.
H = 0.75
#: The logarithm of the determinant falls by this at least, or steps end.
LEAST_FALL = 1e-3
#: Fewest rows of a language and source for an estimate of its own; smaller ones are pooled by language.
LEAST_ROWS = 200
#: Fewest rows of such a pool: six for each statistic.
LEAST_POOL = 30
#: Parts of one in which a statistic is counted, and parts of these in which its median is.
UNIT, COARSE = 1 << 16, 1 << 6
#: Classes of squared distance to a doubling, in which the h nearest rows are told.
CLASSES = 1 << 8
#: Parts of one in which squashed values and directions are counted.
FINE = 1 << 12
#: The transformed statistics, and the least standard deviation that counts for each.
FEATURES = {"x0": 0.06, "x1": 0.6, "x2": 0.06, "x3": 0.15, "x4": 0.2}
#: Median of the chi-square distribution with 5 degrees of freedom.
CHI_MEDIAN = 4.351
#: Rejected beyond this squared distance (the chi-square tail there is 6e-8: real statistics have heavier tails).
CUT = 42.0
SPACES = r"[\x20\x09-\x0D]+"


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """doc_id, g0, g1.. (the group columns), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper.

    Each array that a lambda reads is a column of its own, so that it is computed once for a text.  Words of a text
    are compared by 64-bit hashes, and windows by hashes of these: two different ones pass for equal once in 2^64 pairs.
    """
    text = F.col("_t")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), *[F.col(f"`{g}`").cast("string").alias(f"g{i}") for i, g in enumerate(groups)], F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_t"))
    rows = rows.withColumns({
        "_w": F.array_remove(F.split(text, SPACES), ""),
        "_l": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"),
    })
    keep = ["doc_id", *[f"g{i}" for i in range(len(groups))], "n_symbols", "n_upper"]
    rows = rows.select(
        *keep, F.size("_w").cast("long").alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.size("_l").cast("long").alias("n_lines"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    )
    keep += ["n_words", "word_chars", "n_lines", "n_dup_lines"]
    h = F.col("_h")
    three = F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))
    rows = rows.select(*keep, F.when(F.size(h) > 3, three).alias("_s"))
    # only texts with a repeated window go on: their windows are sorted, so that equal ones are neighbours
    some = F.size(F.array_distinct("_s")) < F.size("_s")
    rows = rows.select(*keep, F.when(some, F.sort_array(F.transform("_s", lambda s, i: F.struct(s.alias("s"), i.alias("i"))))).alias("_o"))
    o = F.col("_o")

    def again(k: Column) -> Column:
        own = F.get(o, k)["s"]
        before, after = F.get(o, k - 1)["s"].eqNullSafe(own), F.get(o, k + 1)["s"].eqNullSafe(own)
        at = F.get(o, k)["i"]
        return F.when(before | after, F.array(at, at + 1, at + 2)).otherwise(F.array().cast("array<int>"))

    covered = F.size(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.size(o) - 1), again))))
    return rows.select(*keep, F.when(o.isNotNull(), covered).otherwise(0).cast("long").alias("n_repeat_words"))


def with_features(stats: DataFrame) -> DataFrame:
    angle = lambda a, b: F.asin(F.sqrt(F.least(F.lit(1.0), a / F.greatest(b, F.lit(1)))))
    c = F.col
    return stats.withColumns({
        "x0": F.log(F.greatest(c("word_chars"), F.lit(1)) / F.greatest(c("n_words"), F.lit(1))),
        "x1": F.log1p(1000 * c("n_symbols") / F.greatest(c("word_chars"), F.lit(1))),
        "x2": angle(c("n_upper"), c("word_chars")),
        "x3": angle(c("n_dup_lines"), c("n_lines")),
        "x4": angle(c("n_repeat_words"), c("n_words")),
    })


GROUP = ["_g0", "_g1"]
N = len(FEATURES)
PAIRS = [(i, j) for i in range(N) for j in range(i + 1)]
MEANS, FACTOR = [f"m{i}" for i in range(N)], [f"c{i}{j}" for i, j in PAIRS]


def factored(estimate: DataFrame) -> DataFrame:
    """Adds the Cholesky factor c** of the covariance v** with the least deviations on its diagonal, and the logarithm of its determinant.

    A column of the factor is made of those before it, so that none is expanded into the next.
    """
    least = [d**2 for d in FEATURES.values()]

    def rest(i: int, j: int) -> str:
        return " - ".join([f"(v{i}{j} + {least[i]})" if i == j else f"v{i}{j}", *(f"c{i}{k} * c{j}{k}" for k in range(j))])

    for j in range(N):
        estimate = estimate.selectExpr("*", f"sqrt(greatest({rest(j, j)}, 1e-12D)) as c{j}{j}")
        if j < N - 1:
            estimate = estimate.selectExpr("*", *(f"({rest(i, j)}) / c{j}{j} as c{i}{j}" for i in range(j + 1, N)))
    return estimate.selectExpr("*", " + ".join(f"2 * ln(c{i}{i})" for i in range(N)) + " as logdet")


def measured(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """rows joined to the estimates of their group, with the squared distance d2 and its class."""
    out = rows.join(estimate.select(*GROUP, "start", *MEANS, *FACTOR), GROUP)
    for i in range(N):
        off = " - ".join([f"(x{i} / {UNIT}D - m{i})", *(f"c{i}{k} * _z{k}" for k in range(i))])
        out = out.selectExpr("*", f"({off}) / c{i}{i} as _z{i}")
    out = out.selectExpr(*rows.columns, "start", " + ".join(f"_z{i} * _z{i}" for i in range(N)) + " as d2")
    return out.selectExpr("*", f"floor(log2(d2 + {2.0**-20}D) * {CLASSES}) as class")


def class_at(rows: DataFrame, share: float) -> DataFrame:
    """For each group and start the least class up to which there is the share of its rows, by counts of classes."""
    counts = rows.groupBy(*GROUP, "start", "class").count()
    told = counts.selectExpr(*GROUP, "start", "class", "sum(count) over (partition by _g0, _g1, start order by class) as upto", "sum(count) over (partition by _g0, _g1, start) as total")
    return told.where(f"upto >= ceil(total * {share}D)").groupBy(*GROUP, "start").agg(F.min("class").alias("bar"))


def starts(rows: DataFrame) -> DataFrame:
    """Three estimates for each group, from medians and median deviations, not yet of a subset of the rows."""

    def half(x: str, name: str) -> Column:
        return F.expr(f"percentile(floor({x} / {COARSE}D), 0.5D) * {COARSE} + {COARSE // 2} as {name}")

    middle = settle(rows.groupBy(*GROUP).agg(*[half(f"x{i}", f"_m{i}") for i in range(N)]))
    off = rows.join(middle, GROUP).groupBy(*GROUP).agg(*[half(f"abs(x{i} - _m{i})", f"_s{i}") for i in range(N)])
    base = settle(middle.join(off, GROUP).selectExpr(*GROUP, *(f"_m{i} / {UNIT}D as m{i}" for i in range(N)), *(f"_s{i} * 1.4826D / {UNIT}D as s{i}" for i in range(N))))
    z = rows.join(base, GROUP)
    z = z.selectExpr(*GROUP, *(f"(x{i} / {UNIT}D - m{i}) / sqrt(s{i} * s{i} + {least**2}D) as _z{i}" for i, least in enumerate(FEATURES.values())))
    z = z.selectExpr("*", "sqrt(" + " + ".join(f"_z{i} * _z{i}" for i in range(N)) + ") as _r")
    z = z.selectExpr(*GROUP, *(f"cast(rint(tanh(_z{i}) * {FINE}) as long) as t{i}" for i in range(N)), *(f"cast(rint(if(_r > 0, _z{i} / _r * {FINE}, 0D)) as long) as u{i}" for i in range(N)))
    sums = z.groupBy(*GROUP).agg(*[F.expr(f"cast(sum({k}{i} * {k}{j}) as double) as {k}{i}{j}") for k in "tu" for i, j in PAIRS])

    def covariance(k: str, i: int, j: int) -> str:
        if i == j:
            return f"s{i} * s{j}"
        if not k:
            return "0D"
        return f"if({k}{i}{i} * {k}{j}{j} > 0, s{i} * s{j} * {k}{i}{j} / sqrt({k}{i}{i} * {k}{j}{j}), 0D)"

    kinds = [f"named_struct('start', {n}, " + ", ".join(f"'v{i}{j}', {covariance(k, i, j)}" for i, j in PAIRS) + ")" for n, k in enumerate(("", "t", "u"))]
    told = base.join(sums, GROUP).selectExpr(*GROUP, *MEANS, f"inline(array({', '.join(kinds)}))")
    return factored(told).selectExpr(*GROUP, "start", *MEANS, *FACTOR, "double('infinity') as logdet", "false as done")


def concentrated(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Means and covariances of the h rows nearest to each estimate; rows that tie with the last in class are among them."""
    near = measured(rows, estimate)
    near = near.join(class_at(near, H), [*GROUP, "start"]).where("class <= bar")
    # sums of products in two halves, none of which overflows
    sums = near.groupBy(*GROUP, "start").agg(*map(F.expr, [
        "count(*) as n", *(f"cast(sum(x{i}) as double) as _x{i}" for i in range(N)),
        *(f"sum(shiftright(x{i} * x{j}, 20)) as _h{i}{j}" for i, j in PAIRS), *(f"sum(x{i} * x{j} & {(1 << 20) - 1}) as _l{i}{j}" for i, j in PAIRS),
    ]))
    mean = [f"_x{i} / n" for i in range(N)]
    spread = [f"((cast(_h{i}{j} as double) * {1 << 20} + _l{i}{j}) / n - ({mean[i]}) * ({mean[j]})) / {UNIT**2}D as v{i}{j}" for i, j in PAIRS]
    return factored(sums.selectExpr(*GROUP, "start", *(f"{m} / {UNIT}D as m{i}" for i, m in enumerate(mean)), *spread)).select(*GROUP, "start", *MEANS, *FACTOR, "logdet")


def least_determinant(rows: DataFrame) -> DataFrame:
    """The estimate of each group: concentration steps from all starts until no determinant falls, then the least one."""
    state = settle(starts(rows))
    while True:
        after = concentrated(rows, state.where("not done")).selectExpr(*GROUP, "start", f"struct({', '.join([*MEANS, *FACTOR, 'logdet'])}) as new")
        both = state.join(after, [*GROUP, "start"], "left").selectExpr("*", f"coalesce(new.logdet < logdet - {LEAST_FALL}, false) as fell")
        moved = settle(both.selectExpr(*GROUP, "start", *(f"if(fell, new.{c}, {c}) as {c}" for c in [*MEANS, *FACTOR, "logdet"]), "not fell as done"))
        drop_settled(state)
        state = moved
        if state.where("not done").isEmpty():
            break
    best = state.groupBy(*GROUP).agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    return state.join(best, [*GROUP, "start"])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, d2, kept, measure.

    base_failed: under MIN_WORDS words, or over MOST_REPEATED % of words in repeated three-word windows.
    Such rows are not kept and take no part in estimates.  Other rows are kept unless d2, the squared robust
    distance in their language and source, exceeds CUT.  Languages and sources with under
    LEAST_ROWS such rows are pooled by language, languages with under LEAST_POOL in their pool are pooled
    together, and where these are under LEAST_POOL too, they are measured by an estimate of all such rows of
    the table, however few.  So each such row has a d2; `measure` tells by what it was judged: base, own, language,
    pool or all.

    Null and empty texts have no words and fail; null languages and sources are groups of their own;
    very long texts are counted whole; repeated rows count each; rows at equal distance are judged alike; an
    empty table gives an empty one; extra columns, whatever their names, are not read.
    Group estimates are small tables joined to the rows: the optimizer broadcasts one if its size allows.
    """
    stats = text_statistics(docs, id_col, text_col, (lang_col, source_col))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    stats = settle(with_features(stats.withColumn("base_failed", failed)))
    none = F.lit("\x00")
    stats = stats.withColumns({"_g0": F.coalesce("g0", none), "_g1": F.coalesce("g1", none)})
    sizes = settle(stats.where("not base_failed").groupBy(*GROUP).count())
    # small groups pool by language, small pools over each other, and a small pool of these is judged by all rows
    by_lang = sizes.where(F.col("count") < LEAST_ROWS).groupBy("_g0").agg(F.sum("count").alias("pool"))
    plan = sizes.join(by_lang, "_g0", "left").select(*GROUP, "count", F.when(F.col("count") >= LEAST_ROWS, 0).when(F.col("pool") >= LEAST_POOL, 1).otherwise(2).alias("level"))
    plan = settle(plan)
    last = plan.where("level = 2").agg(F.sum("count")).first()[0]
    lonely = last is not None and last < LEAST_POOL
    rows = stats.where("not base_failed").join(plan.select(*GROUP, "level"), GROUP)
    pooled = F.lit("\x01")
    rows = rows.withColumns({"_g0": F.when(F.col("level") == 2, pooled).otherwise(F.col("_g0")), "_g1": F.when(F.col("level") >= 1, pooled).otherwise(F.col("_g1"))})
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    measure = F.when(F.col("level") == 0, "own").when(F.col("level") == 1, "language").otherwise("all" if lonely else "pool")
    rows = settle(rows.select("doc_id", *GROUP, *[F.rint(F.col(x) * UNIT).cast("long").alias(x) for x in FEATURES], *counts, measure.alias("measure"), F.lit(True).alias("own")))
    own = rows
    if lonely:
        # the other rows take part in the last pool's estimate, but are judged in their own groups
        rows = rows.unionByName(rows.where(F.col("_g0") != pooled).withColumns({"_g0": pooled, "_g1": pooled, "own": F.lit(False)}))
    points = rows.select(*GROUP, *FEATURES)
    estimate = settle(least_determinant(points))
    # the covariance of the nearest rows is too small: its scale is set by the median distance
    scale = settle(class_at(measured(points, estimate), 0.5).select(*GROUP, F.greatest(F.lit(1.0), F.pow(F.lit(2.0), F.col("bar") / CLASSES) / CHI_MEDIAN).alias("scale")))
    d2 = F.col("d2") / F.col("scale")
    judged = measured(own, estimate).join(scale, GROUP).select("doc_id", *counts, F.lit(False).alias("base_failed"), d2.alias("d2"), (d2 <= CUT).alias("kept"), "measure")
    out = stats.where("base_failed").select("doc_id", *counts, "base_failed", F.lit(None).cast("double").alias("d2"), F.lit(False).alias("kept"), F.lit("base").alias("measure"))
    return judged.unionByName(out)
