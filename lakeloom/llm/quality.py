"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated five-word
windows of a text. Documents that pass them form cells by language and source
(small cells join their language's rest, and a small rest joins the rest of
all), and each cell gets a regularised minimum-covariance-determinant estimate
of four transformed statistics (Rousseeuw and Van Driessen 1999; Boudt et al.
2020): of all weightings that keep ``SHARE`` of the cell's mass, the one whose
covariance, made consistent and raised by a floor on each variance, has the
least determinant. Concentration steps give the mass to the documents nearest
to the current estimate; they set out from four deterministic starts (Hubert,
Rousseeuw and Verdonck 2012): medians with robust scales, correlations of
squashed scores, spatial signs, and the plain mean and covariance. After
``STEPS`` steps the start of least determinant goes on until the determinants
settle. A reweighting step ends the fit, and a document is rejected by a
squared Mahalanobis distance above the chi-squared quantile of ``TAIL``.

Quantiles come from exact counts over fixed bins, so all documents count and
the state is bounded; the documents of the bin at which the mass is reached
share what is left of it, so the mass is exact. Estimates per cell are sent to
the documents, which are never shuffled by cell, and tasks send one row of sums
per cell.

Edge cases: a null text has no words and fails the base rules, as do empty and
blank ones; null languages and sources are cells of their own; cells of under
``LEAST`` documents (which only the rest of all can be) reject nothing;
repeated rows are judged each, alike; an
empty table gives an empty table; carried columns ride in one struct, so they
may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize

#: Mass of a cell that its estimate rests on; up to the rest may be outliers.
SHARE = 0.6
#: Steps that all starts take; the best one goes on from there.
STEPS = 2
#: Fall of a log-determinant from which its cell takes another step.
SETTLED = 1e-4
INNER, TAIL = 0.975, 1e-6
#: Documents that a cell needs for an estimate of its own.
LEAST = 40
#: Least standard deviations of the statistics.
FLOORS = (0.1, 0.2, 0.3, 0.3)
#: Words that damp the ratios of short texts, and their mean length.
PRIOR_WORDS, PRIOR_LENGTH = 20, 5
WINDOW = 5
#: Cells up to which estimates are broadcast; some 500 bytes each and start.
BROADCAST_CELLS = 20_000
_P = len(FLOORS)
_PAIRS = [(i, j) for i in range(_P) for j in range(i + 1)]
_BLANK = r" \t\n\x0B\f\r"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, as a lambda's variable."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in some window found twice or more in ``words``."""

    def gram(w: Column, i: Column) -> list[Column]:
        return [F.get(w, i + k) for k in range(window)]

    def covered(at: Column) -> Column:
        """Union length of the windows that start at the sorted positions."""
        gap = lambda acc, k: acc + F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - F.get(at, k), F.lit(window)))
        each = F.sequence(F.lit(0), F.size(at) - 1)
        return F.when(F.size(at) == 0, 0).otherwise(F.aggregate(each, F.lit(0), gap))

    def exact(w: Column) -> Column:
        """Sort windows with their positions; equal neighbours are repeats."""
        keyed = F.transform(
            F.sequence(F.lit(0), F.size(w) - window),
            lambda i: F.struct(F.xxhash64(*gram(w, i)).alias("h"), F.concat_ws(" ", *gram(w, i)).alias("g"), i.alias("i")),
        )

        def repeats(s: Column) -> Column:
            text = lambda k: F.get(s, k)["g"]
            same = lambda k: F.coalesce(text(k) == text(k - 1), F.lit(False)) | F.coalesce(text(k) == text(k + 1), F.lit(False))
            each = F.filter(F.sequence(F.lit(0), F.size(s) - 1), same)
            return F.array_sort(F.transform(each, lambda k: F.get(s, k)["i"]))

        return let(let(F.array_sort(keyed), repeats), covered)

    def counted(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - window), lambda i: F.xxhash64(*gram(w, i)))
        # Most texts repeat no window: their hashes are all distinct.
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(exact(w)))

    return let(words, lambda w: F.when(F.size(w) <= window, 0).otherwise(counted(w)))


def base_statistics(df: DataFrame, text_col: str, lang: str, source: str, carry: Sequence[str]) -> DataFrame:
    """Row struct, grouping columns, the base counts and their verdict."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(text, f"[{_BLANK}]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{_BLANK}]"))
    cut = df.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.col(lang).cast("string").alias("lang"),
        F.col(source).cast("string").alias("source"),
        words.alias("words"),
        lines.alias("lines"),
        (F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
    )
    counts = cut.select(
        "row",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counts.withColumn("base_failed", failed)


def _statistics() -> list[Column]:
    n = F.col("n_words") + PRIOR_WORDS
    ratio = lambda c: F.log1p(10 * F.col(c) / n)
    length = F.log((F.col("word_chars") + PRIOR_WORDS * PRIOR_LENGTH) / n)
    return [length, ratio("n_symbols"), ratio("n_dup_lines"), ratio("n_repeat_words")]


def chi2_cdf(x: float, dof: int) -> float:
    """Of an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))


def chi2_quantile(p: float, dof: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dof) < p else (low, mid)
    return high


def consistency(share: float = SHARE, dof: int = _P) -> float:
    return share / chi2_cdf(chi2_quantile(share, dof), dof + 2)


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    y: list[Column] = []
    for i in range(_P):
        rest = reduce(lambda a, j: a - F.col(f"l{i}{j}") * y[j], range(i), F.col(f"x{i}") - F.col(f"m{i}"))
        y.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in y[1:]), y[0] * y[0])


def _bin(d2: Column) -> Column:
    return F.floor(F.log1p(d2) * 64)


def _reached(rows: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Per key the bin ``cut`` at which ``share`` of the rows is reached, and the ``part`` of it that this takes.

    Rows are counted by key and bin first, so a hot key sends one row per bin
    to its window.
    """
    seen = rows.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    whole = Window.partitionBy(*keys)
    before = F.sum("n").over(whole.orderBy("bin")) - F.col("n")
    need = seen.withColumns({"before": before, "need": share * F.sum("n").over(whole)})
    at = need.filter((F.col("before") < F.col("need")) & (F.col("need") <= F.col("before") + F.col("n")))
    return at.select(*keys, F.col("bin").alias("cut"), ((F.col("need") - F.col("before")) / F.col("n")).alias("part"))


def _sums(rows: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """Sums per key; tasks send one row per key, however hot it is."""
    return rows.groupBy(*keys).agg(*[F.sum(v).alias(name) for name, v in values.items()])


def _moments(x: list[Column], w: Column) -> dict[str, Column]:
    return {"n": w, **{f"m{i}": w * x[i] for i in range(_P)}, **{f"s{i}{j}": w * x[i] * x[j] for i, j in _PAIRS}}


def _factored(found: DataFrame) -> DataFrame:
    """Centres m and covariances s -> centres, Cholesky factors l of the floored covariance, and its log-determinant."""
    keys = [c for c in ("cell", "start") if c in found.columns]
    for j in range(_P):
        less = lambda i: reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"s{i}{j}"))
        spread = F.greatest(F.col(f"s{j}{j}"), F.lit(0.0)) + FLOORS[j] ** 2 + less(j) - F.col(f"s{j}{j}")
        found = found.withColumn(f"l{j}{j}", F.sqrt(F.greatest(spread, F.lit(FLOORS[j] ** 2 / 4))))
        found = found.withColumns({f"l{i}{j}": less(i) / F.col(f"l{j}{j}") for i in range(j + 1, _P)})
    log_det = 2 * sum((F.log(f"l{i}{i}") for i in range(1, _P)), F.log("l00"))
    return found.select(*keys, *[f"m{i}" for i in range(_P)], *[f"l{i}{j}" for i, j in _PAIRS], log_det.alias("log_det"))


def _estimate(rows: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Mean and covariance of the statistics per key, factored."""
    xs = [f"x{i}" for i in range(_P)]
    return _shaped(_sums(rows.select(*keys, *xs), keys, _moments([F.col(x) for x in xs], F.lit(1.0))), factor)


def _shaped(found: DataFrame, factor: float) -> DataFrame:
    """Sums of moments -> mean and covariance, factored."""
    found = found.withColumns({f"m{i}": F.col(f"m{i}") / F.col("n") for i in range(_P)})
    cov = lambda i, j: factor * (F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))
    return _factored(found.withColumns({f"s{i}{j}": cov(i, j) for i, j in _PAIRS}))


def _cells(rows: DataFrame) -> DataFrame:
    """The cell of each group that has documents to fit, and the cell's documents."""
    groups = rows.filter("not base_failed").groupBy("lang_key", "key").agg(F.count("*").alias("n"))
    small = groups.filter(F.col("n") < LEAST).groupBy("lang_key").agg(F.sum("n").alias("rest"))
    rest = F.when(F.col("rest") >= LEAST, F.col("lang_key")).otherwise("")
    named = groups.join(small, "lang_key", "left")
    named = named.withColumn("cell", F.when(F.col("n") >= LEAST, F.col("key")).otherwise(rest))
    return named.select("key", "cell", F.sum("n").over(Window.partitionBy("cell")).alias("documents"))


def _starts(rows: DataFrame, send: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Four estimates per cell: rows (cell, start, centre, factor)."""
    widths = [f / 8 for f in FLOORS]

    def middle(x: list[Column], of: DataFrame, name: str) -> DataFrame:
        bins = F.array(*[F.floor(v / w) for v, w in zip(x, widths)])
        cut = _reached(of.select("cell", F.posexplode(bins).alias("i", "bin")), ["cell", "i"], 0.5)
        at = lambda i, w: F.max(F.when(F.col("i") == i, (F.col("cut") + 0.5) * w)).alias(f"{name}{i}")
        return cut.groupBy("cell").agg(*[at(i, w) for i, w in enumerate(widths)])

    xs = [F.col(f"x{i}") for i in range(_P)]
    centre = materialize(middle(xs, rows, "c"), "centre")
    away = middle([F.abs(x - F.col(f"c{i}")) for i, x in enumerate(xs)], rows.join(send(centre), "cell"), "q")
    scaled = {f"q{i}": F.greatest(F.lit(FLOORS[i]), 1.4826 * F.col(f"q{i}")) for i in range(_P)}
    robust = materialize(centre.join(away, "cell").withColumns(scaled), "scale")
    name = lambda kind: [F.col(f"{kind}{i}") for i in range(_P)]
    scored = rows.join(send(robust), "cell")
    scored = scored.select("cell", *xs, *[((xs[i] - F.col(f"c{i}")) / F.col(f"q{i}")).alias(f"z{i}") for i in range(_P)])
    scored = scored.withColumns({**{f"t{i}": F.tanh(v) for i, v in enumerate(name("z"))}, "norm": sum(v * v for v in name("z"))})
    scored = scored.withColumns({f"g{i}": F.when(F.col("norm") > 0, v / F.sqrt("norm")).otherwise(0.0) for i, v in enumerate(name("z"))})
    sums = {f"t_{k}": v for k, v in _moments(name("t"), F.lit(1.0)).items()}
    sums |= {f"g_{i}{j}": F.col(f"g{i}") * F.col(f"g{j}") for i, j in _PAIRS}
    sums |= {f"p_{k}": v for k, v in _moments(xs, F.lit(1.0)).items()}
    found = _sums(scored, ["cell"], sums).join(robust, "cell")
    n = F.col("p_n")
    mean = lambda kind, *at: F.col(f"{kind}_{'m' if len(at) == 1 else 's'}{''.join(map(str, at))}") / n
    cov = lambda kind, i, j: mean(kind, i, j) - mean(kind, i) * mean(kind, j)
    scale = lambda i, j: F.col(f"q{i}") * F.col(f"q{j}")
    deviation = lambda i: F.sqrt(F.greatest(cov("t", i, i), F.lit(1e-9)))
    same = lambda i, j: F.lit(float(i == j))
    scatter = [
        lambda i, j: scale(i, j) * same(i, j),
        lambda i, j: scale(i, j) * (same(i, j) if i == j else cov("t", i, j) / (deviation(i) * deviation(j))),
        lambda i, j: scale(i, j) * _P * F.col(f"g_{i}{j}") / n,
        lambda i, j: cov("p", i, j),
    ]
    each = [
        F.struct(
            F.lit(k).alias("start"),
            *[(mean("p", i) if k == len(scatter) - 1 else F.col(f"c{i}")).alias(f"m{i}") for i in range(_P)],
            *[of(i, j).alias(f"s{i}{j}") for i, j in _PAIRS],
        )
        for k, of in enumerate(scatter)
    ]
    return _factored(found.select("cell", F.explode(F.array(*each)).alias("e")).select("cell", "e.*"))


def _concentrate(rows: DataFrame, params: DataFrame, send: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One step of every (cell, start): the estimate over the mass nearest to the last one.

    One pass over the rows: moments are summed by bin of distance, and the
    bins below the mass' border, with the part of its own that it takes, add
    up to those of the mass.
    """
    keys, xs = ["cell", "start"], [F.col(f"x{i}") for i in range(_P)]
    near = rows.join(send(params), "cell").withColumn("bin", _bin(_distance()))
    moments = _moments(xs, F.lit(1.0))
    binned = _sums(near, [*keys, "bin"], moments)
    whole = Window.partitionBy(*keys)
    before = F.sum("n").over(whole.orderBy("bin")) - F.col("n")
    part = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (SHARE * F.sum("n").over(whole) - before) / F.col("n")))
    parts = binned.withColumn("part", part).filter("part > 0")
    found = parts.groupBy(*keys).agg(*[F.sum(F.col("part") * F.col(m)).alias(m) for m in moments])
    new = _shaped(found, consistency())
    return materialize(new.join(send(params.select(*keys, F.col("log_det").alias("was"))), keys), "params")


def least_determinant(rows: DataFrame, send: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The raw estimate per cell from rows (cell, x0, x1, ...).

    All starts take ``STEPS`` steps. The best one of each cell goes on as long
    as its determinant falls; a cell that has settled takes no more part.
    Every further step lowers a log-determinant, which the floors bound, by
    ``SETTLED``, so this ends.
    """
    params = materialize(_starts(rows, send), "starts")
    for _ in range(STEPS):
        params = _concentrate(rows, params, send)
    every = [c for c in params.columns if c not in ("cell", "was")]
    best = params.groupBy("cell").agg(F.min_by(F.struct(*every), F.struct("log_det", "start")).alias("e"))
    going, settled = materialize(best.select("cell", "e.*"), "best"), []
    falls = F.coalesce(F.col("log_det") < F.col("was") - SETTLED, F.lit(False))
    while True:
        moved = _concentrate(rows, going, send)
        settled.append(moved.filter(~falls))
        going = moved.filter(falls).drop("was")
        if going.isEmpty():
            return reduce(DataFrame.unionByName, settled)


def fit(rows: DataFrame, send: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Estimates per cell from rows (cell, x0, x1, ...); one row per cell."""
    raw = least_determinant(rows, send)
    inner = rows.join(send(raw), "cell").filter(_distance() <= chi2_quantile(INNER, _P))
    xs = [f"x{i}" for i in range(_P)]
    return materialize(_estimate(inner.select("cell", *xs), ["cell"], consistency(INNER)), "params")


def assess(
    df: DataFrame,
    carry: Sequence[str] | None = None,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Rows (row, base counts, base_failed, distance, kept), one per input row.

    ``row`` is a struct of the carried columns, all by default; ``distance``
    is null where the base rules or too small a cell decide.
    """
    carry = df.columns if carry is None else carry
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    rows = base_statistics(df, text_col, lang_col, source_col, carry)
    rows = rows.withColumns({"lang_key": F.concat(key("lang"), F.lit("\x1f")), "key": F.concat(key("lang"), F.lit("\x1f"), key("source"))})
    rows = materialize(rows, "statistics")
    cells = materialize(_cells(rows), "cells")
    # Tables of a few rows per cell go to every task if the cells were counted to be few.
    few = cells.agg(F.count("*")).first()[0] <= BROADCAST_CELLS
    send = F.broadcast if few else lambda df: df
    celled = rows.join(send(cells), "key", "left")
    for i, x in enumerate(_statistics()):
        celled = celled.withColumn(f"x{i}", x)
    fitted = materialize(celled.filter("not base_failed").select("cell", *[f"x{i}" for i in range(_P)]), "fitted")
    judged = celled.join(send(fit(fitted, send)), "cell", "left")
    distance = F.when(~F.col("base_failed") & (F.col("documents") >= LEAST), _distance())
    far = F.coalesce(F.col("distance") > chi2_quantile(1 - TAIL, _P), F.lit(False))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = judged.select("row", *counts, "base_failed", distance.alias("distance"))
    return judged.withColumn("kept", ~F.col("base_failed") & ~far)


def op2_robust_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = assess(docs, carry=["doc_id"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(F.col("row.doc_id").alias("doc_id"), *counts, "base_failed", "kept", "distance")
