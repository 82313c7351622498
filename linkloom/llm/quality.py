"""Quality rules: text statistics, and robust multivariate outliers per language and source.

The minimum covariance determinant is sought by concentration steps: from a start, take the share
of a group's rows nearest to the centre, estimate centre and covariance from them, and repeat; of
several starts the one with the smallest determinant wins.  All sums run over whole numbers, so
that the outcome does not depend on the order of rows.  Everything is DataFrame operations; a
group's rows are only ever summed, and quantiles come from sums over a fixed grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.store import written
from linkloom.operators.normalize import compute_once

_SPACE = "[\\x20\\x09-\\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
#: Unit of the whole-number features: sums of squares stay below 2**63 for 10**10 rows a group.
_UNIT = 1000
_GRID = 50
#: Least standard deviation of each feature (log words, log word length, log1p of 1,000 symbols a
#: letter, and log1p of per cent of repeated lines and words): groups whose rows mostly share one
#: value would have a singular covariance without it.
FLOORS = (0.5, 0.1, 0.5, 0.7, 0.7)
_P = len(FLOORS)


def _without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def text_statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of each row.

    Words are runs without ASCII white space; a null text has none.  ``n_lines`` counts lines with a
    word.  Three-word windows are compared by 64-bit hashes and sorted once, so a text of n words
    takes n log n steps.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(_without(x, _SPACES)) > 0)
    df = docs.select(*(docs[c].alias(c) for c in keep), text.alias("_text"))
    df = df.select(
        *keep, F.length(_without(F.col("_text"), _SPACES)).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(_without(F.col("_text"), _SYMBOLS))).cast("long").alias("n_symbols"),
        F.transform(F.filter(F.split("_text", _SPACE), lambda x: x != ""), lambda x: F.xxhash64(x)).alias("_words"),
        lines.alias("_lines"),
    )
    df = compute_once(compute_once(df, "_w", F.col("_words")), "_l", F.col("_lines")).drop("_words", "_lines")
    n = F.size("_w")
    window = F.transform(
        F.slice("_w", 1, F.greatest(n - 2, F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x, F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("i")))
    df = df.select(*keep, "word_chars", "n_symbols", n.cast("long").alias("n_words"), F.size("_l").cast("long").alias("n_lines"),
                   (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"), F.sort_array(window).alias("_sorted"))
    df = compute_once(df, "_s", F.col("_sorted")).drop("_sorted")
    at = lambda j: F.get("_s", j)["h"]
    twice = F.filter("_s", lambda x, j: F.coalesce(at(j - 1) == x["h"], F.lit(False)) | F.coalesce(at(j + 1) == x["h"], F.lit(False)))
    df = df.withColumn("_p", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("_s")
    df = compute_once(df, "_at", F.col("_p")).drop("_p")
    covered = F.transform("_at", lambda x, j: F.least(F.lit(3), F.coalesce(F.get("_at", j + 1) - x, F.lit(3))))
    repeat = F.aggregate(covered, F.lit(0).cast("long"), lambda total, x: total + x)
    return df.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", repeat.alias("n_repeat_words"), "n_lines")


def _features() -> list[Column]:
    words, letters = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    share = lambda top, bottom, by: F.log1p(F.lit(float(by)) * F.col(top) / bottom)
    raw = [F.log(words), F.log(letters / words), share("n_symbols", letters, 1000),
           share("n_dup_lines", F.greatest(F.col("n_lines"), F.lit(1)), 100), share("n_repeat_words", words, 100)]
    return [F.round(x * _UNIT).cast("long") for x in raw]


def _grid_quantile(df: DataFrame, keys: list[str], bin_col: str, share: float, name: str) -> DataFrame:
    """(keys, least bin by which ``share`` of the key's rows are reached, rows); bins are whole numbers."""
    counts = df.groupBy(*keys, bin_col).agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy(*keys).orderBy(bin_col)
    total = Window.partitionBy(*keys)
    return (
        counts.withColumn("_up", F.sum("_c").over(running)).withColumn("_all", F.sum("_c").over(total))
        .where(F.col("_up") >= F.ceil(F.col("_all") * share))
        .groupBy(*keys).agg(F.min(bin_col).alias(name), F.max("_all").alias("_rows"))
    )


def _estimate(members: DataFrame, keys: list[str]) -> DataFrame:
    """Centre, inverse Cholesky factor and log-determinant of each key's rows, floors added."""
    sums = [F.sum(f"_x{i}").alias(f"_s{i}") for i in range(_P)]
    products = [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_q{i}{j}") for i in range(_P) for j in range(i + 1)]
    df = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *sums, *products)
    df = df.select(*keys, *((F.col(f"_s{i}") / F.col("_n")).alias(f"_m{i}") for i in range(_P)),
                   *((F.col(f"_q{i}{j}") / F.col("_n")).alias(f"_q{i}{j}") for i in range(_P) for j in range(i + 1)))
    for i in range(_P):
        for j in range(i + 1):
            rest = F.col(f"_q{i}{j}") - F.col(f"_m{i}") * F.col(f"_m{j}")
            if i == j:
                rest = F.greatest(rest, F.lit(0.0)) + (FLOORS[i] * _UNIT) ** 2
            for k in range(j):
                rest = rest - F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}")
            # rounding can take a pivot to zero; it cannot fall below the floor's own share
            value = F.sqrt(F.greatest(rest, F.lit((0.01 * FLOORS[i] * _UNIT) ** 2))) if i == j else rest / F.col(f"_l{j}{j}")
            df = df.withColumn(f"_l{i}{j}", value)
    log_det = sum((F.log(f"_l{i}{i}") for i in range(_P)), F.lit(0.0))
    return df.select(*keys, *(f"_m{i}" for i in range(_P)), *(f"_l{i}{j}" for i in range(_P) for j in range(i + 1)), log_det.alias("_det"))


def _distance(df: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``_d`` of rows that carry an estimate, by forward substitution."""
    for i in range(_P):
        rest = F.col(f"_x{i}") - F.col(f"_m{i}")
        for k in range(i):
            rest = rest - F.col(f"_l{i}{k}") * F.col(f"_y{k}")
        df = df.withColumn(f"_y{i}", rest / F.col(f"_l{i}{i}"))
    return df.withColumn("_d", sum((F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(_P)), F.lit(0.0)))


def _bin(distance: Column) -> Column:
    return F.floor(F.log(F.greatest(distance, F.lit(1e-6))) * _GRID).cast("long")


def _chi2_median(p: int) -> float:
    return p * (1 - 2 / (9 * p)) ** 3


def quality_verdicts(docs: DataFrame, cutoff: float = 60.0, share: float = 0.75, steps: int = 3, min_rows: int = 200,
                     max_groups: int = 20_000, min_words: int = 50, max_repeat_percent: int = 50, id_col: str = "doc_id",
                     lang_col: str = "lang", source_col: str = "source", text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """Statistics, base rules and the outlier verdict of each row.

    Columns: the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    distance, kept.  Base rules reject texts under ``min_words`` words or with more than
    ``max_repeat_percent`` per cent of words in repeated three-word windows.  The others' features
    (logarithms of length, word length, and shares of symbols, repeated lines and repeated words)
    are compared with their language's and source's estimate; a squared distance over ``cutoff``
    rejects.  Distances are divided by the group's median distance over its expected value where
    that is above 1.  Groups under ``min_rows`` rows use the estimate over all rows.  ``cutoff`` 60
    lies far beyond the 0.999999 quantile for five features (37), so that ordinary texts stay.

    Null texts have no words and fail the base rules; a null language or source is a group of its own;
    repeated rows count each; an empty table gives no rows; other columns are ignored.
    """
    keep = (id_col, lang_col, source_col, *extra)
    stats = text_statistics(docs, text_col, keep)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    group = F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in (lang_col, source_col)))
    stats = written(
        stats.withColumn("base_failed", failed).withColumn("_g", group)
        .withColumns({f"_x{i}": x for i, x in enumerate(_features())}), "text-statistics")

    xs = [f"_x{i}" for i in range(_P)]
    passed = stats.where(~F.col("base_failed")).select("_g", *xs)
    sizes = written(passed.groupBy("_g").agg(F.count(F.lit(1)).alias("_rows")), "group-sizes")
    # the estimates are a row a group and start; broadcast them only where groups are proven few
    small = sizes.count() <= max_groups
    hint = F.broadcast if small else (lambda df: df)
    pooled = passed.withColumn("_g", F.explode(F.array("_g", F.lit("*"))))

    # start 0: robust z-scores from medians and median deviations; start 1: all rows
    long = pooled.select("_g", F.posexplode(F.array(*xs)).alias("_k", "_v")).withColumn("_b", F.floor(F.col("_v") / 10).cast("long"))
    middle = written(_grid_quantile(long, ["_g", "_k"], "_b", 0.5, "_mid").select("_g", "_k", "_mid"), "medians")
    off = long.join(hint(middle), ["_g", "_k"]).withColumn("_o", F.abs(F.col("_b") - F.col("_mid")))
    spread = _grid_quantile(off, ["_g", "_k"], "_o", 0.5, "_dev").select("_g", "_k", "_dev")
    wide = middle.join(spread, ["_g", "_k"]).groupBy("_g").agg(
        *(F.max(F.when(F.col("_k") == i, F.col("_mid") * 10.0 + 5)).alias(f"_m{i}") for i in range(_P)),
        *(F.max(F.when(F.col("_k") == i, F.greatest(F.col("_dev") * 14.826, F.lit(FLOORS[i] * _UNIT)))).alias(f"_l{i}{i}") for i in range(_P)))
    factor = {f"_l{i}{j}": F.lit(0.0) for i in range(_P) for j in range(i)}
    robust = wide.withColumns(factor).withColumn("_det", F.lit(0.0)).withColumn("_start", F.lit(0))
    classic = _estimate(pooled, ["_g"]).withColumn("_start", F.lit(1))
    now = written(robust.unionByName(classic), "start")

    for step in range(steps):
        near = _distance(pooled.join(hint(now), "_g")).withColumn("_b", _bin(F.col("_d"))).select("_g", "_start", "_b", *xs)
        limit = written(_grid_quantile(near, ["_g", "_start"], "_b", share, "_most"), f"nearest-{step}")
        subset = near.join(hint(limit.select("_g", "_start", "_most")), ["_g", "_start"]).where("_b <= _most")
        now = written(_estimate(subset, ["_g", "_start"]), f"concentrated-{step}")

    best = now.groupBy("_g").agg(F.min(F.struct("_det", "_start")).alias("_w")).select("_g", F.col("_w._start").alias("_start"))
    best = written(now.join(best, ["_g", "_start"]).drop("_start", "_det"), "estimates")
    medians = _grid_quantile(_distance(pooled.join(hint(best), "_g")).withColumn("_b", _bin(F.col("_d"))), ["_g"], "_b", 0.5, "_half")
    scaled = written(
        best.join(medians, "_g").withColumn("_scale", F.greatest(F.exp((F.col("_half") + 0.5) / _GRID) / _chi2_median(_P), F.lit(1.0)))
        .drop("_half"), "scaled")

    chosen = stats.join(hint(sizes), "_g", "left").withColumn("_g", F.when(F.col("_rows") >= min_rows, F.col("_g")).otherwise("*")).drop("_rows")
    judged = _distance(chosen.join(hint(scaled.drop("_rows")), "_g", "left")).withColumn("distance", F.col("_d") / F.col("_scale"))
    return judged.select(
        id_col, *extra, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))).alias("kept"))
