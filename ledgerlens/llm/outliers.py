"""Quality rules: word statistics of each text and robust multivariate outliers per language and source.

`statistics` counts words, symbols, repeated lines and repeated five-word windows of whole texts. `fit` estimates centre
and scatter of the transformed counts for every (language, source) by the minimum-covariance-determinant method: from
STARTS rows drawn by hash, concentration steps keep the half of the rows nearest to the last estimate; the start whose half
has the least determinant wins, and its scatter is made consistent with the normal distribution. `judge` rejects rows
whose squared Mahalanobis distance passes CUTOFF.

Features (all 0 or typical for prose): log of the mean word length against the group's median, square roots of symbols,
repeated lines and repeated words per word. As many words as the group's median text has are added to each text, with the
usual length and without marks or repeats, so that one mark in a short text weighs no more than in a usual one. Features
are rounded to integers of 1/UNIT, so sums are exact and reruns agree whatever the row order.

Most texts have no symbol and no repeat at all, which makes their scatter zero (and the determinant). What a text of the
group's median length can resolve is therefore added to the scatter: one count, or the error of its mean word length if
the lengths of words spread by LENGTH_SPREAD of their mean. That is also the scatter around a start, which is one row: a
draw of five rows, as the plain form takes, is rarely free of outliers where they are two fifths of a group.

A group with fewer than LEAST rows takes its language's estimate, and a language with fewer takes that of all rows.
Null texts are empty; texts without words get zero features; null languages and sources are groups of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import grid
from ledgerlens.llm.common import WORDS_PER_SHINGLE, map_arrow, saved

UNIT = 4000
FEATURES = 4
# Standard deviation of the lengths of words in one text, as a share of their mean.
LENGTH_SPREAD = 0.5
# Share of rows that a concentration step keeps, the drawn starts, and the steps from each.
SUBSET = 0.5
STARTS = 7
STEPS = 5
# Squared distance above which a row is an outlier: the 1 - 1e-6 quantile of chi-squared with FEATURES degrees of freedom.
CUTOFF = 33.38
LEAST = 50
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _counts(chunk: grid.Chunk) -> list[np.ndarray]:
    data = chunk.data
    repeats = np.zeros(chunk.rows, np.int64)
    hashes, row, n_words = chunk.shingles(WORDS_PER_SHINGLE, lower=False)
    if len(hashes):
        key = grid.mix(hashes ^ grid.mix(row.astype(grid.U)))
        _, back, seen = np.unique(key, return_inverse=True, return_counts=True)
        again = seen[back] > 1
        steps = np.zeros(int(n_words.sum()) + 1, np.int64)
        at = chunk.run_at[again]
        steps[at] += 1
        np.subtract.at(steps, at + WORDS_PER_SHINGLE, 1)
        covered = np.cumsum(steps[:-1]) > 0
        repeats = np.add.reduceat(np.append(covered, False).astype(np.int64), np.minimum(np.cumsum(n_words) - n_words, len(covered)))
        repeats[n_words == 0] = 0
    solid = ~grid._BLANK[data]
    letters = chunk.per_row(solid & ((data & 0xC0) != 0x80))
    # Lines end at a line feed or the end of the text.
    feeds = np.flatnonzero(data == 10)
    ends = np.sort(np.concatenate([feeds, chunk.offsets[1:]]))
    starts = np.sort(np.concatenate([chunk.offsets[:-1], feeds + 1]))
    line_row = np.sort(np.concatenate([np.arange(chunk.rows), chunk.row_of(feeds)]))
    full = np.zeros(len(data) + 1, np.int64)
    np.cumsum(solid, out=full[1:])
    worded = full[ends] > full[starts]
    starts, ends, line_row = starts[worded], ends[worded], line_row[worded]
    key = grid.mix(chunk.span(chunk.prefix(), starts, ends, chunk.data) ^ grid.mix(line_row.astype(grid.U)))
    _, first = np.unique(key, return_index=True)
    doubles = np.bincount(line_row, minlength=chunk.rows) - np.bincount(line_row[first], minlength=chunk.rows)
    return [n_words, letters, chunk.per_row(_SYMBOL[data]), doubles, repeats]


def statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """One row per row of df: the id, the keys and COUNTS (long). Repeated rows are counted each."""
    narrow = df.select(F.col(id_col), *[F.col(k) for k in keys], F.col(text_col).alias("__text"))
    kept = len(keys) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_counts(c) for c in grid.chunks(batch.column(kept))]
            found = [np.concatenate(x).astype(np.int64) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *map(pa.array, found)], [*batch.schema.names[:kept], *COUNTS])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:kept])
    return map_arrow(narrow, count, types + "".join(f", {c} long" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _usual() -> list[Column]:
    """Logarithms of the median text's words and mean word length, from rounded values: an exact median of few distinct ones."""
    half, times = F.lit(0.5), F.col("__n")
    words, length = F.log(F.col("n_words").cast("double")), F.log(F.col("word_chars") / F.col("n_words"))
    return [F.percentile(F.round(words, 2), half, times).alias("__p"), F.percentile(F.round(length, 3), half, times).alias("__l")]


def _features() -> list[Column]:
    """z0.. of the counts under the group's __p and __l."""
    usual = F.exp("__p")
    words = F.col("n_words") + usual
    length = F.log((F.col("word_chars") + usual * F.exp("__l")) / words) - F.col("__l")
    counts = [F.sqrt(F.col(c) / words) for c in ("n_symbols", "n_dup_lines", "n_repeat_words")]
    return [F.round(x * UNIT).cast("long").alias(f"z{i}") for i, x in enumerate([length, *counts])]


Z = [f"z{i}" for i in range(FEATURES)]
PAIRS = [(i, j) for i in range(FEATURES) for j in range(i, FEATURES)]
CENTRE, WEIGHTS = [f"m{i}" for i in range(FEATURES)], [f"w{i}{j}" for i, j in PAIRS]
GROUP = ["__g", "__p", "__l"]


def _sums() -> list[Column]:
    """Rows, sums and sums of products over points, each of which stands for __n rows."""
    return [F.sum("__n").alias("__n"), *[F.sum(F.col("__n") * F.col(z)).alias(f"s{i}") for i, z in enumerate(Z)],
            *[F.sum(F.col("__n") * F.col(Z[i]) * F.col(Z[j])).alias(f"s{i}{j}") for i, j in PAIRS]]


def resolution(words: float) -> np.ndarray:
    """Deviations of the features that a text of so many words, as many added, can resolve."""
    count = math.sqrt(1 / (2 * words))
    return np.array([LENGTH_SPREAD / (2 * math.sqrt(words)), count, count, count])


def _chi2(x: float, degrees: int) -> float:
    """Distribution function of chi-squared with an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(degrees // 2))


def consistency(share: float) -> float:
    """What the scatter of the nearest share of normal rows is multiplied with to be that of all rows."""
    if share >= 1:
        return 1.0
    low, high = 0.0, 200.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2(middle, FEATURES) < share else (low, middle)
    return share / _chi2(low, FEATURES + 2)


def _estimate(sums: DataFrame, last: bool = False) -> DataFrame:
    """Centre, inverse scatter and its determinant for each row of sums (one per group and start); the last one is made consistent."""
    def solve(batches):
        for frame in batches:
            rows = []
            for r in frame.to_dict("records"):
                mean = np.array([r[f"s{i}"] for i in range(FEATURES)], float) / r["__n"]
                scatter = np.zeros((FEATURES, FEATURES))
                for i, j in PAIRS:
                    scatter[i, j] = scatter[j, i] = r[f"s{i}{j}"] / r["__n"] - mean[i] * mean[j]
                scatter, least = scatter / UNIT ** 2, np.diag(np.square(resolution(math.exp(r["__p"]))))
                found = np.linalg.inv((consistency(r["__n"] / r["__all"]) if last else 1.0) * scatter + least)
                rows.append([*[r[k] for k in GROUP], r["__s"], np.linalg.det(scatter + least), *(mean / UNIT), *[found[i, j] for i, j in PAIRS]])
            yield type(frame)(rows, columns=[*GROUP, "__s", "__det", *CENTRE, *WEIGHTS])

    return sums.mapInPandas(solve, "__g string, __p double, __l double, __s int, " + ", ".join(f"{c} double" for c in ["__det", *CENTRE, *WEIGHTS]))


def distance() -> Column:
    """Squared Mahalanobis distance of z0.. under m0.., w00.."""
    d = [F.col(f"z{i}") / UNIT - F.col(f"m{i}") for i in range(FEATURES)]
    return sum((d[i] * d[j] * F.col(f"w{i}{j}") * (1 if i == j else 2) for i, j in PAIRS), F.lit(0.0))


def _starts(points: DataFrame) -> DataFrame:
    """STARTS rows of each group, drawn by hash with the chance of a point following its rows (least of exponential draws)."""
    def drawn(start: int) -> Column:
        even = (F.shiftrightunsigned(F.xxhash64(F.lit(start), "__g", *Z), 11) + 1) / F.lit(2.0 ** 53)
        return F.min_by(F.struct(F.lit(start).alias("__s"), *Z), F.struct(-F.log(even) / F.col("__n"), *Z))

    each = points.groupBy(*GROUP).agg(F.array(*[drawn(k) for k in range(STARTS)]).alias("__starts"))
    each = each.select(*GROUP, F.explode("__starts").alias("__at")).select(*GROUP, "__at.*").withColumn("__n", F.lit(1).cast("long"))
    return each.groupBy(*GROUP, "__s").agg(*_sums()).withColumn("__all", F.col("__n"))


def fit(points: DataFrame) -> DataFrame:
    """Estimates (GROUP, m*, w*) of each group of points (GROUP, z*, and __n, the rows that a point stands for).

    Each step keeps the rows within the distance that holds SUBSET of the group. That distance is read from a histogram of
    distances with bins of a 1/16 power of two: exact counts, at most a few hundred bins for each group and start, no sorting of
    a group in one task.
    """
    model = saved(_estimate(_starts(points)), "mcd")
    for step in range(STEPS):
        # Zero distance falls into the lowest bin.
        bin_ = F.floor(F.log2(F.greatest(distance(), F.lit(2.0 ** -20))) * 16).cast("int")
        near = points.join(model.drop("__p", "__l"), "__g").select(*points.columns, "__s", bin_.alias("__bin"))
        bins = near.groupBy(*GROUP, "__s", "__bin").agg(*_sums())
        # A bin is kept while fewer than SUBSET of the group lie in the bins before it.
        w = Window.partitionBy("__g", "__s")
        before = F.coalesce(F.sum("__n").over(w.orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        held = bins.withColumns({"__before": before, "__all": F.sum("__n").over(w)}).where(F.col("__before") < SUBSET * F.col("__all"))
        added = [F.sum(c).alias(c) for c in bins.columns if c not in (*GROUP, "__s", "__bin")]
        sums = held.groupBy(*GROUP, "__s").agg(*added, F.max("__all").alias("__all"))
        model = saved(_estimate(sums, last=step == STEPS - 1), "mcd")
    best = F.min_by(F.struct(*CENTRE, *WEIGHTS), F.struct("__det", "__s")).alias("__best")
    return model.groupBy(*GROUP).agg(best).select(*GROUP, "__best.*")


def judge(stats: DataFrame, keys: tuple[str, str] = ("lang", "source"), id_col: str = "doc_id") -> DataFrame:
    """stats with base_failed, distance (double) and kept. Rows that fail the base rules take no part in the estimates.

    stats is read several times: give a saved table. An empty table gives an empty result.
    """
    lang, source = (F.coalesce(F.concat(F.lit("="), F.col(k)), F.lit("null")) for k in keys)
    # Length first, so that no two key pairs give one name.
    own = F.concat(F.lit("2:"), F.length(lang).cast("string"), lang, source)
    by_lang = F.concat(F.lit("1:"), lang)
    rows = stats.select("*", base_failed().alias("base_failed"), own.alias("__own"), by_lang.alias("__lang"))
    good = rows.where(~F.col("base_failed"))
    sizes = good.groupBy("__lang", "__own").agg(F.count(F.lit(1)).alias("__n"))
    # The level each group takes: its own, its language's or that of all rows.
    sizes = sizes.withColumn("__of_lang", F.sum("__n").over(Window.partitionBy("__lang")))
    level = F.when(F.col("__n") >= LEAST, F.col("__own")).when(F.col("__of_lang") >= LEAST, F.col("__lang")).otherwise("0:")
    levels = saved(sizes.select("__own", level.alias("__g")), "levels")
    # A row counts for its own group, and for its language's and the overall one where a small group needs them.
    wanted = levels.select("__g").distinct()
    every = good.select(F.explode(F.array("__own", "__lang", F.lit("0:"))).alias("__g"), *COUNTS).join(wanted, "__g", "left_semi")
    every = saved(every.groupBy("__g", *COUNTS).agg(F.count(F.lit(1)).alias("__n")), "counts")
    # Saved, so Spark knows its size: one row per group, sent to all tasks where that is small.
    usual = saved(every.groupBy("__g").agg(*_usual()), "usual")
    points = every.join(usual, "__g").select(*GROUP, *_features(), "__n").groupBy(*GROUP, *Z).agg(F.sum("__n").alias("__n"))
    model = fit(saved(points, "points"))
    judged = rows.join(levels, "__own", "left").join(model, "__g", "left").select("*", *_features())
    judged = judged.withColumn("distance", F.coalesce(distance(), F.lit(0.0)))
    return judged.select(*stats.columns, "base_failed", "distance", (~F.col("base_failed") & (F.col("distance") <= CUTOFF)).alias("kept"))


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return judge(saved(statistics(df, id_col, text_col), "statistics"), id_col=id_col)
