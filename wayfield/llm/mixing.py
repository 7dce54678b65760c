"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the number of copies, whole plus fraction, that each of
its documents gets in expectation. The fractions are rounded in pairs: words move from one
document to the other, in a random direction that keeps both expectations, until one of the two
fractions is 0 or 1. The words taken from a source therefore never stray from the target by more
than one document. Documents are dealt by hash into chunks of some ``CHUNK_ROWS`` rows whatever
their source; a chunk leaves at most one undecided document per source, and these residuals meet
in a reduction tree of chunks of chunks. All random numbers follow from ids and sizes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

CHUNK_ROWS = 4096
FAN_IN = 16
WEIGHTS = (5.0, 2.0, 1.0)
TINY = 1e-9


def word_count(text_col: str):
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """(source, source_size, target, place) from (source, source_size).

    Sources in code point order, NULL last, weigh ``weights``, repeating, and share ``share``
    times all words; what a source cannot take below ``limit`` times its size goes to the others
    by weight. With sources in order of limit per weight, those that reach theirs come first, so
    one pass of running sums finds the level of the rest. One row per source is sorted here.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    everything = Window.partitionBy()
    rows = (sizes.withColumn("place", F.row_number().over(place))
            .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                               ((F.col("place") - 1) % len(weights) + 1).cast("int")))
            .withColumn("cap", F.col("source_size") * F.lit(float(limit)))
            .withColumn("goal", F.sum("source_size").over(everything) * F.lit(float(share)))
            .withColumn("before", F.coalesce(F.sum("cap").over(
                by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("weight_left", F.sum("weight").over(
                by_level.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("level", (F.col("goal") - F.col("before")) / F.col("weight_left"))
            .withColumn("rank", F.row_number().over(by_level))
            .withColumn("free", F.min(F.when(F.col("level") * F.col("weight") < F.col("cap"),
                                             F.struct("rank", "level"))).over(everything)))
    target = (F.when(F.col("free").isNull() | (F.col("rank") < F.col("free.rank")), F.col("cap"))
              .otherwise(F.least("cap", F.col("free.level") * F.col("weight"))))
    return rows.select("source", "source_size", target.alias("target"), "place")


def pivot(p: np.ndarray, words: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Fractions after pairwise rounding; at most one of them is neither 0 nor 1."""
    p = p.copy()
    at = -1
    for i in range(len(p)):
        if not TINY < p[i] < 1 - TINY:
            p[i] = round(p[i])
            continue
        if words[i] == 0:
            p[i] = float(draws[i] < p[i])
            continue
        if at < 0:
            at = i
            continue
        up = min(words[at] * (1 - p[at]), words[i] * p[i])     # words that may move from i to at
        down = min(words[at] * p[at], words[i] * (1 - p[i]))   # and from at to i
        move = up if draws[i] * (up + down) < down else -down
        p[at] += move / words[at]
        p[i] -= move / words[i]
        for k in (at, i):
            if not TINY < p[k] < 1 - TINY:
                p[k] = round(p[k])
        at = i if 0 < p[i] < 1 else at if 0 < p[at] < 1 else -1
    return p


def _round_chunk(level: int, last: bool):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["place", "h", "doc", "words"], kind="stable").reset_index(drop=True)
        rng = np.random.default_rng([level, int(key[0])])
        draws = rng.random(len(pdf))
        p = pdf["p"].to_numpy(float).copy()
        words = pdf["words"].to_numpy(float)
        cut = np.flatnonzero(np.diff(pdf["place"].to_numpy(), prepend=-1))
        for a, b in zip(cut, np.append(cut[1:], len(pdf))):
            p[a:b] = pivot(p[a:b], words[a:b], draws[a:b])
        if last:  # the one residual of each source
            p = np.where((p > 0) & (p < 1), (rng.random(len(p)) < p).astype(float), p)
        pdf["p"] = p
        pdf["chunk"] = pdf["chunk"] // FAN_IN
        return pdf
    return run


UNIT = ("doc long, source string, size long, copies_of long, words long, source_size long, target double, "
        "place int, whole int, p double, h long, chunk long")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, limit: float = 2.0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc, source, size, copies_of, source_size, target, copies) per distinct document.

    ``copies_of`` counts rows that repeat id, size and source; they are rounded together and
    ``copies`` (0 .. ceil(limit)) holds for each of them. NULL or empty texts have size 0 and do
    not matter for the targets. NULL sources are one source, NULL ids are ids.
    """
    units = written(
        docs.select(F.col(id_col).cast("long").alias("doc"), F.col(source_col).alias("source"),
                    word_count(text_col).alias("size"))
        .groupBy("doc", "source", "size").agg(F.count("*").alias("copies_of"))
        .withColumn("words", F.col("size") * F.col("copies_of")), "mixing-sizes")
    goals = targets(units.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, limit)
    goals = written(goals, "mixing-targets")
    rows = units.count()
    chunks = -(-rows // CHUNK_ROWS) or 1
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = (units.withColumnRenamed("source", "s").join(goals, F.col("s").eqNullSafe(F.col("source")))
             .drop("s").withColumn("rate", rate)
             .withColumn("whole", F.floor(F.col("rate") + F.lit(TINY)).cast("int"))
             .withColumn("p", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0)))
             .withColumn("h", F.xxhash64("doc", "size", "source"))
             .withColumn("chunk", F.pmod("h", F.lit(chunks)))
             .select(*[c.split()[0] for c in UNIT.split(", ")]))
    done, level = None, 0
    while True:
        last = chunks == 1
        step = written(start.groupBy("chunk").applyInPandas(_round_chunk(level, last), UNIT), "mixing-level")
        part = step.filter((F.col("p") == 0) | (F.col("p") == 1))
        done = part if done is None else done.unionByName(part)
        if last:
            break
        start = step.filter((F.col("p") > 0) & (F.col("p") < 1))
        chunks = -(-chunks // FAN_IN)
        level += 1
    return done.select("doc", "source", "size", "copies_of", "source_size", "target",
                       (F.col("whole") + F.col("p")).cast("int").alias("copies"))


def apply_mix(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    plan = mixed.filter("copies > 0").select(F.col("doc").alias("__doc"), F.col("source").alias("__source"),
                                             F.col("size").alias("__size"), F.col("copies").alias("__copies"))
    rows = docs.withColumn("__n", word_count(text_col))
    return (rows.join(plan, F.col(id_col).cast("long").eqNullSafe(F.col("__doc"))
                      & F.col(source_col).eqNullSafe(F.col("__source")) & (F.col("__n") == F.col("__size")))
            .withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
