"""Document fingerprints: bottom-k sketches of word shingles, in DataFrame functions only.

A sketch holds the ``k`` smallest distinct 63-bit hashes of a text's five-word shingles (of the
whole sequence when a text has fewer words), ascending. Sketches of parts merge into the sketch of
the whole; two sketches estimate resemblance and containment, one estimates how many distinct
shingles there are. With fewer than k hashes all of these are exact.

A NULL or empty text has the empty sketch. Two empty sketches resemble each other fully, an empty
one and another not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import without

K = 128
SHINGLE = 5
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"


def with_sketch(df: DataFrame, text: str, out: str, k: int = K) -> DataFrame:
    """``df`` with the sketch of column ``text`` as ``out`` (array of longs)."""
    words, hashed, shingles = f"__{out}_w", f"__{out}_h", f"__{out}_s"
    low = F.btrim(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(SPACES))
    df = df.withColumn(words, F.when(low == "", F.array().cast("array<string>")).otherwise(F.split(low, SPACE)))
    df = df.withColumn(hashed, F.transform(words, lambda w: F.xxhash64(w)))
    h = F.col(hashed)
    rolled = F.transform(
        F.sequence(F.lit(0), F.size(h) - SHINGLE),
        lambda i: F.xxhash64(*[h[i + j] for j in range(SHINGLE)]).bitwiseAND(F.lit((1 << 63) - 1)))
    whole = F.array(F.xxhash64(h).bitwiseAND(F.lit((1 << 63) - 1)))
    df = df.withColumn(shingles, F.when(F.size(h) >= SHINGLE, rolled).when(F.size(h) > 0, whole)
                       .otherwise(F.array().cast("array<bigint>")))
    return (df.withColumn(out, F.slice(F.sort_array(F.array_distinct(shingles)), 1, k))
            .drop(words, hashed, shingles))


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity, 0 to 1."""
    complete = (F.size(a) < k) & (F.size(b) < k)
    union = F.sort_array(F.array_union(a, b))
    kept = F.when(complete, union).otherwise(F.slice(union, 1, k))
    shared = F.size(F.array_intersect(F.array_intersect(a, b), kept))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
            .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
            .otherwise(shared / F.size(kept)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    return (F.when(F.size(a) < k, F.size(a).cast("double"))
            .otherwise((k - 1) / (F.element_at(a, -1).cast("double") / F.lit(float(1 << 63)))))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second has; 0 for an empty first."""
    j, n = resemblance(a, b, k), distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(0.0)).otherwise(
        F.least(F.lit(1.0), j * (n + distinct_shingles(b, k)) / ((1 + j) * n)))


def merge_all(df: DataFrame, sketch: str, by: str, k: int = K) -> DataFrame:
    """(by, sketch): one sketch per group from the sketches of its rows.

    Only the k smallest hashes of a group leave a task, so a hot group costs no more than others.
    """
    hashes = df.select(by, F.explode(sketch).alias("__h")).distinct()
    rank = F.dense_rank().over(Window.partitionBy(by).orderBy("__h"))
    kept = hashes.withColumn("__r", rank).filter(F.col("__r") <= k)
    return kept.groupBy(by).agg(F.sort_array(F.collect_list("__h")).alias(sketch))


def as_text(a: Column) -> Column:
    """The high 32 bits of the hashes of a sketch in hexadecimal."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(F.shiftright(h, 31)), 8, "0"))), "")


SEGMENTS = 64
MAX_BUCKETS = 100       # per segment: at most 6,400 buckets, whose heads are broadcast
BUCKET_ROWS = 512


def with_next(df: DataFrame, id_col: str, columns: dict[str, str]) -> DataFrame:
    """``df`` with columns of the next row by descending id, after the last the first.

    ``columns`` maps a new column to the column whose next value it holds. NULL ids come last;
    rows with equal ids follow each other by the first of these columns. Rows are dealt into
    ranges of ids (quantiles, each cut into equal widths) and ordered within a range; the first
    row of a range also visits the range above as the one that follows its last. The ranges'
    first ids are at most ``SEGMENTS * MAX_BUCKETS`` rows and are broadcast.
    """
    ids = df.select(F.col(id_col).cast("long").alias("__k"))
    share = [i / SEGMENTS for i in range(SEGMENTS)]
    n, low, high, cuts = ids.agg(F.count(F.lit(1)), F.min("__k"), F.max("__k"),
                                 F.percentile_approx("__k", share, 10_000)).first()
    low, high = (0, 0) if low is None else (low, high)
    cuts = sorted({low, *(cuts or [])})
    null_key = low - 1 if low > -(1 << 63) else low
    per = max(1, min(MAX_BUCKETS, -(-n // (BUCKET_ROWS * len(cuts)))))
    start = F.array(*[F.lit(c).cast("long") for c in cuts])
    stop = F.array(*[F.lit(c).cast("long") for c in cuts[1:] + [high]])
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(null_key))

    def bucketed(frame):
        frame = frame.withColumn("__key", key) if id_col in frame.columns else frame.withColumn(
            "__key", F.coalesce("__k", F.lit(null_key)))
        frame = frame.withColumn("__seg", F.greatest(F.size(F.filter(start, lambda c: c <= F.col("__key"))), F.lit(1)))
        a = F.element_at(start, F.col("__seg")).cast("double")
        width = F.element_at(stop, F.col("__seg")).cast("double") - a + 1
        sub = F.floor((F.col("__key").cast("double") - a) * per / width)
        return frame.withColumn("__bucket", (F.col("__seg") * 1000 + F.greatest(F.least(sub, F.lit(per - 1)), F.lit(0)))
                                .cast("int"))

    heads = bucketed(ids).groupBy("__bucket").agg(F.max("__key").alias("__head"))
    order = Window.orderBy("__bucket")
    heads = heads.select("__head", F.coalesce(F.lead("__bucket").over(order),
                                              F.min("__bucket").over(Window.partitionBy())).alias("__up"))
    rows = bucketed(df).join(F.broadcast(heads), F.col("__key") == F.col("__head"), "left")
    seats = F.array(F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("guest")))
    both = F.array(F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("guest")),
                   F.struct(F.col("__up").alias("b"), F.lit(True).alias("guest")))
    rows = rows.withColumn("__seat", F.explode(F.when(F.col("__up").isNull(), seats).otherwise(both)))
    tie = next(iter(columns.values()))
    # plain columns and one projection: one window over one exchange
    rows = rows.select(*[F.col(f"`{c}`") for c in df.columns], "__key",
                       F.col("__seat.b").alias("__b"), F.col("__seat.guest").alias("__guest"))
    order = Window.partitionBy("__b").orderBy("__guest", F.desc("__key"), tie)
    rows = rows.select("*", *[F.lead(old).over(order).alias(new) for new, old in columns.items()])
    return rows.filter(~F.col("__guest")).drop("__key", "__b", "__guest")


def fingerprinted(docs: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, sketch, edited_sketch, next_sketch) of every row.

    The edited text replaces the last floor(n / 2) code points by the first as many of the next
    document's text.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(with_sketch(rows, "text", "sketch", k), "id", {"next_text": "text", "next_sketch": "sketch"})
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = (rows.withColumn("n_chars", F.char_length("text"))
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars") - half),
                                           F.substring("next_text", F.lit(1), half)))
            .drop("text", "next_text")
            .withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)))
    return without(with_sketch(rows, "edited", "edited_sketch", k), ["edited"])
