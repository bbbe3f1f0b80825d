"""Operator 1, packing: optimal length buckets and token-budget batches.

1. One global histogram of lengths (an aggregation; exact below ``EXACT``, above it bins of less than
   0.1 % width that keep their count, sum and largest length, so padding is counted exactly and
   the histogram has a bounded number of rows whatever the input).
2. Dynamic programming over the histogram picks the bucket boundaries with the least padding. A
   bucket pads to its longest document; cost(i, j) = longest_j * count - sum, so each step is the lower
   envelope of lines and takes linear time.
3. Batches: a bucket padding to L holds max(1, budget // L) documents a batch. Places in a bucket come
   from row numbers within hash slices plus the slices' running counts, so no task sees a bucket whole,
   and all batches of a bucket but its last are full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstream.llm.common import stored

EXACT = 4096
SLICE_ROWS = 100_000  # documents a slice, on average


def length_bin(length: Column) -> Column:
    """Upper end of the bin of a length: the length itself up to EXACT, then 1/1024 relative steps."""
    shift = F.greatest(F.lit(0), F.floor(F.log2(length.cast("double"))).cast("int") - 10)
    step = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    return F.when(length <= EXACT, length).otherwise(F.ceil(length / step).cast("long") * step)


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def optimal_boundaries(longest: list[int], counts: list[int], sums: list[int], buckets: int) -> list[int]:
    """Boundaries (increasing) of at most ``buckets`` buckets with the least total padding.

    ``longest`` increasing lengths of the histogram's bins, with their counts and length sums.
    Of equally good choices it takes the one with fewer buckets.
    """
    n = len(longest)
    if not n:
        return []
    upto_n, upto_s = [0], [0]
    for c, s in zip(counts, sums, strict=True):
        upto_n.append(upto_n[-1] + c)
        upto_s.append(upto_s[-1] + s)
    # best[j]: least padding of the first j bins with the buckets so far
    best = [0] + [longest[j] * upto_n[j + 1] - upto_s[j + 1] for j in range(n)]
    choices, totals = [[0] * (n + 1)], [best[n]]
    for _ in range(min(buckets, n) - 1):
        new, choice = [0] * (n + 1), [0] * (n + 1)
        hull: list[tuple[int, int, int]] = []  # lines (slope -upto_n[i], intercept, i), best at growing x
        at = 0
        for j in range(1, n + 1):
            i = j - 1
            m, b = -upto_n[i], best[i] + upto_s[i]
            while len(hull) - at >= 2:
                (m1, b1, _), (m2, b2, _) = hull[-2], hull[-1]
                if (b - b1) * (m1 - m2) <= (b2 - b1) * (m1 - m):
                    hull.pop()
                else:
                    break
            hull.append((m, b, i))
            x = longest[j - 1]
            while len(hull) - at >= 2 and hull[at + 1][0] * x + hull[at + 1][1] < hull[at][0] * x + hull[at][1]:
                at += 1
            m, b, i = hull[at]
            new[j], choice[j] = m * x + b + x * upto_n[j] - upto_s[j], i
        best = new
        choices.append(choice)
        totals.append(best[n])
    k = totals.index(min(totals))
    out, j = [], n
    while j:
        out.append(longest[j - 1])
        j = choices[k][j]
        k -= 1
    return out[::-1]


def pack(docs: DataFrame, length: Column, id_col: str = "doc_id", buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_tokens`` (``length``; null: 0), ``bucket`` (from 0),
    ``padded_to`` (the bucket's boundary), ``batch_id`` (over all buckets), ``slot`` (place in the batch).

    A document longer than the budget is a batch of its own. Empty texts have length 0 and are packed
    with the shortest. Ties and repeated rows take different slots; rows without an id are packed like any
    other. An empty table gives an empty result. Columns of the input are not returned.
    """
    # ids and lengths are stored: the texts are read once, and no later step computes a length again
    rows = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(length, F.lit(0)).cast("long").alias("n_tokens"))
                  .withColumn("row", F.monotonically_increasing_id()), "lengths")
    histogram = (rows.groupBy(length_bin(F.col("n_tokens")).alias("bin"))
                 .agg(F.max("n_tokens").alias("longest"), F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("total"))
                 .orderBy("bin").collect())
    bounds = optimal_boundaries([h["longest"] for h in histogram], [h["n"] for h in histogram], [h["total"] for h in histogram], buckets)
    sizes = [max(1, budget // max(1, b)) for b in bounds]
    held = [sum(h["n"] for h in histogram if lo < h["longest"] <= hi) for lo, hi in zip([-1, *bounds], bounds, strict=False)]
    first = [0]
    for n, size in zip(held, sizes, strict=True):
        first.append(first[-1] + -(-n // size))
    slices = max(1, -(-sum(held) // SLICE_ROWS))

    def by_bucket(values: list[int], bucket: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values or [0]]), bucket + 1)

    bucket = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds or [0]]), lambda b: b < F.col("n_tokens")))
    placed = rows.withColumn("bucket", bucket).withColumn("slice", F.pmod(F.xxhash64("doc_id", "row"), F.lit(slices)))
    counts = placed.groupBy("bucket", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("bucket", "slice", before.alias("start"))
    number = F.row_number().over(Window.partitionBy("bucket", "slice").orderBy("doc_id", "n_tokens", "row")) - 1
    at = placed.withColumn("number", number).join(starts, ["bucket", "slice"]).withColumn("at", F.col("start") + F.col("number"))
    size = by_bucket(sizes, F.col("bucket"))
    return at.select("doc_id", "n_tokens", "bucket", by_bucket(bounds, F.col("bucket")).alias("padded_to"),
                     (by_bucket(first[:-1], F.col("bucket")) + F.floor(F.col("at") / size)).alias("batch_id"),
                     (F.col("at") % size).cast("long").alias("slot"))
