"""Exact-N hash sampling and disjoint cohorts without a global window.

Ranking all rows by ``md5(key)`` with one ``row_number() OVER (ORDER BY ..)``
puts every row in a single task.  Instead:

1. every row gets ``bucket`` = first 16 bits of its md5 (65,536 buckets,
   ordered the same way as the full hash);
2. rows per bucket are counted with a distributed aggregate — the result has
   at most 65,536 rows, a size fixed in advance, so it may come to the driver;
3. the driver turns the counts into each bucket's rank offset and finds the
   few buckets that straddle a cut;
4. whole buckets get their label from a range test on the bucket number
   (a Column expression — nothing is shipped back to the cluster);
5. only rows of the straddling buckets are ranked exactly, with a window
   partitioned by bucket (each holds ~1/65,536 of the rows when the key is
   unique — the operator samples *entities*, so the key must be unique).

The result equals ``row_number() OVER (ORDER BY md5(key), key) <= n``.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_HEX_DIGITS = 4
N_BUCKETS = 16 ** BUCKET_HEX_DIGITS


def hash_of(key: str) -> Column:
    return F.md5(F.col(key).cast("string"))


def _with_hash(df: DataFrame, key: str) -> DataFrame:
    h = hash_of(key)
    return (df.withColumn("_h", h)
              .withColumn("_bucket", F.conv(F.substring("_h", 1, BUCKET_HEX_DIGITS), 16, 10)
                          .cast("int")))


def _bucket_offsets(hashed: DataFrame) -> tuple[list[int], list[int]]:
    rows = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = sorted((r["_bucket"], r["n"]) for r in rows)
    buckets = [b for b, _ in counts]
    offsets, acc = [], 0
    for _, n in counts:
        offsets.append(acc)
        acc += n
    return buckets, offsets + [acc]


def rank_cohorts(df: DataFrame, key: str, sizes: Sequence[int],
                 labels: Sequence[str] | None = None, label_col: str = "cohort") -> DataFrame:
    """Rows ranked ``1..sizes[0]`` get ``labels[0]``, the next ``sizes[1]`` get
    ``labels[1]`` … by ``(md5(key), key)``; other rows are dropped."""
    labels = list(labels) if labels is not None else [str(i) for i in range(len(sizes))]
    if len(labels) != len(sizes):
        raise ValueError("one label per cohort size")
    cuts, acc = [], 0
    for s in sizes:
        acc += int(s)
        cuts.append(acc)                    # cohort i holds ranks (cuts[i-1], cuts[i]]
    # The key alone is read to count; then two filtered scans pick the rows.  The
    # hash depends on the key only, so all three see the same buckets and nothing
    # has to be written.
    hashed = _with_hash(df, key)
    buckets, offsets = _bucket_offsets(_with_hash(df.select(key), key))

    def label_of(rank: int) -> int | None:
        i = bisect_right(cuts, rank - 1)    # first cut >= rank
        return i if i < len(cuts) else None

    # Walk the buckets in hash order: runs of whole buckets with one label
    # become range tests; the few buckets that straddle a cut are "split".
    whole: list[tuple[int, int, str]] = []  # (first bucket, last bucket, label)
    split: dict[int, int] = {}              # bucket -> rank offset
    for i, b in enumerate(buckets):
        lo, hi = offsets[i] + 1, offsets[i + 1]
        first, last = label_of(lo), label_of(hi)
        if first is None:
            break                           # every later rank is beyond the last cut
        if first == last:
            if whole and whole[-1][2] == labels[first] and whole[-1][1] == buckets[i - 1]:
                whole[-1] = (whole[-1][0], b, labels[first])
            else:
                whole.append((b, b, labels[first]))
        else:
            split[b] = offsets[i]

    bucket = F.col("_bucket")
    whole_label = F.lit(None).cast("string")
    for lo_b, hi_b, lab in reversed(whole):
        whole_label = F.when(bucket.between(lo_b, hi_b), F.lit(lab)).otherwise(whole_label)
    out = hashed.where(whole_label.isNotNull()).withColumn(label_col, whole_label)

    if split:
        offset = F.lit(None).cast("long")
        for b, o in split.items():
            offset = F.when(bucket == b, F.lit(o)).otherwise(offset)
        w = Window.partitionBy("_bucket").orderBy("_h", key)
        ranked = (hashed.where(bucket.isin(list(split)))
                  .withColumn("_rank", offset + F.row_number().over(w)))
        label_expr = F.lit(None).cast("string")
        for i in reversed(range(len(cuts))):
            label_expr = F.when(F.col("_rank") <= cuts[i], F.lit(labels[i])).otherwise(label_expr)
        ranked = (ranked.withColumn(label_col, label_expr)
                  .where(F.col(label_col).isNotNull()).drop("_rank"))
        out = out.unionByName(ranked)
    return out.drop("_h", "_bucket")


def exact_n_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """Exactly ``min(n, count)`` rows: the first ``n`` by ``(md5(key), key)``."""
    return rank_cohorts(df, key, [n], ["sample"], "_cohort").drop("_cohort")
