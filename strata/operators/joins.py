"""Join and dedupe building blocks shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import scratch_path


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], *,
                  strategy: str = "combine") -> DataFrame:
    """Keep the first row of every key group by ``order_by`` (ascending,
    NULLs first). ``order_by`` must be a total order within a key for a
    deterministic pick.

    Both strategies reduce a hot key on every mapper before the shuffle:

    * ``"combine"`` (default): ``min_by(row, order)`` per key, a sort
      aggregate that combines map-side;
    * ``"window"``: ``row_number() = 1``, for which Spark plans a
      ``WindowGroupLimit`` below the exchange. Timings of the two were level
      in measurements; it needs no struct of the remaining columns.
    """
    keys = list(keys)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    if strategy == "window":
        w = Window.partitionBy(*keys).orderBy(*order_cols)
        return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    if strategy != "combine":
        raise ValueError(f"unknown strategy {strategy!r}")
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order_cols)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def aligned_blocks(ranges: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """Each range ``[start, end]`` of whole numbers from 0 on as at most
    ``2 * bits`` aligned power-of-two blocks: ``_level`` (the block holds
    ``2 ** level`` values) and ``_prefix`` (its values shifted right by the
    level). However long a range is, it is a handful of rows.
    """
    s, e = F.col(start_col).cast("long"), F.col(end_col).cast("long") + 1
    # below the highest bit where the two ends differ, blocks climb from the
    # start and descend to the end; at that bit one block may fill the middle
    top = F.length(F.bin(s.bitwiseXOR(e))) - 1
    right = lambda x, k: F.call_function("shiftright", x, k)
    size = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k)
    block = lambda k, prefix: F.struct(k.cast("int").alias("_level"), prefix.alias("_prefix"))

    def at(k: Column) -> Column:
        up = right(s + size(k) - 1, k)
        climbs = F.when((k < top) & (up % 2 == 1), block(k, up))
        descends = F.when((k < top) & (right(e, k) % 2 == 1), block(k, right(e, k + 1) * 2))
        fills = F.when((k == top) & (s % size(k) == 0), block(k, right(s, k)))
        return F.array(climbs, descends, fills)

    found = F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), top), at)))
    return ranges.where(s < e).select("*", F.inline(found))


def range_lookup(df: DataFrame, value_col: str, ranges: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """Join each row to the smallest range ``[start, end]`` that contains
    ``value_col`` (whole numbers from 0 on; nested ranges: the smallest, then
    the one with the least start, then by its other columns). Rows outside
    all ranges, or with a null value, keep nulls.

    Ranges become aligned blocks; a value meets the blocks of one level by an
    equi-join on its prefix, one join a level in use (at most one for each
    bit; as many as there are prefix lengths, as a rule). Each join keeps one
    row a row, so the lookup also works on a stream without state; block
    tables are joined like any dimension, broadcast where they are small. The
    blocks are written once, by level, to the shared folder when the lookup
    is built, and each join reads its own level.
    """
    others = [c for c in ranges.columns if c not in (start_col, end_col)]
    rank = F.struct((F.col(end_col) - F.col(start_col)).alias("size"), F.col(start_col).alias("start"), F.col(end_col).alias("end"), *[F.col(c) for c in others])
    index = scratch_path(df.sparkSession, "prefix-blocks")
    blocks = aligned_blocks(ranges, start_col, end_col).groupBy("_level", "_prefix").agg(F.min(rank).alias("_hit"))
    blocks.write.partitionBy("_level").parquet(index)
    blocks = df.sparkSession.read.schema(blocks.schema).parquet(index)
    levels = sorted(r._level for r in blocks.select("_level").distinct().collect())
    if not levels:
        types = {f.name: f.dataType for f in ranges.schema}
        return df.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in (start_col, end_col, *others)])
    hits = []
    for k in levels:
        own = blocks.where(F.col("_level") == k).select(F.col("_prefix").alias(f"_p{k}"), F.col("_hit").alias(f"_hit{k}"))
        df = df.join(own, F.shiftright(F.col(value_col).cast("long"), k) == F.col(f"_p{k}"), "left").drop(f"_p{k}")
        hits.append(F.col(f"_hit{k}"))
    best = F.least(*hits) if len(hits) > 1 else hits[0]
    out = df.withColumn("_hit", best)
    names = {start_col: "start", end_col: "end", **{c: c for c in others}}
    return out.select(*[c for c in df.columns if not c.startswith("_hit")], *[F.col("_hit")[field].alias(c) for c, field in names.items()])
