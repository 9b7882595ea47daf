"""Operator 11: a uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Method.  Shard sizes are fixed first: n rows over s shards, at most one
apart.  How many rows each input partition sends to each shard is then
drawn exactly: the matrix with the partition sizes as row sums and the
shard sizes as column sums, distributed as in a uniform permutation, comes
from multivariate hypergeometric draws, partition after partition, out of
what the shards have left.  Each partition permutes its rows and cuts them
by its row of the matrix, the parts are exchanged, and each shard permutes
what it got.

Scale.  Permuting a partition is a sort inside the task that reads it,
before anything moves; its rows are written once, with their places, to
the shared folder, so a repeated task or a lost executor cannot draw or
number anew.  The matrix is drawn in two levels: partitions are dealt into
about sqrt(p) groups, one task draws the groups' rows, and one task a
group the rows of its partitions, so no task sees more than about sqrt(p)
sizes.  A shard is permuted in ranges of a random number, each of about
RANGE_ROWS rows, whose counts (one row a range) give the first slot of
each; no task holds a shard.  No step depends on a value in the data, so
equal rows, hot keys and long texts are spread like any others.

Results on edge cases.  Each row counts by itself: repeated rows, null ids
and null or empty texts get places like others.  An empty table gives no
row.  Fewer rows than shards leave shards empty.  Other columns pass
through unread; columns with the names of the result's raise an error.
The same seed and the same partitions give the same result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SHARDS = 8
SEED = 20_011
#: Rows of a shard that one task permutes, about.
RANGE_ROWS = 1 << 17
#: Largest matrix (bytes) that is broadcast; a larger one is joined.
BROADCAST_BYTES = 64 << 20
#: numpy draws from fewer items than this.
NUMPY_ITEMS = 1_000_000_000


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Row counts at most one apart; the first shards have the greater."""
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def _stirling_rest(n: float) -> float:
    """log(n!) less Stirling's formula."""
    if n < 16:
        return math.lgamma(n + 1) - (n + 0.5) * math.log(n) + n - 0.5 * math.log(2 * math.pi) if n else 0.0
    return (1 / 12 - (1 / 360 - 1 / 1260 / n ** 2) / n ** 2) / n


def _deviance(x: float, mean: float) -> float:
    """x log(x / mean) + mean - x, without loss of digits where x is near the mean."""
    if abs(x - mean) >= 0.1 * (x + mean):
        return x * math.log(x / mean) + mean - x
    v = (x - mean) / (x + mean)
    total, term, j = (x - mean) * v, 2 * x * v, 1
    while True:
        term *= v * v
        more = total + term / (2 * j + 1)
        if more == total:
            return total
        total, j = more, j + 1


def _log_binomial(k: int, n: int, p: float) -> float:
    if k == 0 or k == n:
        return n * (math.log1p(-p) if k == 0 else math.log(p))
    rest = _stirling_rest(n) - _stirling_rest(k) - _stirling_rest(n - k)
    return rest - _deviance(k, n * p) - _deviance(n - k, n * (1 - p)) - 0.5 * math.log(2 * math.pi * k * (1 - k / n))


def _by_ratio_of_uniforms(rng, good: int, bad: int, draws: int) -> int:
    """A hypergeometric draw of any size, by ratio of uniforms under the mass function's hat."""
    total = good + bad
    p = draws / total
    low, high = max(0, draws - bad), min(draws, good)

    def log_mass(k):
        return _log_binomial(k, good, p) + _log_binomial(draws - k, bad, p)

    mean = draws * (good / total)
    spread = math.sqrt(mean * (bad / total) * ((total - draws) / (total - 1)) + 0.5)
    # the hat's width for any unimodal mass function with this spread
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
    top = log_mass(min(high, max(low, (draws + 1) * (good + 1) // (total + 2))))
    while True:
        u, v = 1.0 - rng.random(), rng.random()
        k = math.floor(mean + 0.5 + width * (v - 0.5) / u)
        if low <= k <= high and 2 * math.log(u) <= log_mass(k) - top:
            return k


def hypergeometric(rng, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` items, drawn without putting back, are good."""
    if min(good, draws) == 0:
        return 0
    if bad == 0 or draws == good + bad:
        return min(good, draws)
    if good + bad < NUMPY_ITEMS:
        return int(rng.hypergeometric(good, bad, draws))
    return _by_ratio_of_uniforms(rng, good, bad, draws)


def draw_matrix(sizes: list[int], capacities: list[int], rng) -> list[list[int]]:
    """Rows of the communication matrix: row sums ``sizes``, column sums ``capacities``."""
    if sum(sizes) != sum(capacities):
        raise ValueError("partitions and shards hold different numbers of rows")
    left, out = list(capacities), []
    for size in sizes:
        row, others = [], sum(left)
        for j, able in enumerate(left):
            others -= able
            row.append(hypergeometric(rng, able, others, size))
            size -= row[-1]
        left = [a - b for a, b in zip(left, row)]
        out.append(row)
    return out


def _matrix(sizes: DataFrame, parts: int, capacities: list[int], seed: int) -> DataFrame:
    """(part, cuts): where each partition's permuted rows are cut, for ``sizes`` (part, n)."""
    import numpy as np
    import pandas as pd

    groups = max(1, math.isqrt(parts))
    dealt = sizes.withColumn("g", F.pmod(F.xxhash64("part"), F.lit(groups)))

    def of_groups(frame):
        frame = frame.sort_values("g")
        rows = draw_matrix(frame["n"].tolist(), capacities, np.random.default_rng([seed, 0]))
        return pd.DataFrame({"g": frame["g"], "room": rows})

    def of_parts(key, frame):
        frame = frame.sort_values("part")
        rows = draw_matrix(frame["n"].tolist(), [int(x) for x in frame["room"].iloc[0]],
                           np.random.default_rng([seed, 1 + int(key[0])]))
        return pd.DataFrame({"part": frame["part"], "cuts": [np.cumsum(r).tolist() for r in rows]})

    rooms = (dealt.groupBy("g").agg(F.sum("n").alias("n")).withColumn("all", F.lit(0))
             .groupBy("all").applyInPandas(of_groups, "g long, room array<long>"))
    return dealt.join(rooms, "g").groupBy("g").applyInPandas(of_parts, "part int, cuts array<long>")


def shuffle_rows(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` and their shard (int, from 0) and slot (long, gapless from 0): a uniform random order."""
    if {"shard", "slot"} & {c.lower() for c in rows.columns}:
        raise ValueError("rows must not have columns named shard or slot")
    common.ship_package(rows.sparkSession)
    part, place, turn, room, cuts, before = (common.free_name(rows, c) for c in
                                             ("__part", "__place", "__turn", "__range", "__cuts", "__before"))
    held = common.materialise(
        rows.withColumn(turn, F.rand(seed)).sortWithinPartitions(turn)      # each partition permutes its rows
        .withColumn(part, F.spark_partition_id())
        .withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .withColumn(turn, F.rand(seed + (1 << 40))), "shuffle-parts")       # the random number of the second permutation
    sizes = common.materialise(held.groupBy(F.col(part).alias("part")).agg(F.count("*").alias("n")), "shuffle-sizes")
    facts = sizes.agg(F.count("*").alias("parts"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    matrix = common.materialise(_matrix(sizes, facts.parts, shard_sizes(facts.n, shards), seed), "shuffle-matrix")
    common.release(sizes)
    matrix = matrix.select(F.col("part").alias(part), F.col("cuts").alias(cuts))
    if facts.parts * (shards + 4) * 8 <= BROADCAST_BYTES:
        matrix = F.broadcast(matrix)
    ranges = max(1, -(-facts.n // shards // RANGE_ROWS))
    dealt = (held.join(matrix, part)
             .withColumn("shard", F.size(F.filter(cuts, lambda c: c <= F.col(place))))
             .withColumn(room, F.floor(F.col(turn) * ranges)))
    # one row a range; ranges of a shard follow one another
    firsts = (dealt.groupBy("shard", room).agg(F.count("*").alias("n"))
              .select("shard", room, (F.sum("n").over(Window.partitionBy("shard").orderBy(room)) - F.col("n")).alias(before)))
    within = F.row_number().over(Window.partitionBy("shard", room).orderBy(turn, part, place))
    return (dealt.withColumn("slot", within.cast("long")).join(firsts, ["shard", room])
            .select(*[F.col(f"`{c}`") for c in rows.columns], "shard", (F.col("slot") - 1 + F.col(before)).alias("slot")))


def write_shards(shuffled: DataFrame, path: str, file_rows: int = 1_000_000) -> None:
    """Write each shard in the order of its slots, as folders ``shard=j`` with files of about ``file_rows`` rows."""
    block = F.floor(F.col("slot") / file_rows)
    (shuffled.repartition("shard", block).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def op11_hypergeometric_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    text = F.coalesce("text", F.lit(""))
    docs = common.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"))
    return shuffle_rows(docs).withColumn("grown_shard", F.lit(None).cast("int"))
