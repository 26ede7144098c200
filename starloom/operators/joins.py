"""Left outer equi-join that holds when one key has a large share of the rows.

A right side measured to be within Spark's broadcast threshold is broadcast: nothing is
shuffled and skew does not matter. Beyond it, rows with a NULL key skip the join, and the
keys that are hot on either side are cut into a grid: a hot key's left rows are dealt out
over ``_left_part`` and its right rows over ``_right_part``, each side being copied along
the other one. Every pair of rows meets in exactly one cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fits_broadcast, settled, through_table

PARTS = ["_left_part", "_right_part"]


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions)


def _with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(_all([F.col(k).isNotNull() for k in keys]))


#: Keys that a summary tracks for each group that can be hot, how many of them are counted exactly, and
#: how many keys one can track at all.
_TRACKED, _CANDIDATES, _MOST_TRACKED = 32, 4, 1_000_000
#: Tasks that merge the summaries of all tasks, before a last one merges theirs.
_MERGERS = 64


def _hot_groups(df: DataFrame, keys: Sequence[str], max_groups: int, min_rows: int, parts: str) -> DataFrame:
    """Keys with more than 1/max_groups of the rows: fewer than ``max_groups`` of them.

    Each task keeps a summary of its frequent keys, of bounded size. Merged, it is sure to hold every key of
    that share: with 32 times as many counters no count is off by more than a ninth of it. Only
    the keys it names are counted exactly; the others are never shuffled.
    """
    # Counting all rows, NULL keys included, reads no column of a Parquet table.
    share = max(ceil(df.count() / max_groups), min_rows)
    keyed = _with_keys(df, keys)
    if _TRACKED * max_groups <= _MOST_TRACKED:
        keyed = _of_candidates(keyed, keys, max_groups)
    return (
        keyed.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > share)
        .select(*keys, F.ceil(F.col("_rows") / share).cast("int").alias(parts))
    )


def _of_candidates(keyed: DataFrame, keys: Sequence[str], max_groups: int) -> DataFrame:
    """The rows of keys that can have 1/max_groups of the rows."""
    tracked, wanted = _TRACKED * max_groups, _CANDIDATES * max_groups
    hashed = keyed.select(*keys, F.xxhash64(*keys).alias("_hash"))
    task = F.pmod(F.spark_partition_id(), F.lit(_MERGERS)).alias("_task")
    summaries = hashed.groupBy(task).agg(F.expr(f"approx_top_k_accumulate(_hash, {tracked})").alias("_summary"))
    # Grouped, so that no keys give no row.
    merged = summaries.groupBy(F.lit("all").alias("_all")).agg(F.expr(f"approx_top_k_combine(_summary, {tracked})").alias("_summary"))
    named = merged.selectExpr(f"inline(approx_top_k_estimate(_summary, {wanted}))").select("item").collect()
    candidates = [one["item"] for one in named]  # _CANDIDATES * max_groups at most
    if not candidates:
        return keyed.limit(0)
    return hashed.where(F.col("_hash").isin(candidates)).select(*keys)


def _hot_grid(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], max_groups: int, min_rows: int
) -> DataFrame:
    """(_k0, …, _left_parts, _right_parts) for keys hot on a side; under 2 * max_groups rows."""
    names = [f"_k{i}" for i in range(len(on))]
    left_keys = left.select(*[F.col(lk).alias(n) for (lk, _), n in zip(on, names)])
    right_keys = right.select(*[F.col(rk).alias(n) for (_, rk), n in zip(on, names)])
    hot_left = _hot_groups(left_keys, names, max_groups, min_rows, "_left_parts")
    hot_right = _hot_groups(right_keys, names, max_groups, min_rows, "_right_parts")
    grid = hot_left.join(hot_right, names, "full").select(
        *names,
        F.coalesce("_left_parts", F.lit(1)).alias("_left_parts"),
        F.coalesce("_right_parts", F.lit(1)).alias("_right_parts"),
    )
    return through_table(grid)


def _hot_sides(grid: DataFrame) -> set[str]:
    """Which sides have a hot key at all."""
    most = grid.agg(F.max("_left_parts").alias("_left"), F.max("_right_parts").alias("_right")).first()
    return {side for side in ("_left", "_right") if (most[side] or 1) > 1}


def _spread(
    df: DataFrame, keys: Sequence[str], grid: DataFrame, hot_sides: set[str], dealt: str, copied: str
) -> DataFrame:
    """Deal the rows of hot keys over ``dealt``_part and copy them along ``copied``_part.

    What no key needs is left out of the plan: those parts are the constant 0.
    """
    if not hot_sides:
        return df.select("*", *[F.lit(0).alias(p) for p in PARTS], F.lit(1).alias(f"{copied}_parts"))
    if dealt in hot_sides:
        df = settled(df)  # rows are dealt by their places
    hot = F.broadcast(grid)  # bounded by _hot_grid
    same_key = _all([df[k] == hot[f"_k{i}"] for i, k in enumerate(keys)])
    spread = df.join(hot, same_key, "left").select(
        *df.columns, *[F.coalesce(f"{side}_parts", F.lit(1)).alias(f"{side}_parts") for side in (dealt, copied)]
    )
    dealt_part = copied_part = F.lit(0)
    if dealt in hot_sides:
        # Hashed, since rows of a hot key may come at regular distances.
        row = F.xxhash64(F.monotonically_increasing_id())
        dealt_part = F.pmod(row, F.col(f"{dealt}_parts")).cast("int")
    spread = spread.select(*df.columns, dealt_part.alias(f"{dealt}_part"), f"{copied}_parts")
    if copied in hot_sides:
        copied_part = F.explode(F.sequence(F.lit(0), F.col(f"{copied}_parts") - 1))
    return spread.select("*", copied_part.alias(f"{copied}_part"))


def salt_pair(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    max_groups: int | None = None,
    min_rows: int = 10_000,
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``PARTS`` columns to join on as well; rows with NULL keys are left out.

    ``max_groups`` (default: the number of shuffle partitions) is the share of rows, one in
    ``max_groups``, from which a key counts as hot. The left side also has ``_right_parts``:
    where it is above 1 the key is known to match, though not in every cell.
    """
    if max_groups is None:
        max_groups = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left_keys, right_keys = [lk for lk, _ in on], [rk for _, rk in on]
    grid = _hot_grid(left, right, on, max_groups, min_rows)
    hot = _hot_sides(grid)
    left = _spread(_with_keys(left, left_keys), left_keys, grid, hot, "_left", "_right")
    right = _spread(_with_keys(right, right_keys), right_keys, grid, hot, "_right", "_left")
    return left, right.drop("_left_parts")


def left_match(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    take: Sequence[str],
    max_broadcast_bytes: int | None = None,
    max_groups: int | None = None,
    min_rows: int = 10_000,
) -> DataFrame:
    """Every left row with the ``take`` columns of each right row that has equal keys.

    ``on`` lists (left column, right column). A left row with several partners comes out
    several times, one without any comes out once with NULLs. ``max_broadcast_bytes``
    defaults to Spark's own threshold; 0 always takes the shuffled way.
    """
    names = [f"_m{i}" for i in range(len(on))]
    partners = right.select(*[F.col(rk).alias(n) for (_, rk), n in zip(on, names)], *take)
    pairs = [(lk, n) for (lk, _), n in zip(on, names)]

    if fits_broadcast(partners, max_broadcast_bytes):
        same_key = _all([left[lk] == F.col(n) for lk, n in pairs])
        return left.join(F.broadcast(partners), same_key, "left").select(*left.columns, *take)

    salted, salted_partners = salt_pair(left, partners, pairs, max_groups, min_rows)
    same_cell = _all(
        [salted[lk] == salted_partners[n] for lk, n in pairs]
        + [salted[p] == salted_partners[p] for p in PARTS]
    )
    matched = (
        salted.join(salted_partners.hint("merge"), same_cell, "left")
        # An empty cell of a key that does match elsewhere is not a missing partner.
        .where((F.col("_right_parts") == 1) | F.col(names[0]).isNotNull())
        .select(*left.columns, *take)
    )
    keyless = left.where(~_all([F.col(lk).isNotNull() for lk, _ in pairs]))
    types = partners.schema
    return matched.unionByName(
        keyless.select(*left.columns, *[F.lit(None).cast(types[c].dataType).alias(c) for c in take])
    )
