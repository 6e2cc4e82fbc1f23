"""Left joins that hold at scale: broadcast behind a measured size, a plain
shuffle join when no key is hot, and an exact split of hot keys when one is."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pitchlake.session import settle


@dataclass(frozen=True)
class JoinLimits:
    """Physical limits; none of them changes a result.

    broadcast_bytes: largest measured side that is broadcast.
    rows_per_split: rows of one key that one task may take.
    sampled_rows: rows that a key of rows_per_split rows has in the sample in
    which hot keys are looked for, on average.
    """

    broadcast_bytes: int = 64 << 20
    rows_per_split: int = 2_000_000
    sampled_rows: int = 64


DEFAULT_LIMITS = JoinLimits()


@dataclass(frozen=True)
class HotKeys:
    """Keys too large for one task: a table of the key columns and `parts`, the
    number of parts to cut each into. It is sent to all tasks if `small`."""

    table: DataFrame | None = None
    null_parts: int = 1
    small: bool = True

    def __bool__(self) -> bool:
        return self.table is not None or self.null_parts > 1


NO_HOT_KEYS = HotKeys()


def measured_bytes(df: DataFrame) -> int:
    """Size of a side, summed over its rows: a fixed share per field plus text."""
    fixed = 16 * (len(df.columns) + 1)
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    size: Column = F.lit(fixed).cast("long")
    for name in texts:
        size = size + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def _has_null(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return missing


def _candidates(narrow: DataFrame, named: dict[str, list[str]], limits: JoinLimits) -> dict[str, DataFrame] | None:
    """Keys that may be hot, for each set of columns that has any: those with a
    quarter of the rows in a random sample that a key at the limit has there. A
    key beyond the limit is missed with a chance below 1e-9 (64 rows expected,
    15 or fewer seen: 2e-13), which would cost its split and no row. None where
    the whole table is the sample."""
    fraction = limits.sampled_rows / limits.rows_per_split
    if fraction >= 1:
        return None
    flat = [column for columns in named.values() for column in columns]
    sets = [[F.col(f"`{column}`") for column in columns] for columns in named.values()]
    sampled = narrow.sample(fraction, seed=1).groupingSets(sets, *[F.col(f"`{column}`") for column in flat])
    counted = sampled.agg(F.grouping_id().alias("set"), F.count("*").alias("n"))
    often = counted.where(F.col("n") >= max(1, limits.sampled_rows // 4)).drop("n")
    if often.isEmpty():  # the ordinary case: one pass over the keys, next to nothing shuffled
        return {}
    often = settle(often)
    found = {}
    for name, columns in named.items():
        own = often.where(F.col("set") == _grouping(flat, columns)).select(*[F.col(f"`{c}`") for c in columns])
        if not own.isEmpty():
            found[name] = F.broadcast(own) if measured_bytes(own) <= limits.broadcast_bytes else own
    return found


def _grouping(flat: Sequence[str], columns: Sequence[str]) -> int:
    """Grouping id of a set: its bits stand for the columns that are not in it."""
    return int("".join("0" if column in columns else "1" for column in flat), 2)


def _only_candidates(narrow: DataFrame, named: dict[str, list[str]], found: dict[str, DataFrame]) -> DataFrame:
    """Rows with a candidate of any set, and for each set whether it is one of its."""
    for name, table in found.items():
        columns = named[name]
        side = table.select(*[F.col(f"`{c}`").alias(f"{c}'") for c in columns], F.lit(True).alias(f"{name}?"))
        same = F.lit(True)
        for c in columns:
            same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"`{c}'`"))
        kept = [F.col(f"`{c}`") for c in narrow.columns]
        narrow = narrow.join(side, same, "left").select(*kept, F.coalesce(F.col(f"`{name}?`"), F.lit(False)).alias(f"{name}?"))
    any_ = F.lit(False)
    for name in found:
        any_ = any_ | F.col(f"`{name}?`")
    return narrow.where(any_)


def hot_keys_by(
    df: DataFrame, key_sets: dict[str, Sequence[str]], limits: JoinLimits = DEFAULT_LIMITS
) -> dict[str, HotKeys]:
    """Every key with more than rows_per_split rows, for several joins of one
    table. Candidates come from a random sample of the rows; where there are
    any, a second pass counts their rows exactly, within each task first. With a
    limit so low that the sample would be the table, all keys are counted. Only
    hot keys are kept, as a settled table. Rows with a NULL in their key are
    counted together."""
    named = {name: [f"{name}.{key}" for key in keys] for name, keys in key_sets.items()}
    narrow = df.select(
        *[
            F.when(~_has_null(keys), F.col(key)).alias(column)
            for name, keys in key_sets.items()
            for key, column in zip(keys, named[name], strict=True)
        ]
    )
    likely = _candidates(narrow, named, limits)
    if likely is None:
        marked = {name: [] for name in named}
    else:
        if not likely:
            return dict.fromkeys(key_sets, NO_HOT_KEYS)
        narrow = _only_candidates(narrow, named, likely)
        marked = {name: [f"{name}?"] for name in likely}
    in_set = {name: [*named[name], *marks] for name, marks in marked.items()}
    grouped = [column for columns in in_set.values() for column in columns]
    sets = [[F.col(f"`{column}`") for column in columns] for columns in in_set.values()]
    counted = narrow.groupingSets(sets, *[F.col(f"`{column}`") for column in grouped]).agg(
        F.grouping_id().alias("set"), F.count("*").alias("n")
    )
    own_rows = F.lit(True)
    for marks in marked.values():
        for mark in marks:  # false in its own set: rows of other sets' candidates
            own_rows = own_rows & F.coalesce(F.col(f"`{mark}`"), F.lit(True))
    parts = F.ceil(F.col("n") / limits.rows_per_split).cast("int").alias("parts")
    hot = counted.where(F.col("n") > limits.rows_per_split).where(own_rows)
    keys_of = [column for name in in_set for column in named[name]]
    found = settle(hot.select(*[f"`{column}`" for column in keys_of], "set", parts))
    if found.isEmpty():
        return dict.fromkeys(key_sets, NO_HOT_KEYS)

    def of_set(name: str, keys: Sequence[str]) -> HotKeys:
        if name not in in_set:
            return NO_HOT_KEYS
        own = found.where(F.col("set") == _grouping(grouped, in_set[name])).select(
            *[F.col(f"`{column}`").alias(key) for column, key in zip(named[name], keys, strict=True)], "parts"
        )
        nulls = own.where(_has_null(keys)).first()  # one row at most
        table = own.where(~_has_null(keys))
        n_bytes = measured_bytes(table)
        return HotKeys(
            table if n_bytes else None,
            nulls["parts"] if nulls else 1,
            n_bytes <= max(limits.broadcast_bytes, 1 << 20),
        )

    return {name: of_set(name, keys) for name, keys in key_sets.items()}


def hot_keys(df: DataFrame, keys: Sequence[str], limits: JoinLimits = DEFAULT_LIMITS) -> HotKeys:
    """Hot keys of one side of one join."""
    return hot_keys_by(df, {"key": keys}, limits)["key"]


def find_hot_keys(
    sides: dict[str, tuple[DataFrame, Sequence[str]]], limits: JoinLimits = DEFAULT_LIMITS
) -> dict[str, HotKeys]:
    """Hot keys of several join sides."""
    return {name: hot_keys(df, keys, limits) for name, (df, keys) in sides.items()}


def _with_parts(df: DataFrame, keys: Sequence[str], hot: HotKeys, column: str) -> DataFrame:
    """Look up the part count of each row's key; NULL for keys that are not hot."""
    if hot.table is None:
        return df.withColumn(column, F.lit(None).cast("int"))
    table = hot.table.withColumnRenamed("parts", column)
    return df.join(F.broadcast(table) if hot.small else table, list(keys), "left")


def split_left_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    hot_left: HotKeys = NO_HOT_KEYS,
    hot_right: HotKeys = NO_HOT_KEYS,
    grow_together: bool = False,
) -> DataFrame:
    """Left join with hot keys of either side cut into parts.

    A hot key of the left is spread over n parts and the few right rows of that
    key are copied to each; a hot key of the right the other way round. Left
    rows with a NULL key match nothing and are merely spread. A copied left row
    that meets an empty part is dropped again: its key is on the right, so it
    has its matches in another part. Rows are spread by all their columns, which
    a lost task computes again to the same part; identical copies stay together
    and are left to the adaptive skew join.

    Sides that `grow_together` are shuffled at any size: Spark would broadcast
    one that is small as stored, which packed tables are with millions of rows.
    """
    if not hot_left and not hot_right:
        return left.join(right.hint("merge") if grow_together else right, list(on), "left")

    columns = [*left.columns, *[c for c in right.columns if c not in on]]
    left_hash = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    right_hash = F.xxhash64(*[F.col(f"`{c}`") for c in right.columns])
    null_key = _has_null(on)

    def part_of(hash_: Column, parts: Column) -> Column:
        return F.pmod(hash_, parts.cast("long")).cast("int")

    def every_part(parts: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), F.coalesce(parts, F.lit(1)) - 1))

    def prepare(df: DataFrame) -> DataFrame:
        return _with_parts(_with_parts(df, on, hot_left, "_n"), on, hot_right, "_m")

    cut_left = prepare(left).withColumn(
        "_l",
        F.when(null_key, part_of(left_hash, F.lit(hot_left.null_parts)))
        .when(F.col("_n").isNotNull(), part_of(left_hash, F.col("_n")))
        .otherwise(0),
    )
    cut_left = cut_left.withColumn("_r", every_part(F.col("_m"))).drop("_n")
    cut_right = (
        prepare(right)
        .withColumn(
            "_r",
            F.when(F.col("_m").isNotNull(), part_of(right_hash, F.col("_m"))).otherwise(0),
        )
        .withColumn("_l", every_part(F.col("_n")))
        .withColumn("_met", F.lit(True))
        .drop("_n", "_m")
    )
    if grow_together:
        cut_right = cut_right.hint("merge")
    joined = cut_left.join(cut_right, [*on, "_l", "_r"], "left")
    return joined.where(F.col("_m").isNull() | F.col("_met")).select(
        *[F.col(f"`{c}`") for c in columns]
    )


def lookup(
    left: DataFrame,
    side: DataFrame,
    on: Sequence[str],
    side_bytes: int,
    limits: JoinLimits = DEFAULT_LIMITS,
    hot_left: HotKeys | None = None,
    hot_right: HotKeys | None = None,
) -> DataFrame:
    """Left join with a side that is usually small: broadcast up to the limit,
    beyond it a shuffle join with hot keys split. Hot keys that are not given
    are looked for, which computes that side once more."""
    if side_bytes <= limits.broadcast_bytes:
        return left.join(F.broadcast(side), list(on), "left")
    if hot_left is None:
        hot_left = hot_keys(left, on, limits)
    if hot_right is None:
        hot_right = hot_keys(side, on, limits)
    return split_left_join(left, side, on, hot_left, hot_right)
