"""Joins against keyed tables, planned from sizes in bytes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(
    rows: DataFrame,
    keyed: DataFrame,
    on: dict[str, str],
    how: str = "inner",
    *,
    null_safe: bool = False,
) -> DataFrame:
    """Join ``rows`` to ``keyed``, a table with at most one row per key.

    ``on`` maps a column of ``rows`` to a column of ``keyed``; the latter is not in the result. No
    side is forced: Spark broadcasts one whose bytes, by the optimizer or as AQE measures them, stay
    below its threshold, and shuffles otherwise, where AQE splits the partitions of hot keys (the
    session settings force that even if it costs another shuffle later). Nothing runs while the plan
    is built.
    """
    renamed = {right: f"__key_{i}" for i, right in enumerate(on.values())}
    values = [c for c in keyed.columns if c not in renamed]
    if clash := sorted(set(values) & set(rows.columns)):
        raise ValueError(f"both sides have {clash}; rename them in the keyed side")
    right = keyed.select(
        *[F.col(c).alias(renamed[c]) for c in renamed],
        *values,
    )
    terms = [
        F.col(a).eqNullSafe(F.col(renamed[b])) if null_safe else F.col(a) == F.col(renamed[b])
        for a, b in on.items()
    ]
    return rows.join(right, reduce(lambda x, y: x & y, terms), how).drop(*renamed.values())


def missing_rows(
    source: DataFrame, target: DataFrame, on: dict[str, str], *, null_safe: bool = False
) -> DataFrame:
    """Source rows whose key does not occur in the target (anti join); each side is read once."""
    keys = target.select(*on.values()).distinct()
    return lookup_join(source, keys, on, "left_anti", null_safe=null_safe)


#: Rows of a key filter at most: 16 bytes each, so its broadcast is bounded whatever the target's size.
FILTER_WORDS = 1 << 19
#: Types whose equal values hash alike.
HASHED = {"boolean", "tinyint", "smallint", "int", "bigint", "string", "date", "timestamp", "timestamp_ntz", "float", "double"}


def key_filter(target: DataFrame, columns: list[str], words: int = FILTER_WORDS) -> DataFrame:
    """(word, bits): a Bloom filter of the target's keys, at most ``words`` rows of 64 bits.

    A key sets four bits of one word. It is an aggregate, so tasks add up before the shuffle and send no
    more than ``words`` rows each. Beyond some 8 keys a word it says yes too often to be of use, never no to
    a key that is there.
    """
    word, mask = _bits(target, columns, words)
    return target.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))


def _bits(rows: DataFrame, columns: list[str], words: int) -> tuple[Column, Column]:
    """A row's word of the filter and its bits there."""
    kinds = dict(rows.dtypes)
    plain = []
    for name in columns:
        c = F.col(name)
        if kinds[name] in ("float", "double"):  # 0.0 = -0.0, and all NaN are one
            c = F.when(c == 0, F.lit(0.0).cast(kinds[name])).when(F.isnan(c), F.lit(float("nan")).cast(kinds[name])).otherwise(c)
        plain.append(c)
    at = F.xxhash64(*plain)
    more = F.xxhash64(at, F.lit(1))
    mask = F.lit(0).cast("long")
    for turn in range(4):
        place = F.shiftrightunsigned(more, 6 * turn).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return F.pmod(at, F.lit(words)), mask


def missing_from_large(
    source: DataFrame, target: DataFrame, on: dict[str, str], *, null_safe: bool = False, words: int = FILTER_WORDS
) -> DataFrame:
    """As :func:`missing_rows` for a target much larger than the source.

    A Bloom filter of the target's keys, of bounded size, is tested where the source's rows are: a no means new,
    without a shuffle. Rows with a yes are the only ones that go on: their keys are looked up in the target
    (which stays in place where they are few enough to broadcast), and what is found there is left out
    exactly. The target's key columns are read twice, the source as well.
    """
    kinds, target_kinds = dict(source.dtypes), dict(target.dtypes)
    if any(kinds[a] != target_kinds[b] or kinds[a] not in HASHED for a, b in on.items()):
        return missing_rows(source, target, on, null_safe=null_safe)
    keys = list(on)
    word, mask = _bits(source, keys, words)
    tested = source.select("*", word.alias("__word"), mask.alias("__mask"))
    known = key_filter(target, list(on.values()), words).select(F.col("word").alias("__word"), F.col("bits").alias("__bits"))
    tested = tested.join(F.broadcast(known), "__word", "left")  # bounded, see FILTER_WORDS
    maybe = F.coalesce(F.col("__bits").bitwiseAND(F.col("__mask")) == F.col("__mask"), F.lit(False))
    if not null_safe:
        for key in keys:
            maybe = maybe & F.col(key).isNotNull()
    new = tested.where(~maybe).select(*source.columns)
    undecided = tested.where(maybe).select(*source.columns)
    there = target.select(*[F.col(b).alias(a) for a, b in on.items()])
    found = lookup_join(there, undecided.select(*keys).distinct(), {k: k for k in keys}, "left_semi", null_safe=null_safe)
    left = lookup_join(undecided, found.distinct(), {k: k for k in keys}, "left_anti", null_safe=null_safe)
    return new.unionAll(left)


def present_rows(source: DataFrame, target: DataFrame, on: dict[str, str]) -> DataFrame:
    """Source rows whose key occurs in the target (semi join); each side is read once."""
    return lookup_join(source, target.select(*on.values()).distinct(), on, "left_semi")


def role_join(
    flows: DataFrame, zones: DataFrame, key: str, columns: dict[str, dict[str, str]]
) -> DataFrame:
    """Join one dimension in several roles.

    ``columns`` maps a flow column (the role) to {dimension column: output name}.
    """
    for role, names in columns.items():
        side = zones.select(
            F.col(key).alias("__role"), *[F.col(c).alias(out) for c, out in names.items()]
        )
        flows = lookup_join(flows, side, {role: "__role"})
    return flows
