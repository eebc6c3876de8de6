"""Deterministic checkpoint names for repeated steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.plans import ROWS_PER_SEGMENT, windowed
from tallyfold.session import written

# A literal name that looks like a numbered occurrence: base, "#", a number from 2.
NUMBERED = r"(?s)^(.*)#([2-9]|[1-9][0-9]+)\z"
TRAILING_NUMBERS = r"(?s)((?:#(?:[2-9]|[1-9][0-9]+))*)\z"


def numbered_name(name: Column, number: Column) -> Column:
    return F.when(number == 1, name).otherwise(F.concat(name, F.lit("#"), number.cast("string")))


def occurrence_names(
    calls: DataFrame,
    keys: list[str],
    order: list[str],
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """``name``, ``name#2``, ``name#3`` in call order; assumes no literal ``name#2``."""
    counted = windowed(
        calls,
        [*keys, "name"],
        order,
        sums={"occurrence": F.lit(1)},
        rows_per_segment=rows_per_segment,
    )
    return counted.withColumn(
        "checkpoint_name", numbered_name(F.col("name"), F.col("occurrence"))
    )


def allocate_names(
    calls: DataFrame,
    keys: list[str],
    order: list[str],
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Occurrence names when a literal name may equal an allocated one.

    A call whose name is already taken is refused and consumes no number, so every later
    call of that name is refused too: per execution and name, the first calls up to some
    limit succeed. Literals ``x#k`` are the only rivals of the k-th call of ``x``:

    * the literal comes first: ``x`` stops at ``k - 1`` calls;
    * the k-th call of ``x`` comes first and succeeds: every call of the literal fails.

    The second case depends on whether ``x`` itself fails from its first call, which is
    decided along the chain of bases (``x#2#3`` -> ``x#2`` -> ``x``). All of it is joins
    and aggregates; no execution is gathered into one task.
    """
    at = F.struct(*order)
    counted = windowed(
        calls,
        [*keys, "name"],
        order,
        sums={"_call": F.lit(1)},
        rows_per_segment=rows_per_segment,
    )
    literals = (
        calls.where(F.col("name").rlike(NUMBERED))
        .groupBy(*keys, "name")
        .agg(F.min(at).alias("_literal_at"))
        .withColumns(
            {
                "_base": F.regexp_extract("name", NUMBERED, 1),
                # A number beyond all calls has no rival.
                "_number": F.regexp_extract("name", NUMBERED, 2).try_cast("bigint"),
            }
        )
        .where(F.col("_number").isNotNull())
    )
    # Literals are usually few; written, their size is known and a small set is broadcast.
    literals = written(literals, "literal-names")
    limits = _call_limits(calls, literals, keys, order, rows_per_segment)
    named = counted.join(written(limits, "call-limits"), [*keys, "name"], "left")
    accepted = F.col("_limit").isNull() | (F.col("_call") <= F.col("_limit"))
    number = F.when(accepted, F.col("_call")).otherwise(F.col("_limit") + 1)
    return named.select(
        *calls.columns,
        numbered_name(F.col("name"), number).alias("checkpoint_name"),
        accepted.alias("accepted"),
    )


def _call_limits(
    calls: DataFrame,
    literals: DataFrame,
    keys: list[str],
    order: list[str],
    rows_per_segment: int,
) -> DataFrame:
    """How many calls of a name succeed, for the names that have such a limit."""
    at = F.struct(*order)
    bases = literals.select(*keys, F.col("_base").alias("name"))
    base_calls = windowed(
        calls.join(bases, [*keys, "name"], "left_semi"),
        [*keys, "name"],
        order,
        sums={"_number": F.lit(1)},
        rows_per_segment=rows_per_segment,
    ).select(*keys, F.col("name").alias("_base"), "_number", at.alias("_base_at"))
    rivals = written(literals.join(base_calls, [*keys, "_base", "_number"]), "rival-names")

    limits = (
        rivals.where(F.col("_literal_at") < F.col("_base_at"))
        .groupBy(*keys, "_base")
        .agg((F.min("_number") - 1).alias("_limit"))
    )
    reachable = F.col("_limit").isNull() | (F.col("_number") <= F.col("_limit"))
    edges = (
        rivals.where(F.col("_base_at") < F.col("_literal_at"))
        .join(limits, [*keys, "_base"], "left")
        .where(reachable)
        .select(*keys, "name")
    )
    blocked = _blocked(edges, keys).withColumn("_limit", F.lit(0).cast("bigint"))
    both = limits.withColumnRenamed("_base", "name").unionByName(blocked)
    return both.groupBy(*keys, "name").agg(F.min("_limit").alias("_limit"))


def _blocked(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Literals that fail from their first call.

    A literal with an edge fails unless its base fails too, so it fails when the unbroken
    run of edges from it towards its root has odd length.
    """
    numbers = F.split(F.regexp_extract("name", TRAILING_NUMBERS, 1), "#")
    depth = F.size(numbers) - 1
    root = F.regexp_replace("name", TRAILING_NUMBERS, "")
    ancestors = F.transform(
        F.sequence(F.lit(1), depth),
        lambda up: F.concat(root, F.array_join(F.slice(numbers, 1, depth - up + 1), "#")),
    )
    walk = edges.select(*keys, "name", F.posexplode(ancestors).alias("_up", "_ancestor"))
    walk = walk.withColumn("_up", F.col("_up") + 1)
    present = edges.select(*keys, F.col("name").alias("_ancestor"), F.lit(True).alias("_edge"))
    first_gap = F.min(F.when(F.col("_edge").isNull(), F.col("_up")))
    return (
        walk.join(present, [*keys, "_ancestor"], "left")
        .groupBy(*keys, "name")
        .agg(first_gap.alias("_run"))
        .where(F.col("_run") % 2 == 1)
        .select(*keys, "name")
    )
