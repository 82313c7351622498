"""Update a table's columns from another table on shared keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.upsert import last_per_key

Pairs = Mapping[str, str] | Sequence[str]


def _pairs(names: Pairs) -> dict[str, str]:
    return dict(names) if isinstance(names, Mapping) else {n: n for n in names}


def update_join(
    target: DataFrame, source: DataFrame, on: Pairs, columns: Pairs, order: Sequence[str] | None = None
) -> DataFrame:
    """Overwrite ``columns`` (target name to source name) where the key matches.

    A match writes the source value even when it is NULL; rows without a match keep
    theirs, and target columns that do not exist yet start as NULL.  The source is
    reduced to its last row per key by ``order`` first.
    """
    keys, sets = _pairs(on), _pairs(columns)
    source_keys = [f"_k{i}" for i in range(len(keys))]
    narrow = source.select(
        *[F.col(s).alias(k) for s, k in zip(keys.values(), source_keys)],
        *[F.col(s).alias(f"_v{i}") for i, s in enumerate(sets.values())],
        *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order or [])],
    )
    lookup = last_per_key(narrow, source_keys, [c for c in narrow.columns if c.startswith("_o")] or source_keys)
    lookup = lookup.select(*source_keys, *[c for c in lookup.columns if c.startswith("_v")], F.lit(True).alias("_hit"))
    condition = [F.col(t) == F.col(k) for t, k in zip(keys, source_keys)]
    joined = target.join(lookup, condition, "left")
    updated = {
        name: F.when(F.col("_hit"), F.col(f"_v{i}")).otherwise(
            F.col(name) if name in target.columns else F.lit(None)
        )
        for i, name in enumerate(sets)
    }
    names = list(target.columns) + [n for n in sets if n not in target.columns]
    return joined.select(*[updated[n].alias(n) if n in updated else F.col(n) for n in names])


def layered_update(
    target: DataFrame, layers: Sequence[tuple[DataFrame, Pairs, Pairs, Sequence[str] | None]]
) -> DataFrame:
    """Apply update-joins from the coarsest key to the finest; the finest match wins."""
    for source, on, columns, order in layers:
        target = update_join(target, source, on, columns, order)
    return target
