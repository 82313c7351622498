"""Building blocks for the SQL counterparts."""

from __future__ import annotations

from collections.abc import Iterable


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def swap(expr: str, pattern: str, replacement: str = "") -> str:
    back = replacement.replace("$1", "\\1")
    return f"regexp_replace({expr}, {quote(pattern)}, {quote(back)}, 'g')"


def swap_all(expr: str, rules: Iterable[tuple[str, str]]) -> str:
    for pattern, replacement in rules:
        expr = swap(expr, pattern, replacement)
    return expr


def strip(expr: str) -> str:
    return swap(expr, r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$")


def fold(expr: str) -> str:
    return swap(f"strip_accents({expr})", r"[^\x00-\x7F]")


def jarow_ctes(name: str, source: str) -> str:
    """CTEs ending in ``name``(a, b, j): the comparator over the distinct (a, b) of ``source``."""
    lo = "greatest(0, i - 1 - d)"
    hi = "least(length(s), i - 1 + d)"
    span = f"greatest({hi} + CAST({lo} = {hi} AS BIGINT) - {lo}, 0)"
    place = f"instr(substring(z.s, {lo} + 1, {span}), substring(l, i, 1))"
    step = (
        f"CASE WHEN {place} = 0 THEN z ELSE {{'s': substring(z.s, 1, {lo} + {place} - 1) || chr(1) || "
        f"substring(z.s, {lo} + {place} + 1), 'm': z.m || substring(l, i, 1)}} END"
    )
    return f"""
{name}_p AS (
  SELECT DISTINCT a, b, CASE WHEN length(a) > length(b) THEN b ELSE a END AS s,
         CASE WHEN length(a) > length(b) THEN a ELSE b END AS l,
         greatest(length(a), length(b)) // 2 - 1 AS d
  FROM {source}),
{name}_m AS (
  SELECT *, list_reduce(range(1, length(l) + 1), lambda z, i: {step}, {{'s': s, 'm': ''}}) AS r FROM {name}_p
  WHERE a <> b AND a <> '' AND b <> ''),
{name}_o AS (
  SELECT *, r.m AS m,
         list_aggregate(list_transform(list_filter(range(1, length(s) + 1), lambda k: substring(r.s, k, 1) = chr(1)),
                        lambda k: substring(s, k, 1)), 'string_agg', '') AS o,
         coalesce(list_filter(range(0, least(5, length(s))), lambda k: substring(s, k + 1, 1) <> substring(l, k + 1, 1))[1],
                  least(5, length(s)) - 1) AS pre
  FROM {name}_m),
{name}_d AS (
  SELECT *, CASE WHEN m = '' THEN 0.0::DOUBLE ELSE
      (length(m)::DOUBLE / length(s) + length(m)::DOUBLE / length(l)
       + (length(m) - 0.5::DOUBLE * len(list_filter(range(1, length(m) + 1), lambda k: substring(m, k, 1) <> substring(o, k, 1)))) / length(m))
      * (1.0::DOUBLE / 3.0::DOUBLE) END AS dj
  FROM {name}_o),
{name} AS (
  SELECT a, b, dj + 0.1::DOUBLE * pre * (1.0::DOUBLE - dj) AS j FROM {name}_d
  UNION ALL
  SELECT a, b, CASE WHEN a = b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM {name}_p WHERE a = b OR a = '' OR b = '')"""
