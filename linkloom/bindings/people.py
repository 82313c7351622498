"""Person queries: neighbouring link texts of a page form ``LAST, FIRST`` names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.bindings import duck
from linkloom.bindings.base import table
from linkloom.operators.aggregates import value_counts
from linkloom.plans import graph, people
from linkloom.session import cut_lineage

LINK = "<a [^>]*>([^<]*)</a>"


def _persons(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "pages").select("page_id", F.regexp_extract_all("html", F.lit(LINK), F.lit(1)).alias("a"))
    names = F.expr("transform(slice(a, 1, size(a) - 1), (x, i) -> concat(x, ', ', a[i + 1]))")
    rows = links.where(F.size("a") > 1).select("page_id", F.posexplode(names).alias("seq", "name"))
    return rows.withColumn("name", F.translate("name", "ß", "·"))


def person_exact_ids(spark: SparkSession, d: str) -> DataFrame:
    return people.exact_ids(_persons(spark, d), "name")


def person_fuzzy_ids(spark: SparkSession, d: str) -> DataFrame:
    return people.fuzzy_ids(_persons(spark, d), "name", ["page_id", "seq"])


def person_graph(spark: SparkSession, d: str) -> DataFrame:
    """Who shares a page with whom, after disambiguation, with the multi-valued name attribute."""
    persons = cut_lineage(people.fuzzy_ids(_persons(spark, d), "name", ["page_id", "seq"]))
    edges = graph.edges_of(graph.members_of(persons, "page_id", "person_id"))
    return edges.drop("win")


def name_frequency(spark: SparkSession, d: str) -> DataFrame:
    return value_counts(_persons(spark, d), "name")


QUERIES = {f.__name__: f for f in (person_exact_ids, person_fuzzy_ids, person_graph, name_frequency)}

_ROWS = f"""
lnk AS (SELECT page_id, regexp_extract_all(html, '{LINK}', 1) AS a FROM pages),
per AS MATERIALIZED (SELECT page_id, (i - 1)::INTEGER AS seq, replace(a[i] || ', ' || a[i + 1], 'ß', '·') AS name
       FROM (SELECT page_id, a, unnest(range(1, len(a))) AS i FROM lnk))"""
_FUZZY = f"""
rws AS MATERIALIZED (SELECT *, upper(name) AS label, row_number() OVER (ORDER BY upper(name), page_id, seq) - 1 AS pos FROM per),
nms AS MATERIALIZED (SELECT label, min(pos) AS at1, regexp_split_to_array(label, ' ?[.,] ?') AS p FROM rws GROUP BY label),
prs AS MATERIALIZED (SELECT a.label AS la, b.label AS lb, a.at1 AS pa, b.at1 AS pb, a.p AS xp, b.p AS yp, len(a.p) = 2 AND len(b.p) = 2 AS twop
       FROM nms a JOIN nms b ON left(a.label, 3) = left(b.label, 3) AND a.at1 < b.at1
       WHERE NOT (len(a.p) = 2 AND len(b.p) = 2) OR contains(a.p[2], b.p[2]) OR contains(b.p[2], a.p[2])),
src AS (SELECT xp[1] AS a, yp[1] AS b FROM prs WHERE twop UNION SELECT xp[2], yp[2] FROM prs WHERE twop UNION SELECT la, lb FROM prs WHERE NOT twop),
{duck.jarow_ctes('jw', 'src')},
jwm AS MATERIALIZED (SELECT * FROM jw),
scr AS (SELECT pa, pb, (s.j * least(length(xp[1]), length(yp[1])) + g.j * least(length(xp[2]), length(yp[2])))
         / (least(length(xp[1]), length(yp[1])) + least(length(xp[2]), length(yp[2]))) AS v
        FROM prs JOIN jwm s ON s.a = xp[1] AND s.b = yp[1] JOIN jwm g ON g.a = xp[2] AND g.b = yp[2] WHERE twop
        UNION ALL SELECT pa, pb, w.j FROM prs JOIN jwm w ON w.a = la AND w.b = lb WHERE NOT twop),
par AS MATERIALIZED (SELECT pb AS child, min(pa) AS parent FROM scr WHERE v > 0.95 GROUP BY 1),
clm AS (SELECT child, parent FROM par UNION ALL SELECT c.child, p.parent FROM clm c JOIN par p ON p.child = c.parent),
rts AS MATERIALIZED (SELECT child, min(parent) AS root FROM clm GROUP BY 1),
bad AS (SELECT DISTINCT x.root FROM rts x JOIN nms a ON a.at1 = x.child JOIN rts y ON y.root = x.root JOIN nms b ON b.at1 = y.child
        WHERE len(a.p) = 2 AND len(b.p) = 2 AND NOT contains(a.p[2], b.p[2]) AND NOT contains(b.p[2], a.p[2])),
ids AS MATERIALIZED (SELECT label, coalesce(CASE WHEN root NOT IN (SELECT root FROM bad) THEN root END, at1) AS person_id FROM nms LEFT JOIN rts ON child = at1)"""

ORACLES = {
    "person_exact_ids": f"WITH {_ROWS} SELECT page_id, seq, name, dense_rank() OVER (ORDER BY upper(name)) - 1 AS person_id FROM per",
    "person_fuzzy_ids": f"WITH RECURSIVE {_ROWS}, {_FUZZY} SELECT page_id, seq, name, person_id FROM per JOIN ids ON ids.label = upper(name)",
    "person_graph": f"""WITH RECURSIVE {_ROWS}, {_FUZZY}, mem AS (SELECT DISTINCT page_id, person_id FROM per JOIN ids ON ids.label = upper(name))
        SELECT a.person_id AS src, b.person_id AS dst, count(*) AS weight FROM mem a JOIN mem b ON a.page_id = b.page_id AND a.person_id < b.person_id GROUP BY ALL""",
    "name_frequency": f"WITH {_ROWS} SELECT name, count(*) AS n FROM per GROUP BY 1",
}
