"""Geocoding queries.

Domestic: part names are the cities of their brands (states); every order line mentions one,
misspelt in a way that depends on its flags.  Foreign: the words of the benchmark are places of
one country, the link texts of all pages are looked up there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.bindings import duck
from linkloom.bindings.base import table
from linkloom.functions.text import fold_ascii
from linkloom.plans import places
from linkloom.session import cut_lineage

LINK = "<a [^>]*>([^<]*)</a>"
KEYS = places.PLACE_KEY


def _usloc(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").groupBy("p_name", "p_brand").agg(
        F.min("p_size").alias("lat"), F.max("p_retailprice").alias("long"), F.min("p_partkey").alias("zip")
    )
    return places.domestic_gazetteer(part, "p_name", "p_brand", "lat", "long", "zip")


def _gnsloc(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "benchmark").select("item_id", F.explode(F.split("text", "[ .,\n]+")).alias("w")).where("w <> ''")
    named = words.groupBy(F.upper("w").alias("full_name_ro")).agg(
        F.min("item_id").cast("double").alias("lat"), F.max("item_id").cast("double").alias("long")
    )
    folded = fold_ascii(F.col("full_name_ro"))
    return named.select(
        F.lit("EN").alias("cc1"), "lat", "long", "full_name_ro", folded.alias("full_name_nd_ro"),
        F.when(F.length("full_name_ro") > 4, F.substring("full_name_ro", 1, 4)).otherwise("").alias("short_form"),
        folded.alias("sort_name_ro"),
    )


def _typos(spark: SparkSession, d: str) -> DataFrame:
    """Corrections for the cities of one flag: the reversed name stands for the name."""
    part = table(spark, d, "part").select("p_name", "p_brand").distinct()
    return part.select(
        F.reverse(F.upper("p_name")).alias("city"), F.upper("p_brand").alias("state"), F.lit("US").alias("country"),
        F.upper("p_name").alias("ncity"), F.upper("p_brand").alias("nstate"), F.lit("US").alias("ncountry"),
    )


def _domestic(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    name = F.col("p_name")
    city = (
        F.when(F.expr("l_returnflag = 'A' AND l_linestatus = 'O'"), F.replace(name, F.lit(" "), F.lit("")))
        .when(F.expr("l_returnflag = 'A'"), F.concat(F.substring(name, 1, 5), F.lit("e"), F.substr(name, F.lit(6))))
        .when(F.expr("l_returnflag = 'R' AND l_linestatus = 'O'"), F.concat(F.lit("old quarter, "), name))
        .when(F.expr("l_returnflag = 'R'"), F.reverse(name))
        .when(F.expr("l_linestatus = 'O'"), F.concat(name, F.lit("x")))
        .otherwise(name)
    )
    return lines.select(
        city.alias("city"), F.col("p_brand").alias("state"), F.lit("us").alias("country"),
        F.when(F.col("l_returnflag") == "N", F.col("l_partkey").cast("string")).otherwise("").alias("zipcode"),
    )


def _foreign(spark: SparkSession, d: str) -> DataFrame:
    links = F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    return table(spark, d, "pages").select(links.alias("city"), F.lit("").alias("state"), F.lit("en").alias("country"))


def _loc(spark: SparkSession, d: str) -> DataFrame:
    home = places.place_counts(_domestic(spark, d), "city", "state", "country", "zipcode")
    abroad = places.place_counts(_foreign(spark, d), "city", "state", "country")
    return cut_lineage(places.build_places(abroad, home, _typos(spark, d)))


def _resolved(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    loc = _loc(spark, d)
    return loc, places.resolve_places(loc, cut_lineage(_usloc(spark, d)), cut_lineage(_gnsloc(spark, d)))


def gazetteer_build(spark: SparkSession, d: str) -> DataFrame:
    return _usloc(spark, d)


def place_table(spark: SparkSession, d: str) -> DataFrame:
    return _loc(spark, d)


def geocode_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Candidates per rule, before the first rule wins."""
    found = places.candidates(_loc(spark, d), cut_lineage(_usloc(spark, d)), cut_lineage(_gnsloc(spark, d)))
    first = found.groupBy(*KEYS).agg(F.min("turn").alias("turn"))
    return found.join(first, [*KEYS, "turn"]).groupBy("rule").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("val"), 4).alias("val")
    )


def geocode_cascade(spark: SparkSession, d: str) -> DataFrame:
    _, resolved = _resolved(spark, d)
    return resolved.withColumn("val", F.round("val", 6))


def geocode_progress(spark: SparkSession, d: str) -> DataFrame:
    loc, resolved = _resolved(spark, d)
    return places.progress(loc, cut_lineage(resolved))


def geocode_unresolved(spark: SparkSession, d: str) -> DataFrame:
    loc, resolved = _resolved(spark, d)
    return places.unresolved(loc, resolved).select(*KEYS, "cnt")


def geocode_attach(spark: SparkSession, d: str) -> DataFrame:
    """Geocodes on the entity rows, counted per raw place."""
    _, resolved = _resolved(spark, d)
    entities = _domestic(spark, d).select(F.upper("city").alias("city"), F.upper("state").alias("state"), F.upper("country").alias("country"), "zipcode")
    counted = entities.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    return places.attach_places(counted, cut_lineage(resolved), "city", "state", "country", "zipcode")


QUERIES = {
    f.__name__: f
    for f in (
        gazetteer_build, place_table, geocode_candidates, geocode_cascade, geocode_progress, geocode_unresolved, geocode_attach,
    )
}

_US = """us AS MATERIALIZED (SELECT min(p_partkey)::VARCHAR AS zipcode, min(p_size)::DOUBLE AS lat, max(p_retailprice)::DOUBLE AS long, upper(p_name) AS city,
   replace(upper(p_name), ' ', '') AS blk_city, left(replace(upper(p_name), ' ', ''), 3) AS city3, right(replace(upper(p_name), ' ', ''), 4) AS city4r, upper(p_brand) AS state
   FROM part GROUP BY p_name, p_brand)"""
_W = "replace(upper(replace(w, 'ß', '·')), '·', 'SS')"
_GN = f"""gn AS MATERIALIZED (SELECT 'EN' AS cc1, min(item_id)::DOUBLE AS lat, max(item_id)::DOUBLE AS long, {_W} AS full_name_ro, {duck.fold(_W)} AS full_name_nd_ro,
   CASE WHEN length({_W}) > 4 THEN left({_W}, 4) ELSE '' END AS short_form, {duck.fold(_W)} AS sort_name_ro
   FROM (SELECT item_id, unnest(regexp_split_to_array(text, '[ .,\\n]+')) AS w FROM benchmark) WHERE w <> '' GROUP BY {_W})"""


def _loc_sql() -> str:
    """Places after cleaning; the US rules that the data can reach are those of the shared rule list."""
    from linkloom.bindings.text import _place_sql
    from linkloom.functions import places as rules

    city_us = duck.swap_all("place", rules.CITY_RULES["US"])
    abroad = duck.swap("place", *rules.SAINT_ABROAD)
    edged = f"regexp_replace(regexp_replace(CASE WHEN country = 'US' THEN {city_us} ELSE {abroad} END, '^,', ''), ',$', '')"
    clean = duck.strip(f"regexp_replace({edged}, '[-]|  +', ' ', 'g')")
    return f"""
dom AS (SELECT CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN replace(p_name, ' ', '') WHEN l_returnflag = 'A' THEN left(p_name, 5) || 'e' || substr(p_name, 6)
   WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'old quarter, ' || p_name WHEN l_returnflag = 'R' THEN reverse(p_name)
   WHEN l_linestatus = 'O' THEN p_name || 'x' ELSE p_name END AS city, p_brand AS state, 'US' AS country, CASE WHEN l_returnflag = 'N' THEN l_partkey::VARCHAR ELSE '' END AS zipcode, 1 AS source
   FROM lineitem JOIN part ON l_partkey = p_partkey),
ent AS (SELECT * FROM dom UNION ALL SELECT unnest(regexp_extract_all(html, '{LINK}', 1)), '', 'EN', '', 0 FROM pages),
grp AS MATERIALIZED (SELECT replace(upper(replace(city, 'ß', '·')), '·', 'SS') AS city, upper(state) AS state, country, zipcode, source, count(*) AS n FROM ent WHERE city <> '' OR zipcode <> '' GROUP BY ALL),
{_place_sql('grp', 'city')},
cln AS (SELECT {clean} AS city, state, country, zipcode, source, sum(n)::BIGINT AS cnt FROM _p3 GROUP BY ALL),
typ AS (SELECT DISTINCT reverse(upper(p_name)) AS city, upper(p_brand) AS state, upper(p_name) AS ncity FROM part),
loc AS MATERIALIZED (SELECT c.city, c.state, c.country, c.zipcode, c.cnt, t.ncity, CASE WHEN t.city IS NOT NULL THEN t.state END AS nstate,
   CASE WHEN t.city IS NOT NULL THEN 'US' END AS ncountry, left(c.city, 3) AS city3
   FROM (SELECT * FROM cln WHERE city <> '' QUALIFY row_number() OVER (PARTITION BY city, state, country, zipcode ORDER BY source DESC) = 1) c
   LEFT JOIN typ t ON t.city = c.city AND t.state = c.state AND c.country = 'US')"""


def _cascade_sql() -> str:
    """One SELECT per rule over the segments; the least turn per place wins."""
    place = "p.city, p.state, p.country, p.zipcode"
    home = "u.city AS g_city, u.state AS g_state, 'US' AS g_country, coalesce(u.zipcode, '') AS g_zipcode, u.lat AS g_lat, u.long AS g_long"
    away = "g.full_name_nd_ro AS g_city, '' AS g_state, g.cc1 AS g_country, '' AS g_zipcode, g.lat AS g_lat, g.long AS g_long"
    late = 1 << 40
    parts, sims = [], []

    def exact(rule: int, val: int, source: str, gaz: str, key: str, cols: str, turn: str) -> None:
        parts.append(f"SELECT {place}, {turn} AS turn, {rule} AS rule, {val}::DOUBLE AS val, {cols} FROM {source} p JOIN {gaz} ON {key}")

    for rule, val, key in ((1, 11, "p.seg = u.city"), (2, 11, "p.blk = u.blk_city")):
        exact(rule, val, "seg", "us u", f"{key} AND p.seg <> '' AND p.state = u.state AND p.country = 'US'", home, f"p.base + {rule}")
    for rule, key in ((5, "p.seg = g.full_name_ro"), (6, "p.seg = g.full_name_nd_ro"), (7, "p.seg = g.short_form"), (8, "p.blk = g.sort_name_ro")):
        exact(rule, 21, "seg", "gn g", f"{key} AND p.seg <> '' AND p.country = g.cc1", away, f"p.base + {rule}")
    exact(11, 15, "loc", "us u", "p.ncity = u.city AND p.nstate = u.state AND p.ncountry = 'US'", home, f"{late + 11}")
    exact(17, 31, "loc", "us u", "p.country = 'US' AND regexp_full_match(p.zipcode, '[0-9]+') AND try_cast(p.zipcode AS BIGINT) = try_cast(u.zipcode AS BIGINT)", home, f"{late + 17}")
    for rule, key, add, least in ((3, "left(p.blk, 3) = u.city3", 0, 0.92), (4, "right(p.blk, 4) = u.city4r", 10, 0.90)):
        sims.append((rule, add, least, "seg", "us u", f"{key} AND p.blk <> '' AND p.state = u.state AND p.country = 'US'", home, f"p.base + {rule}", "p.blk", "u.blk_city"))
    for rule, key, least in ((9, "left(p.blk, 3) = g.sort_name_ro", 0.92), (10, "right(p.blk, 4) = g.sort_name_ro", 0.90)):
        sims.append((rule, 20, least, "seg", "gn g", f"{key} AND p.blk <> '' AND p.country = g.cc1", away, f"p.base + {rule}", "p.blk", "g.sort_name_ro"))
    sims.append((12, 14, 0.95, "loc", "us u", "left(replace(p.ncity, ' ', ''), 3) = u.city3 AND p.nstate = u.state AND p.ncountry = 'US'", home, f"{late + 12}", "replace(p.ncity, ' ', '')", "u.blk_city"))
    source = " UNION ".join(f"SELECT {a} AS a, {b} AS b FROM {src} p JOIN {gaz} ON {key}" for _, _, _, src, gaz, key, _, _, a, b in sims)
    for rule, add, least, src, gaz, key, cols, turn, a, b in sims:
        parts.append(f"SELECT {place}, {turn} AS turn, {rule} AS rule, {add} + j AS val, {cols} FROM {src} p JOIN {gaz} ON {key} JOIN jwm ON jwm.a = {a} AND jwm.b = {b} WHERE j > {least}")
    result = "g_city, g_state, g_country, g_zipcode, g_lat, g_long"
    return f"""
sg0 AS (SELECT loc.*, unnest(range(-1, len(regexp_extract_all(city, '[,|]')) + 1)) AS i FROM loc),
sg1 AS (SELECT *, (i + 1) * 10 AS base, CASE WHEN i = -1 THEN city ELSE coalesce(regexp_split_to_array(city, ' *?[,|] *')[i + 1], '') END AS seg FROM sg0),
seg AS MATERIALIZED (SELECT *, replace(seg, ' ', '') AS blk FROM sg1),
src AS ({source}), {duck.jarow_ctes('jw', 'src')}, jwm AS MATERIALIZED (SELECT * FROM jw),
cnd AS MATERIALIZED ({' UNION ALL '.join(parts)}),
fst AS MATERIALIZED (SELECT * FROM cnd QUALIFY turn = min(turn) OVER (PARTITION BY city, state, country, zipcode)),
res AS MATERIALIZED (SELECT city, state, country, zipcode, rule, count(*) OVER (PARTITION BY city, state, country, zipcode) AS mtch, val, {result}, left(city, 3) AS city3
   FROM fst QUALIFY row_number() OVER (PARTITION BY city, state, country, zipcode ORDER BY val DESC, {result}) = 1)"""


_ALL = f"{_US}, {_GN}, {_loc_sql()}, {_cascade_sql()}"
ORACLES = {
    "gazetteer_build": f"WITH {_US} SELECT * FROM us",
    "place_table": f"WITH {_loc_sql()} SELECT * FROM loc",
    "geocode_candidates": f"WITH {_ALL} SELECT rule, count(*) AS n, round(sum(val), 4) AS val FROM fst GROUP BY 1",
    "geocode_cascade": f"WITH {_ALL} SELECT * REPLACE (round(val, 6) AS val) FROM res",
    "geocode_progress": f"WITH {_ALL} SELECT (SELECT count(*) FROM loc) - (SELECT count(*) FROM res) AS remaining, (SELECT count(*) FROM res) AS matched, (SELECT count(*) FROM loc) AS total",
    "geocode_unresolved": f"WITH {_ALL} SELECT city, state, country, zipcode, cnt FROM loc ANTI JOIN res USING (city, state, country, zipcode)",
    "geocode_attach": f"""WITH {_ALL}, e AS (SELECT upper(city) AS city, upper(state) AS state, country, zipcode, count(*) AS n FROM dom GROUP BY ALL),
        crs AS (SELECT * FROM res QUALIFY row_number() OVER (PARTITION BY city, state, country ORDER BY zipcode DESC, g_city DESC) = 1)
        SELECT e.*, coalesce(f.g_city, c.g_city) AS ncity, coalesce(f.g_state, c.g_state) AS nstate, coalesce(f.g_country, c.g_country) AS ncountry,
        coalesce(f.g_zipcode, c.g_zipcode) AS nzipcode, coalesce(f.g_lat, c.g_lat) AS nlat, coalesce(f.g_long, c.g_long) AS nlong
        FROM e LEFT JOIN crs c USING (city, state, country) LEFT JOIN res f ON f.city = e.city AND f.state = e.state AND f.country = e.country AND f.zipcode = e.zipcode""",
}
