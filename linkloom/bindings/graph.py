"""Graph queries.

Dense graph: parts that appear in one order (three-year windows of the ship date).
Sparse graph: orders that ship the same part on the same day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.bindings.base import table
from linkloom.plans import graph
from linkloom.session import cut_lineage, scratch_path
from linkloom.sources import sinks

BEGIN, WIDTH, ROUNDS = 1995, 3, 10


def _windowed(spark: SparkSession, d: str) -> DataFrame:
    window = graph.window_start(F.year("l_shipdate"), BEGIN, WIDTH)
    return graph.members_of(table(spark, d, "lineitem"), "l_orderkey", "l_partkey", window)


def _all_time(spark: SparkSession, d: str) -> DataFrame:
    return graph.members_of(table(spark, d, "lineitem"), "l_orderkey", "l_partkey")


def _sparse(spark: SparkSession, d: str) -> DataFrame:
    shipment = F.concat_ws("@", F.col("l_partkey").cast("string"), F.date_format("l_shipdate", "yyyy-MM-dd"))
    lines = table(spark, d, "lineitem").withColumn("shipment", shipment)
    return graph.members_of(lines, "shipment", "l_orderkey")


def graph_vertices(spark: SparkSession, d: str) -> DataFrame:
    source = table(spark, d, "lineitem").select(
        F.lit(graph.ALL_TIME).alias("win"), F.col("l_partkey").alias("person"), "l_shipdate", "l_suppkey", "l_quantity"
    )
    attributes = {
        "first_supplier": F.min_by("l_suppkey", F.struct("l_shipdate", "l_suppkey")),
        "quantity": F.sum("l_quantity"),
    }
    return graph.vertices_of(_all_time(spark, d), attributes, source)


def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.edges_of(_all_time(spark, d)).drop("win")


def graph_edges_by_year(spark: SparkSession, d: str) -> DataFrame:
    members = graph.members_of(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey", F.year("l_shipdate"))
    return graph.edges_of(members)


def graph_edge_rows(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("doc"), F.year("o_orderdate").alias("year"), "o_orderpriority"
    )
    members = graph.members_of(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey")
    return graph.edge_rows(members, orders).drop("win")


def graph_windows(spark: SparkSession, d: str) -> DataFrame:
    members = cut_lineage(_windowed(spark, d))
    return graph.summary(graph.vertices_of(members), graph.edges_of(members))


def degree(spark: SparkSession, d: str) -> DataFrame:
    return graph.degrees(_windowed(spark, d))


def unique_degree(spark: SparkSession, d: str) -> DataFrame:
    members = cut_lineage(_windowed(spark, d))
    return graph.degrees(members, graph.edges_of(members))


def restricted_edges(spark: SparkSession, d: str) -> DataFrame:
    """The graph among the parts of one type."""
    wanted = table(spark, d, "part").where("p_type = 'ECONOMY'")
    return graph.edges_of(graph.restrict_to(_all_time(spark, d), wanted, "p_partkey")).drop("win")


def attached_edges(spark: SparkSession, d: str) -> DataFrame:
    brands = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("src_brand"))
    edges = graph.edges_of(_all_time(spark, d))
    return graph.attach(edges, "src", brands, "p_partkey").groupBy("src_brand").agg(
        F.count(F.lit(1)).alias("n_edges"), F.sum("weight").alias("weight")
    )


def components(spark: SparkSession, d: str) -> DataFrame:
    return graph.components(_sparse(spark, d)).drop("win")


def component_rank(spark: SparkSession, d: str) -> DataFrame:
    return graph.component_sizes(graph.components(_sparse(spark, d))).drop("win")


def largest_component(spark: SparkSession, d: str) -> DataFrame:
    members = cut_lineage(_sparse(spark, d))
    return graph.nth_component(graph.edges_of(members), graph.components(members), 0).drop("win")


def neighbourhood_2hop(spark: SparkSession, d: str) -> DataFrame:
    seeds = table(spark, d, "orders").where("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
    return graph.neighbourhood(_sparse(spark, d), seeds.select(F.col("o_orderkey").alias("person")), 2)


def edge_select(spark: SparkSession, d: str) -> DataFrame:
    members = cut_lineage(_all_time(spark, d))
    edges = graph.select_edges(graph.edges_of(members), "weight", at_least=2)
    return graph.touched(graph.vertices_of(members), edges).drop("win")


def clustering_coefficient(spark: SparkSession, d: str) -> DataFrame:
    edges = cut_lineage(graph.edges_of(_windowed(spark, d)))
    return graph.clustering(edges).withColumn("clustering", F.round("clustering", 9))


def burt_constraint(spark: SparkSession, d: str) -> DataFrame:
    edges = cut_lineage(graph.edges_of(_windowed(spark, d)))
    return graph.constraint(edges).withColumn("constraint", F.round("constraint", 9))


def pagerank(spark: SparkSession, d: str) -> DataFrame:
    members = cut_lineage(_windowed(spark, d))
    ranks = graph.pagerank(graph.vertices_of(members), graph.edges_of(members), ROUNDS)
    return ranks.withColumn("pagerank", F.round("pagerank", 9))


def eigenvector(spark: SparkSession, d: str) -> DataFrame:
    members = cut_lineage(_windowed(spark, d))
    scores = graph.eigenvector(graph.vertices_of(members), graph.edges_of(members), ROUNDS)
    return scores.withColumn("eigenvector", F.round("eigenvector", 9))


def pagerank_converged(spark: SparkSession, d: str) -> DataFrame:
    members = cut_lineage(_windowed(spark, d))
    ranks = graph.converged_pagerank(graph.vertices_of(members), graph.edges_of(members))
    return ranks.select("win", "person", F.round("pagerank", 9).alias("pagerank"))


def eigenvector_converged(spark: SparkSession, d: str) -> DataFrame:
    """The leading eigenvector within the largest component of the graph of all time."""
    members = cut_lineage(_all_time(spark, d))
    # a component's edges come from its own members, so no other pairs are made
    members = cut_lineage(graph.members_within(members, cut_lineage(graph.components(members)), 0))
    scores = graph.converged_eigenvector(graph.vertices_of(members), graph.edges_of(members))
    return scores.select("win", "person", F.round("eigenvector", 8).alias("eigenvector"))


def central_labels(spark: SparkSession, d: str) -> DataFrame:
    """The two best-ranked orders of every component with at least three."""
    members = cut_lineage(_sparse(spark, d))
    ranks = graph.pagerank(graph.vertices_of(members), graph.edges_of(members), ROUNDS, damping=0.95)
    ranks = ranks.withColumn("pagerank", F.round("pagerank", 12))
    scored = ranks.join(graph.components(members), ["win", "person"])
    return graph.central_labels(scored, "component", "pagerank", 3, 2).drop("win")


def betweenness(spark: SparkSession, d: str) -> DataFrame:
    """Exact: a search from every order of the sparse graph."""
    found = graph.betweenness(graph.edges_of(_sparse(spark, d)))
    return found.select("person", F.round("betweenness", 6).alias("betweenness"))


def edge_betweenness(spark: SparkSession, d: str) -> DataFrame:
    """Exact, for the edges of the sparse graph."""
    found = graph.edge_betweenness(cut_lineage(graph.edges_of(_sparse(spark, d))))
    return found.select("src", "dst", F.round("betweenness", 6).alias("betweenness"))


def betweenness_sampled(spark: SparkSession, d: str) -> DataFrame:
    """Estimates within a quarter of all pairs in the suppliers' graph of each year, from as many searches as that takes."""
    members = graph.members_of(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey", F.year("l_shipdate"))
    edges = cut_lineage(graph.edges_of(members))
    return graph.betweenness(edges, cut_lineage(graph.sampled_sources(edges, error=0.25, doubt=0.01)))


def window_measures(spark: SparkSession, d: str) -> DataFrame:
    members = cut_lineage(_windowed(spark, d))
    rows = graph.window_measures(members, graph.edges_of(members), ROUNDS)
    return rows.select(
        "win", "person", "n_docs", "degree", "unique_degree", "component", "size", "rank",
        *[F.round(c, 9).alias(c) for c in ("clustering", "constraint", "pagerank", "eigenvector")],
    )


def graphml(spark: SparkSession, d: str) -> DataFrame:
    """GraphML text lines of the sparse graph."""
    members = cut_lineage(_sparse(spark, d))
    lines = sinks.graphml_lines(graph.vertices_of(members), graph.edges_of(members), ["n_docs"], ["weight"])
    return lines.drop("win")


def graphml_files(spark: SparkSession, d: str) -> DataFrame:
    """A GraphML file per year of the suppliers' graph, written and read back: its files, nodes, edges, first and last line."""
    members = cut_lineage(graph.members_of(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey", F.year("l_shipdate")))
    path = scratch_path(spark, "graphml")
    sinks.write_graphml_files(sinks.graphml_lines(graph.vertices_of(members), graph.edges_of(members), ["n_docs"], ["weight"]), path)
    lines = spark.read.text(path).withColumns({"_at": F.monotonically_increasing_id(), "_file": F.col("_metadata.file_path")})
    kinds = {"n_nodes": "<node", "n_edges": "<edge"}
    return lines.groupBy("win").agg(
        F.count_distinct("_file").alias("n_files"), *[F.count(F.when(F.col("value").startswith(tag), 1)).alias(n) for n, tag in kinds.items()],
        F.left(F.min_by("value", F.struct("_file", "_at")), F.lit(9)).alias("opening"), F.max_by("value", F.struct("_file", "_at")).alias("closing"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        graph_vertices, graph_edges, graph_edges_by_year, graph_edge_rows, graph_windows, degree, unique_degree,
        restricted_edges, attached_edges, components, component_rank, largest_component, neighbourhood_2hop,
        edge_select, clustering_coefficient, burt_constraint, pagerank, eigenvector, pagerank_converged, eigenvector_converged,
        central_labels, betweenness, edge_betweenness, betweenness_sampled, window_measures, graphml, graphml_files,
    )
}

_WIN = f"({BEGIN} + floor((year(l_shipdate) - {BEGIN}) / {WIDTH}.0) * {WIDTH})::INTEGER"
_MEMBERS = f"mem AS MATERIALIZED (SELECT DISTINCT {_WIN} AS win, l_orderkey AS doc, l_partkey AS person FROM lineitem)"
_ALL = "mem AS MATERIALIZED (SELECT DISTINCT 0 AS win, l_orderkey AS doc, l_partkey AS person FROM lineitem)"
_SPARSE = """mem AS MATERIALIZED (SELECT DISTINCT 0 AS win, l_partkey || '@' || strftime(l_shipdate, '%Y-%m-%d') AS doc, l_orderkey AS person FROM lineitem)"""
_EDGES = """edg AS MATERIALIZED (SELECT a.win, a.person AS src, b.person AS dst, count(*) AS weight
    FROM mem a JOIN mem b ON a.win = b.win AND a.doc = b.doc AND a.person < b.person GROUP BY ALL),
two AS MATERIALIZED (SELECT win, src, dst FROM edg UNION ALL SELECT win, dst, src FROM edg),
deg AS MATERIALIZED (SELECT win, src AS person, count(*) AS k FROM two GROUP BY ALL),
ver AS MATERIALIZED (SELECT win, person, count(*) AS n_docs FROM mem GROUP BY ALL)"""
_DEGREE = """siz AS (SELECT win, doc, count(*) - 1 AS others FROM mem GROUP BY ALL),
dgr AS (SELECT win, person, sum(others)::BIGINT AS degree FROM mem JOIN siz USING (win, doc) GROUP BY ALL)"""
_CLUSTER = """clu AS (SELECT d.win, d.person, CASE WHEN k >= 2 THEN coalesce(t, 0)::DOUBLE / (k * (k - 1)) END AS clustering
  FROM deg d LEFT JOIN (SELECT x.win, x.src AS person, count(*) AS t FROM two x JOIN two y ON x.win = y.win AND x.dst = y.src
    JOIN two z ON z.win = x.win AND z.src = y.dst AND z.dst = x.src GROUP BY ALL) c ON c.win = d.win AND c.person = d.person)"""
_CONSTRAINT = """ind AS (SELECT x.win, x.src, z.dst, sum(1.0::DOUBLE / d.k) AS s FROM two x JOIN two y ON x.win = y.win AND x.dst = y.src
    JOIN two z ON z.win = x.win AND z.src = x.src AND z.dst = y.dst JOIN deg d ON d.win = x.win AND d.person = x.dst GROUP BY ALL),
con AS (SELECT t.win, t.src AS person, sum(pow((1 + coalesce(s, 0)) / d.k, 2)) AS constr FROM two t JOIN deg d ON d.win = t.win AND d.person = t.src
    LEFT JOIN ind i ON i.win = t.win AND i.src = t.src AND i.dst = t.dst GROUP BY ALL)"""


def _rank_ctes(damping: float = 0.85, rounds: int = ROUNDS) -> str:
    steps = ["pr0 AS MATERIALIZED (SELECT v.win, v.person, k, count(*) OVER (PARTITION BY v.win) AS n, 1.0::DOUBLE / count(*) OVER (PARTITION BY v.win) AS r FROM ver v LEFT JOIN deg d ON d.win = v.win AND d.person = v.person)"]
    for i in range(1, rounds + 1):
        p = f"pr{i - 1}"
        steps.append(f"""pr{i} AS MATERIALIZED (SELECT p.win, p.person, k, n, {1 - damping}::DOUBLE / n + {damping}::DOUBLE * (coalesce(f, 0) + l / n) AS r FROM {p} p
  LEFT JOIN (SELECT t.win, t.dst, sum(q.r / q.k) AS f FROM two t JOIN {p} q ON q.win = t.win AND q.person = t.src GROUP BY ALL) i ON i.win = p.win AND i.dst = p.person
  JOIN (SELECT win, coalesce(sum(r) FILTER (k IS NULL), 0) AS l FROM {p} GROUP BY win) lo ON lo.win = p.win)""")
    return ",\n".join(steps)


def _eigen_ctes(rounds: int = ROUNDS) -> str:
    steps = ["ev0 AS MATERIALIZED (SELECT win, person, 1.0::DOUBLE AS s FROM ver)"]
    for i in range(1, rounds + 1):
        p = f"ev{i - 1}"
        steps.append(f"""ev{i} AS MATERIALIZED (SELECT win, person, raw / max(raw) OVER (PARTITION BY win) AS s FROM (
  SELECT p.win, p.person, p.s + coalesce(f, 0) AS raw FROM {p} p LEFT JOIN (SELECT t.win, t.dst, sum(q.s) AS f FROM two t JOIN {p} q ON q.win = t.win AND q.person = t.src GROUP BY ALL) i
  ON i.win = p.win AND i.dst = p.person))""")
    return ",\n".join(steps)


def _label_ctes(rounds: int) -> str:
    """Least label within ``rounds`` steps, which must cover the longest shortest path of the graph."""
    steps = ["lb0 AS MATERIALIZED (SELECT win, person, person AS c FROM ver)"]
    for i in range(1, rounds + 1):
        steps.append(f"""lb{i} AS MATERIALIZED (SELECT p.win, p.person, least(p.c, min(q.c)) AS c FROM lb{i - 1} p LEFT JOIN two t ON t.win = p.win AND t.src = p.person
  LEFT JOIN lb{i - 1} q ON q.win = t.win AND q.person = t.dst GROUP BY p.win, p.person, p.c)""")
    return ",\n".join(steps)


def _search_ctes(levels: int) -> str:
    """Shortest paths from every node, level by level, then back: ``nd`` (source, person, d) and ``ed`` (v, w, f).

    ``levels`` must cover the longest shortest path of the graph.
    """
    steps = ["bf0 AS MATERIALIZED (SELECT person AS s, person AS v, 0 AS l, 1.0::DOUBLE AS p FROM deg)"]
    for i in range(1, levels + 1):
        steps.append(f"""bf{i} AS MATERIALIZED (SELECT * FROM bf{i - 1} UNION ALL SELECT b.s, t.dst, {i}, sum(b.p) FROM bf{i - 1} b JOIN two t ON t.src = b.v
  WHERE b.l = {i - 1} AND NOT EXISTS (SELECT 1 FROM bf{i - 1} o WHERE o.s = b.s AND o.v = t.dst) GROUP BY ALL)""")
    steps.append(f"dp{levels} AS MATERIALIZED (SELECT s, v, l, p, 0.0::DOUBLE AS d FROM bf{levels} WHERE l = {levels})")
    for i in range(levels, 0, -1):
        steps.append(f"""ef{i} AS MATERIALIZED (SELECT a.s, a.v, w.v AS w, a.p / w.p * (1 + w.d) AS f FROM dp{i} w JOIN two t ON t.src = w.v
  JOIN bf{levels} a ON a.s = w.s AND a.v = t.dst AND a.l = {i - 1})""")
        steps.append(f"""dp{i - 1} AS MATERIALIZED (SELECT a.s, a.v, a.l, a.p, coalesce(sum(f), 0) AS d FROM bf{levels} a LEFT JOIN ef{i} e ON e.s = a.s AND e.v = a.v
  WHERE a.l = {i - 1} GROUP BY ALL)""")
    steps.append("nd AS (" + " UNION ALL ".join(f"SELECT v, d FROM dp{i}" for i in range(1, levels + 1)) + ")")
    steps.append("ed AS (" + " UNION ALL ".join(f"SELECT least(v, w) AS a, greatest(v, w) AS b, f FROM ef{i}" for i in range(1, levels + 1)) + ")")
    return ",\n".join(steps)


_REACH = """rch AS (SELECT src AS person, dst AS other FROM two UNION SELECT r.person, t.dst FROM rch r JOIN two t ON t.src = r.other),
cmp AS MATERIALIZED (SELECT v.person, least(v.person, min(other)) AS component FROM ver v LEFT JOIN rch r ON r.person = v.person GROUP BY v.person)"""
_RANKED = """cs AS MATERIALIZED (SELECT component, count(*) AS size FROM cmp GROUP BY ALL),
rk AS MATERIALIZED (SELECT component, size, dense_rank() OVER (ORDER BY size DESC) - 1 AS rank, row_number() OVER (ORDER BY size DESC, component) - 1 AS place FROM cs)"""

ORACLES = {
    "graph_vertices": f"""WITH {_ALL}, {_EDGES} SELECT v.win, v.person, n_docs, first_supplier, quantity FROM ver v JOIN
        (SELECT l_partkey, arg_min(l_suppkey, (l_shipdate, l_suppkey)) AS first_supplier, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1) ON l_partkey = v.person""",
    "graph_edges": f"WITH {_ALL}, {_EDGES} SELECT src, dst, weight FROM edg",
    "graph_edges_by_year": f"""WITH mem AS (SELECT DISTINCT year(l_shipdate)::INTEGER AS win, l_orderkey AS doc, l_suppkey AS person FROM lineitem), {_EDGES}
        SELECT win, src, dst, weight FROM edg""",
    "graph_edge_rows": """WITH mem AS (SELECT DISTINCT l_orderkey AS doc, l_suppkey AS person FROM lineitem)
        SELECT a.doc, a.person AS src, b.person AS dst, year(o_orderdate)::INTEGER AS year, o_orderpriority FROM mem a JOIN mem b ON a.doc = b.doc AND a.person < b.person
        JOIN orders ON o_orderkey = a.doc""",
    "graph_windows": f"""WITH {_MEMBERS}, {_EDGES} SELECT v.win, n_vertices, n_edges, total_weight FROM (SELECT win, count(*) AS n_vertices FROM ver GROUP BY 1) v
        JOIN (SELECT win, count(*) AS n_edges, sum(weight)::BIGINT AS total_weight FROM edg GROUP BY 1) e ON e.win = v.win""",
    "degree": f"WITH {_MEMBERS}, {_DEGREE} SELECT * FROM dgr",
    "unique_degree": f"WITH {_MEMBERS}, {_EDGES}, {_DEGREE} SELECT g.win, g.person, degree, coalesce(k, 0) AS unique_degree FROM dgr g LEFT JOIN deg d ON d.win = g.win AND d.person = g.person",
    "restricted_edges": f"""WITH mem AS (SELECT DISTINCT 0 AS win, l_orderkey AS doc, l_partkey AS person FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type = 'ECONOMY'),
        {_EDGES} SELECT src, dst, weight FROM edg""",
    "attached_edges": f"""WITH {_ALL}, {_EDGES} SELECT p_brand AS src_brand, count(*) AS n_edges, sum(weight)::BIGINT AS weight FROM edg JOIN part ON p_partkey = src GROUP BY 1""",
    "components": f"WITH RECURSIVE {_SPARSE}, {_EDGES}, {_REACH} SELECT person, component FROM cmp",
    "component_rank": f"WITH RECURSIVE {_SPARSE}, {_EDGES}, {_REACH}, {_RANKED} SELECT component, size, rank, place FROM rk",
    "largest_component": f"""WITH RECURSIVE {_SPARSE}, {_EDGES}, {_REACH}, {_RANKED} SELECT src, dst, weight FROM edg JOIN cmp ON cmp.person = src
        JOIN rk ON rk.component = cmp.component WHERE place = 0""",
    "neighbourhood_2hop": f"""WITH {_SPARSE}, {_EDGES}, h0 AS (SELECT o_orderkey AS person FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'),
        h1 AS (SELECT person FROM h0 UNION SELECT dst FROM two JOIN h0 ON src = person), h2 AS (SELECT person FROM h1 UNION SELECT dst FROM two JOIN h1 ON src = person) SELECT person FROM h2""",
    "edge_select": f"WITH {_ALL}, {_EDGES} SELECT person, n_docs FROM ver WHERE person IN (SELECT src FROM edg WHERE weight >= 2 UNION SELECT dst FROM edg WHERE weight >= 2)",
    "clustering_coefficient": f"WITH {_MEMBERS}, {_EDGES}, {_CLUSTER} SELECT win, person, round(clustering, 9) AS clustering FROM clu",
    "burt_constraint": f"""WITH {_MEMBERS}, {_EDGES}, {_CONSTRAINT} SELECT win, person, round(constr, 9) AS "constraint" FROM con""",
    "pagerank": f"WITH {_MEMBERS}, {_EDGES}, {_rank_ctes()} SELECT win, person, round(r, 9) AS pagerank FROM pr{ROUNDS}",
    "eigenvector": f"WITH {_MEMBERS}, {_EDGES}, {_eigen_ctes()} SELECT win, person, round(s, 9) AS eigenvector FROM ev{ROUNDS}",
    # plain rounds until nothing moves: 0.85 ** 160 is under 1e-11, and a round on the dense graph takes off over half
    "pagerank_converged": f"WITH {_MEMBERS}, {_EDGES}, {_rank_ctes(rounds=160)} SELECT win, person, round(r, 9) AS pagerank FROM pr160",
    "eigenvector_converged": f"""WITH {_ALL}, {_EDGES}, {_label_ctes(24)}, {_eigen_ctes(60)},
        sz AS (SELECT win, c, count(*) AS size FROM lb24 GROUP BY ALL), big AS (SELECT win, c FROM sz QUALIFY row_number() OVER (PARTITION BY win ORDER BY size DESC, c) = 1)
        SELECT e.win, e.person, round(s, 8) AS eigenvector FROM ev60 e JOIN lb24 USING (win, person) JOIN big ON big.win = lb24.win AND big.c = lb24.c""",
    "betweenness": f"""WITH {_SPARSE}, {_EDGES}, {_search_ctes(12)} SELECT person, round(coalesce(b, 0), 6) AS betweenness FROM deg
        LEFT JOIN (SELECT v, sum(d) / 2 AS b FROM nd GROUP BY v) ON v = person""",
    "edge_betweenness": f"""WITH {_SPARSE}, {_EDGES}, {_search_ctes(12)} SELECT src, dst, round(f, 6) AS betweenness FROM edg
        JOIN (SELECT a, b, sum(f) / 2 AS f FROM ed GROUP BY a, b) ON a = src AND b = dst""",
    "central_labels": f"""WITH RECURSIVE {_SPARSE}, {_EDGES}, {_REACH}, {_rank_ctes(0.95)},
        sc AS (SELECT p.person, round(r, 12) AS pagerank, component, count(*) OVER (PARTITION BY component) AS n FROM pr{ROUNDS} p JOIN cmp ON cmp.person = p.person)
        SELECT person, pagerank, component, row_number() OVER (PARTITION BY component ORDER BY pagerank DESC, person)::INTEGER AS label_rank FROM sc WHERE n >= 3 QUALIFY label_rank <= 2""",
    "window_measures": f"""WITH {_MEMBERS}, {_EDGES}, {_DEGREE}, {_CLUSTER}, {_CONSTRAINT}, {_rank_ctes()}, {_eigen_ctes()}, {_label_ctes(24)},
        sz AS (SELECT win, c, count(*) AS size FROM lb24 GROUP BY ALL), rz AS (SELECT *, dense_rank() OVER (PARTITION BY win ORDER BY size DESC) - 1 AS rank FROM sz)
        SELECT v.win, v.person, n_docs, degree, coalesce(k, 0) AS unique_degree, lb24.c AS component, size, rank, round(clustering, 9) AS clustering,
        round(constr, 9) AS "constraint", round(r, 9) AS pagerank, round(s, 9) AS eigenvector
        FROM ver v JOIN dgr USING (win, person) LEFT JOIN deg USING (win, person) JOIN lb24 USING (win, person) JOIN rz ON rz.win = v.win AND rz.c = lb24.c
        LEFT JOIN clu USING (win, person) LEFT JOIN con USING (win, person) JOIN pr{ROUNDS} q USING (win, person) JOIN ev{ROUNDS} e USING (win, person)""",
    "graphml_files": """WITH mem AS (SELECT DISTINCT year(l_shipdate)::INTEGER AS win, l_orderkey AS doc, l_suppkey AS person FROM lineitem),
        edg AS (SELECT DISTINCT a.win, a.person AS src, b.person AS dst FROM mem a JOIN mem b ON a.win = b.win AND a.doc = b.doc AND a.person < b.person),
        e AS (SELECT win, count(*) AS n_edges FROM edg GROUP BY 1)
        SELECT win, 1::BIGINT AS n_files, count(DISTINCT person) AS n_nodes, coalesce(any_value(n_edges), 0) AS n_edges, '<graphml>' AS opening, '</graph></graphml>' AS closing
        FROM mem LEFT JOIN e USING (win) GROUP BY win""",
    "graphml": f"""WITH {_SPARSE}, {_EDGES} SELECT 0 AS section, '' AS ord, '<graphml><key id="n_docs" for="node" attr.name="n_docs"/><key id="weight" for="edge" attr.name="weight"/><graph edgedefault="undirected">' AS line
        UNION ALL SELECT 3, '', '</graph></graphml>'
        UNION ALL SELECT 1, person::VARCHAR, '<node id="' || person || '"><data key="n_docs">' || n_docs || '</data></node>' FROM ver
        UNION ALL SELECT 2, src || '-' || dst, '<edge source="' || src || '" target="' || dst || '"><data key="weight">' || weight || '</data></edge>' FROM edg""",
}
ORACLES["window_measures"] = ORACLES["window_measures"].replace("coalesce(k, 0)", "coalesce(deg.k, 0)")
