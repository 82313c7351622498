"""Ingest queries over documents and files that Spark derives from the test tables.

Every order becomes a grant document (customer as assignee and inventor); low-priority
orders become documents of another kind or broken ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.bindings.base import table
from linkloom.session import cut_lineage, scratch_path, spread
from linkloom.sources import claims, delimited, documents, shred, sinks

_GRANT = """concat('<?xml version="1.0" encoding="UTF-8"?>\\n<!DOCTYPE ', kind, ' SYSTEM "grant.dtd" [ ]>\\n<', kind, ' lang="EN"><us-bibliographic-data-grant>',
 '<publication-reference><document-id><country>US</country><doc-number>D0', o_orderkey, '</doc-number><kind>S1</kind><date>', day, '</date></document-id></publication-reference>',
 '<application-reference appl-type="design"><document-id><country>US</country><doc-number>29', o_orderkey, '</doc-number><date>', day, '</date></document-id></application-reference>',
 '<us-application-series-code>29</us-application-series-code><number-of-claims>', int(o_totalprice / 10000), '</number-of-claims>',
 '<invention-title id="t">Order <b>of</b> &mdash;H<sub>2</sub>O &amp; ', o_orderpriority, '</invention-title>',
 '<classification-national><main-classification>D 3', c_nationkey, '</main-classification><further-classification>', c_mktsegment, '</further-classification></classification-national>',
 '<classifications-ipcr><classification-ipcr><ipc-version-indicator><date>20060101</date></ipc-version-indicator><classification-level>A</classification-level><section>', o_orderstatus, '</section></classification-ipcr></classifications-ipcr>',
 '<assignees><assignee><addressbook><orgname>', c_name, ' Inc.</orgname><role>02</role><address><city>City ', c_nationkey, '</city><state>CA</state><country>US</country></address></addressbook></assignee>',
 IF(o_orderstatus = 'P', '<assignee><addressbook><first-name>Ann Van</first-name><last-name>Dyk</last-name></addressbook><residence><country>NL</country></residence></assignee>', ''), '</assignees>',
 IF(o_orderstatus = 'O', '<us-references-cited>', '<references-cited>'),
 replace(concat('<CIT><patcit><document-id><country>US</country><doc-number>', o_custkey, '</doc-number><kind>A</kind><name>Smith</name><date>', month, '00</date></document-id></patcit><category>cited by examiner</category></CIT>',
 '<CIT><othercit>See H<sub>2</sub>O & ', c_mktsegment, '</othercit><category>cited by other</category></CIT>'), 'CIT>', IF(o_orderstatus = 'O', 'us-citation>', 'citation>')),
 IF(o_orderstatus = 'O', '</us-references-cited>', '</references-cited>'),
 IF(o_orderstatus = 'O', '<inventors><inventor>', '<parties><applicants><applicant>'),
 '<addressbook><first-name>Troy Van Der</first-name><last-name>', c_mktsegment, '</last-name><address><street>Main</street><city>City ', c_nationkey, '</city><country>DE</country><postcode>', o_custkey, '</postcode></address></addressbook><nationality><country>DE</country></nationality>',
 IF(o_orderstatus = 'O', '</inventor></inventors><agents>', '</applicant></applicants><agents>'),
 '<agent><addressbook><orgname>Law ', o_orderpriority, '</orgname><address><country>unknown</country></address></addressbook></agent></agents>',
 IF(o_orderstatus = 'O', '', '</parties>'),
 '<us-related-documents>', IF(o_orderkey % 2 = 1, concat('<us-provisional-application><document-id><country>US</country><doc-number>60', o_orderkey, '</doc-number></document-id></us-provisional-application>'), ''), '<continuation><relation><parent-doc><document-id><country>US</country><doc-number>0', o_custkey, '</doc-number><date>', day, '</date></document-id><parent-status>GRANTED</parent-status></parent-doc>',
 '<child-doc><document-id><country>US</country><doc-number>1', o_custkey, '</doc-number></document-id></child-doc></relation></continuation>',
 IF(o_orderkey % 2 = 1, '', concat('<us-provisional-application><document-id><country>US</country><doc-number>60', o_orderkey, '</doc-number></document-id></us-provisional-application>')), '</us-related-documents>',
 IF(o_orderpriority = '4-NOT SPECIFIED', '', '</us-bibliographic-data-grant>'), '<abstract><p>Text ', o_orderstatus, '</p></abstract></', kind, '>')"""
SHRED_TABLES = tuple(shred.TABLES)


def _documents(spark: SparkSession, d: str) -> DataFrame:
    rows = (
        spread(table(spark, d, "orders")).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("kind", F.when(F.col("o_orderpriority") == "5-LOW", "sequence-cwu").otherwise("us-patent-grant"))
        .withColumn("day", F.date_format("o_orderdate", "yyyyMMdd")).withColumn("month", F.date_format("o_orderdate", "yyyyMM"))
    )
    # unescaped ampersands are not well-formed, so the citation text is escaped here
    text = F.replace(F.expr(_GRANT), F.lit("O & "), F.lit("O &amp; "))
    return rows.select("o_orderdate", text.alias("value"))


def _grants(spark: SparkSession, d: str, name: str) -> DataFrame:
    """The grants with what one table reads of them, not written, as one pass needs them."""
    split = documents.split_documents(_documents(spark, d).select("value")).select("root", "body")
    return shred.parse_grants(split, parts=shred.PARTS[name])


def _shredder(name: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        return shred.TABLES[name](_grants(spark, d, name))

    query.__name__ = f"shred_{name}"
    return query


def bad_documents(spark: SparkSession, d: str) -> DataFrame:
    split = documents.split_documents(_documents(spark, d).select("value")).select("root", "body")
    return shred.bad_documents(split).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


document_rows = _documents


#: A compressed file is read by one task, so its documents are bounded.
DOCUMENTS_PER_FILE = 50_000


def store_documents(rows: DataFrame, path: str) -> None:
    """Concatenated document files, compressed, one folder per month named as the archive names its files."""
    folder = F.concat(F.lit("ipg"), F.date_format("o_orderdate", "yyMM"), F.lit("01"))
    rows.select("value", folder.alias("issue")).hint("rebalance", F.col("issue")).write.partitionBy("issue").option(
        "maxRecordsPerFile", DOCUMENTS_PER_FILE).text(path, compression="gzip")


def write_documents(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "documents")
    store_documents(_documents(spark, d), path)
    return path


def multi_doc_split(spark: SparkSession, d: str) -> DataFrame:
    found = documents.read_documents(spark, write_documents(spark, d), r"\.txt$")
    return found.select("file_date", "layout", "root", F.regexp_extract("body", "<doc-number>(.*?)<", 1).alias("number"))


def file_listing(spark: SparkSession, d: str) -> DataFrame:
    return documents.list_files(spark, write_documents(spark, d), r"\.TXT$").select("file_name", "length")


def claims_extract(spark: SparkSession, d: str) -> DataFrame:
    """Every line of every document as a claim of an older-format block file."""
    text = F.replace(F.col("text"), F.lit("&"), F.lit("and"))
    body = F.array_join(F.transform(F.split(text, "\n"), lambda x: F.concat(F.lit("<CLM ID=\"C\">\n<PARA><PTEXT><PDAT>"), x, F.lit("&mdash;</PDAT></PTEXT></PARA></CLM>\n"))), "")
    blocks = table(spark, d, "documents").select(
        F.concat(F.lit("<?xml version=\"1.0\"?>\n<PATDOC DTD=\"2.5\">\n<B110><DNUM><PDAT>D"), F.col("doc_id"), F.lit("</PDAT></DNUM></B110>\n<CL>"), body, F.lit("</CL>\n</PATDOC>"))
    )
    path = scratch_path(spark, "claims")
    blocks.write.text(path)
    return claims.read_claims(spark, path)


def csv_infer(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    sinks.write_csv(table(spark, d, "part"), path)
    return delimited.typed(delimited.read_delimited(spark, path))


def spec_csv(spark: SparkSession, d: str) -> DataFrame:
    """Customers as files that begin with four rows of names, types, formats and roles, read back."""
    rows = table(spark, d, "customer")
    fields = [F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string"), F.concat_ws("\n", "c_name", F.concat_ws(", ", F.lit('"at"'), "c_mktsegment"))]
    data = rows.select(F.pmod("c_custkey", F.lit(8)).cast("int").alias("_p"), F.lit(4).alias("_at"), *[f.alias(f"f{i}") for i, f in enumerate(fields)])
    heads = [("Customer Key", "Nation", "Name"), ("VARCHAR", "INTEGER", "VARCHAR"), ("%09d", "", ""), ("UNIQUE", "EXACT", "FUZZY")]
    head = spark.createDataFrame([(p, i, *row) for p in range(8) for i, row in enumerate(heads)], data.schema)
    path = scratch_path(spark, "spec")
    placed = data.unionByName(head).repartition("_p").sortWithinPartitions("_p", "_at")
    placed.drop("_at").write.partitionBy("_p").csv(path, quote='"', escape='"')
    return delimited.read_spec_file(spark, f"{path}/*")[0]


def gazetteer_national(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as a pipe-separated place file, written and read back; a place without a number has no latitude."""
    path = scratch_path(spark, "national")
    table(spark, d, "supplier").select(
        F.col("s_name").alias("FEATURE_NAME"), F.col("s_nationkey").cast("string").alias("STATE_ALPHA"),
        F.when(F.col("s_nationkey") != 3, F.col("s_acctbal").cast("string")).otherwise("unknown").alias("PRIM_LAT_DEC"), (-F.col("s_suppkey")).cast("string").alias("PRIM_LONG_DEC"),
    ).write.csv(path, sep="|", header=True)
    return delimited.read_national_gazetteer(spark, path)


def gazetteer_foreign(spark: SparkSession, d: str) -> DataFrame:
    """Customers as a tab-separated names file, written and read back."""
    path = scratch_path(spark, "foreign")
    table(spark, d, "customer").select(
        F.col("c_nationkey").cast("string").alias("CC1"), F.col("c_custkey").cast("string").alias("LAT"), F.col("c_acctbal").cast("string").alias("LONG"),
        F.lower("c_name").alias("FULL_NAME_RO"), F.col("c_name").alias("FULL_NAME_ND_RO"), F.lit(None).cast("string").alias("SHORT_FORM"), F.col("c_mktsegment").alias("SORT_NAME_RO"),
    ).write.csv(path, sep="\t", header=True)
    return delimited.read_foreign_gazetteer(spark, path)


def cluster_file_load(spark: SparkSession, d: str) -> DataFrame:
    """Lines ``id###n###id,...`` per supplier, written, read and joined back."""
    lines = table(spark, d, "lineitem")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    facts = cut_lineage(lines.select(key.alias("fact"), F.col("l_suppkey").cast("string").alias("supplier")).groupBy("fact").agg(F.min("supplier").alias("supplier")))
    path = scratch_path(spark, "clusters")
    delimited.write_clusters(facts, "supplier", "fact", path)
    return delimited.load_clusters(facts.select("fact"), "fact", delimited.read_clusters(spark, path))


def graph_export(spark: SparkSession, d: str) -> DataFrame:
    """The yearly supplier graph written by window and read back."""
    from linkloom.plans import graph

    members = cut_lineage(graph.members_of(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey", F.year("l_shipdate")))
    path = scratch_path(spark, "graph")
    sinks.write_graph(graph.vertices_of(members), graph.edges_of(members), path)
    return graph.summary(spark.read.parquet(f"{path}/vertices"), spark.read.parquet(f"{path}/edges"))


QUERIES = {f"shred_{n}": _shredder(n) for n in SHRED_TABLES} | {
    f.__name__: f for f in (bad_documents, multi_doc_split, file_listing, claims_extract, csv_infer, spec_csv, gazetteer_national, gazetteer_foreign, cluster_file_load, graph_export)
}

_DOC = """doc AS (SELECT 'D' || o_orderkey AS patent, strftime(o_orderdate, '%Y%m%d') AS day, o.*, c.* FROM orders o JOIN customer c ON o_custkey = c_custkey
   WHERE o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW'))"""


def _shred_sql(body: str) -> str:
    return f"WITH {_DOC} {body}"


_STRIP = "regexp_replace('{0}' || o_custkey, '^([A-Z]*)0', '\\1')"
ORACLES = {
    "shred_patent": _shred_sql("""SELECT patent, 'S1' AS kind, floor(o_totalprice / 10000)::BIGINT::VARCHAR AS claims, '29' AS apptype, '29' || o_orderkey AS appnum,
        day AS gdate, left(day, 4) AS gyear, day AS appdate, left(day, 4) AS appyear, 'DESIGN' AS pattype FROM doc"""),
    "shred_patdesc": _shred_sql("SELECT patent, 'TEXT ' || o_orderstatus AS abstract, 'ORDER OF H&LT;SUB&GT;2&LT;/SUB&GT;O &AMP; ' || o_orderpriority AS title FROM doc"),
    "shred_assignee": _shred_sql("""SELECT patent, '02' AS asgtype, upper(c_name) || ' INC.' AS assignee, 'CITY ' || c_nationkey AS city, 'CA' AS state, 'US' AS country, '' AS nationality, '' AS residence, 0 AS asgseq FROM doc
        UNION ALL SELECT patent, '00', 'VAN DYK, ANN', '', '', '', '', 'NL', 1 FROM doc WHERE o_orderstatus = 'P'"""),
    "shred_citation": _shred_sql("""SELECT patent, strftime(o_orderdate, '%Y%m') || '00' AS cit_date, 'SMITH' AS cit_name, 'A' AS cit_kind, 'US' AS cit_country, o_custkey::VARCHAR AS citation,
        'CITED BY EXAMINER' AS category, 0 AS citseq, date_trunc('month', o_orderdate)::DATE AS cit_day FROM doc"""),
    "shred_sciref": _shred_sql("SELECT patent, 'SEE H<SUB>2</SUB>O &AMP; ' || c_mktsegment AS descrip, 0 AS citseq FROM doc"),
    "shred_class": _shred_sql("""SELECT patent, 1 AS prim, 'D3' AS class, c_nationkey::VARCHAR AS subclass,
        'D 3/' || c_nationkey AS label, 0 AS clsseq FROM doc
        UNION ALL SELECT patent, 0, left(c_mktsegment, 3), substr(c_mktsegment, 4), left(c_mktsegment, 3) || '/' || substr(c_mktsegment, 4, 3) || CASE WHEN length(c_mktsegment) > 6 THEN '.' || substr(c_mktsegment, 7) ELSE '' END, 1 FROM doc"""),
    "shred_inventor": _shred_sql("""SELECT patent, 'TROY' AS firstname, 'VAN DER ' || c_mktsegment AS lastname, 'MAIN' AS street, 'CITY ' || c_nationkey AS city, '' AS state, 'DE' AS country,
        o_custkey::VARCHAR AS zipcode, 'DE' AS nationality, 0 AS invseq FROM doc"""),
    "shred_lawyer": _shred_sql("SELECT patent, '' AS firstname, '' AS lastname, 'UNKNOWN' AS lawcountry, 'LAW ' || o_orderpriority AS orgname, 0 AS lawseq FROM doc"),
    "shred_usreldoc": _shred_sql("""SELECT patent, 'CONTINUATION' AS doctype, 1 AS orderseq, 'US' AS country, o_custkey::VARCHAR AS relpatent, '' AS kind, day AS reldate, 'GRANTED' AS status, 'parent-doc' AS relationship, (o_orderkey % 2)::INTEGER AS seq FROM doc
        UNION ALL SELECT patent, 'CONTINUATION', -1, 'US', '1' || o_custkey, '', '', '', 'child-doc', (1 + o_orderkey % 2)::INTEGER FROM doc
        UNION ALL SELECT patent, 'US-PROVISIONAL-APPLICATION', 0, 'US', '60' || o_orderkey, '', '', '', '', (2 - 2 * (o_orderkey % 2))::INTEGER FROM doc"""),
    "shred_ipcr": _shred_sql("""SELECT patent, 'A' AS classification_level, o_orderstatus AS section, '' AS class, '' AS subclass, '' AS main_group, '' AS subgroup, '' AS symbol_position,
        '' AS classification_value, '' AS classification_status, '' AS classification_data_source, '20060101' AS ipc_version_indicator, '' AS action_date, 0 AS seq FROM doc"""),
    "bad_documents": """SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'other kind' ELSE 'not well-formed' END AS reason, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') GROUP BY 1""",
    "multi_doc_split": """SELECT strftime(o_orderdate, '%Y%m01')::INTEGER AS file_date, 'v42' AS layout, CASE WHEN o_orderpriority = '5-LOW' THEN 'sequence-cwu' ELSE 'us-patent-grant' END AS root,
        'D0' || o_orderkey AS number FROM orders JOIN customer ON o_custkey = c_custkey""",
    "claims_extract": """WITH l AS (SELECT doc_id, string_split(replace(text, '&', 'and'), chr(10)) AS p FROM documents)
        SELECT 'D' || doc_id AS patent, (unnest(range(1, len(p) + 1)) - 1)::INTEGER AS claim_no, unnest(p) AS claim FROM l""",
    "csv_infer": "SELECT p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size, p_retailprice FROM part",
    "spec_csv": """SELECT lpad(c_custkey::VARCHAR, 9, '0') AS "CustomerKey", c_nationkey::BIGINT AS "Nation", c_name || chr(10) || '"at", ' || c_mktsegment AS "Name" FROM customer""",
    "gazetteer_national": """SELECT s_name AS city, s_nationkey::VARCHAR AS state, CASE WHEN s_nationkey <> 3 THEN s_acctbal::DOUBLE END AS lat, (-s_suppkey)::DOUBLE AS long FROM supplier""",
    "gazetteer_foreign": """SELECT c_nationkey::VARCHAR AS cc1, c_custkey::DOUBLE AS lat, c_acctbal::DOUBLE AS long, upper(c_name) AS full_name_ro, upper(c_name) AS full_name_nd_ro,
        '' AS short_form, upper(c_mktsegment) AS sort_name_ro FROM customer""",
    "cluster_file_load": """WITH f AS (SELECT l_orderkey || '-' || l_linenumber AS fact, min(l_suppkey::VARCHAR) AS cluster_id FROM lineitem GROUP BY 1)
        SELECT fact, cluster_id, n FROM f JOIN (SELECT cluster_id, count(*) AS n FROM f GROUP BY 1) USING (cluster_id)""",
    "graph_export": """WITH mem AS (SELECT DISTINCT year(l_shipdate)::INTEGER AS win, l_orderkey AS doc, l_suppkey AS person FROM lineitem),
        edg AS (SELECT a.win, a.person AS src, b.person AS dst, count(*) AS weight FROM mem a JOIN mem b ON a.win = b.win AND a.doc = b.doc AND a.person < b.person GROUP BY ALL)
        SELECT v.win, n_vertices, coalesce(n_edges, 0) AS n_edges, coalesce(w, 0)::BIGINT AS total_weight FROM (SELECT win, count(DISTINCT person) AS n_vertices FROM mem GROUP BY 1) v
        LEFT JOIN (SELECT win, count(*) AS n_edges, sum(weight) AS w FROM edg GROUP BY 1) e ON e.win = v.win""",
}
