"""Column normalisation and similarity over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.bindings import duck
from linkloom.bindings.base import table
from linkloom.functions import dates, ids, names, places, text
from linkloom.operators.normalize import compute_once, normalize_columns, normalize_report
from linkloom.operators.similarity_join import similar_pairs
from linkloom.plans import consolidate
from linkloom.session import spread

# Which country each document source stands for in the city and country queries.
SOURCE_COUNTRIES = ["US", "GB", "DE", "FR", "JP", "KR", "CA", "AU", "AR", "CN", "SU", "TW", "NL", "DK", "BE", "AT", "USA", "CS"]


def clean_names(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    return normalize_columns(docs, {"text": text.clean_name})


def clean_assignee(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations")
    return consolidate.clean_assignees(turns, "text", "assignee_asc").select("conv_id", "turn", "assignee_asc")


def clean_roles(spark: SparkSession, d: str) -> DataFrame:
    """A rule over a column of few values runs once per distinct value."""
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role")
    return normalize_columns(turns, {"role": lambda c: F.upper(text.clean_name(c))}, distinct=True)


def clean_report(spark: SparkSession, d: str) -> DataFrame:
    rules = {"text": text.clean_name, "source": text.clean_name}
    return normalize_report(table(spark, d, "documents").select("text", "source"), rules)


def clean_lawyers(spark: SparkSession, d: str) -> DataFrame:
    lawyers = table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("orgname"))
    return consolidate.clean_lawyers(lawyers, ["orgname"])


def clean_inventors(spark: SparkSession, d: str) -> DataFrame:
    """First names, surnames and streets of documents, each cleaned."""
    words = F.split("text", " ")
    people = table(spark, d, "documents").select(
        "doc_id", F.get(words, F.lit(0)).alias("firstname"), F.col("source").alias("lastname"), F.substring("text", 1, 200).alias("street"))
    return consolidate.clean_inventors(spread(people))


def clean_markup(spark: SparkSession, d: str) -> DataFrame:
    pages = spread(table(spark, d, "pages").select("page_id", "html"))
    return normalize_columns(pages, {"html": text.clean_markup})


def escape_outside_sub(spark: SparkSession, d: str) -> DataFrame:
    pages = spread(table(spark, d, "pages").select("page_id", "html"))
    return normalize_columns(pages, {"html": text.escape_outside_sub})


def valid_text(spark: SparkSession, d: str) -> DataFrame:
    raw = spread(table(spark, d, "documents").select("doc_id", "text"))
    return raw.select("doc_id", text.valid_text(F.encode("text", "UTF-8")).alias("text"))


def fold_ascii(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    return normalize_columns(docs, {"text": text.fold_ascii})


def clean_places(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    return normalize_columns(docs, {"text": text.clean_place})


def _cities(spark: SparkSession, d: str) -> DataFrame:
    """Distinct (city, country): all pieces of all texts between points and line ends."""
    source = F.coalesce(F.regexp_extract("source", "([0-9]+)", 1).try_cast("int"), F.lit(0))
    country = F.element_at(F.array(*[F.lit(c) for c in SOURCE_COUNTRIES]), F.least(source, F.lit(len(SOURCE_COUNTRIES) - 1)) + 1)
    pieces = F.explode(F.split("text", r"[.\n]"))
    return table(spark, d, "documents").select(pieces.alias("city"), country.alias("country")).distinct()


def country_recode(spark: SparkSession, d: str) -> DataFrame:
    cleaned = compute_once(_cities(spark, d), "place", text.clean_place(F.col("city")))
    return cleaned.withColumn("new_country", places.recode_country(F.col("place"), F.col("country"))).drop("place")


def city_rules(spark: SparkSession, d: str) -> DataFrame:
    rows = _cities(spark, d)
    for name, stage in places.normalise_city_stages("city", "country"):
        rows = compute_once(rows, name, stage)
    return rows.select("city", "country", F.col("_clean_city").alias("clean_city"))


def segment_split(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("text")
    return spread(table(spark, d, "documents")).select(
        "doc_id", text.separator_count(c).alias("seps"), text.segment(c, -1).alias("whole"),
        text.segment(c, 0).alias("seg0"), text.segment(c, 1).alias("seg1"), text.segment(c, 2).alias("seg2"),
        text.prefix(text.without_spaces(c), 3).alias("first3"), text.suffix(text.without_spaces(c), 4).alias("last4"),
    )


def date_normalise(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "d-MMM-yy").alias("short"), F.date_format("o_orderdate", "M/d/yyyy").alias("slashed"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("digits"), F.date_format("o_orderdate", "yyyy.MM").alias("other"),
        F.date_format("o_orderdate", "yyyyMM'00'").alias("month"),
    )
    cleaned = consolidate.clean_dates(orders, ["short", "slashed", "digits", "other"])
    return cleaned.withColumn("month", dates.citation_date(F.col("month")))


def doc_number_formats(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    return table(spark, d, "orders").select(
        "o_orderkey",
        ids.simple_number(F.concat(F.lit("D-00"), key)).alias("simple"),
        ids.padded_number(F.concat(F.lit("RE,"), key)).alias("padded"),
        ids.national_number(F.concat(F.lit("PP"), key), F.lit("US")).alias("national"),
        ids.national_number(key, F.lit("DE")).alias("foreign"),
        ids.national_number(F.concat(F.lit("07/"), key), F.lit("US")).alias("application"),
        ids.number_type(F.concat(F.lit("D"), key)).alias("letter_type"),
        ids.number_type(key).alias("plain_type"),
        ids.strip_leading_zero(F.concat(F.lit("US0"), key)).alias("stripped"),
        ids.class_label(F.lpad(key, 9, "0")).alias("label"),
        names.padded_id(F.lit("H"), F.col("o_orderkey")).alias("minted"),
        names.expand_id(F.concat(F.lit("H"), key)).alias("expanded"),
    )


def name_prefix(spark: SparkSession, d: str) -> DataFrame:
    first, last = F.col("p_name"), F.col("p_type")
    return table(spark, d, "part").select(
        "p_partkey", names.split_given(first).alias("first"), names.join_prefix(first, last).alias("last"),
        names.person_label(last, first).alias("person"), text.title_case(first).alias("title"),
    )


def year_list(spark: SparkSession, d: str) -> DataFrame:
    spans = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.concat_ws(
            ",", F.lit("1990"), F.concat_ws("-", F.year(F.min("o_orderdate")).cast("string"), F.year(F.max("o_orderdate")).cast("string"))
        ).alias("spec")
    )
    return spans.select("o_custkey", F.explode(dates.year_list(F.col("spec"))).alias("year"))


def _vocabulary(spark: SparkSession, d: str, name: str) -> DataFrame:
    words = F.explode(F.split(F.upper("text"), "[ .,\n]+"))
    return table(spark, d, name).select(words.alias("word")).where(F.col("word") != "").distinct()


def similar_words(spark: SparkSession, d: str) -> DataFrame:
    """All benchmark words that resemble a turn's word with the same first three letters."""
    left = _vocabulary(spark, d, "conversations").select(F.substring("word", 1, 3).alias("block"), F.col("word").alias("said"))
    right = _vocabulary(spark, d, "benchmark").select(F.substring("word", 1, 3).alias("block"), F.col("word").alias("known"))
    return similar_pairs(left, right, ["block"], "said", "known", 0.92).withColumn("similarity", F.round("similarity", 6))


QUERIES = {
    f.__name__: f
    for f in (
        clean_names, clean_assignee, clean_roles, clean_report, clean_lawyers, clean_inventors, clean_markup, escape_outside_sub,
        valid_text, fold_ascii, clean_places, country_recode, city_rules, segment_split, date_normalise, doc_number_formats,
        name_prefix, year_list, similar_words,
    )
}


def _name_sql(expr: str) -> str:
    return duck.strip(duck.swap_all(expr, [text.ACCENT_IDIOM, text.BRACKETED, text.NAME_PUNCTUATION]))


def _place_sql(source: str, column: str, out: str = "place") -> str:
    """CTEs over ``source`` adding the cleaned place of ``column``."""
    steps = duck.swap_all(f"upper(replace({column}, 'ß', '·'))", text.PLACE_RULES)
    return f"""
_p1 AS (SELECT *, {steps} AS _x FROM {source}),
_p2 AS (SELECT *, {duck.strip("regexp_replace(_x, '[,|-]', ' ', 'g')")} AS _b FROM _p1),
_p3 AS (SELECT * EXCLUDE (_x, _b), {duck.fold("CASE WHEN length(_x) > length(_b) THEN left(_x, length(_x) - 1) ELSE _x END")} AS {out} FROM _p2)"""


_CITY_SOURCE = """
src AS (SELECT DISTINCT unnest(regexp_split_to_array(text, '[.\\n]')) AS city,
  ([{codes}])[least(coalesce(try_cast(regexp_extract(source, '([0-9]+)', 1) AS INTEGER), 0), {last}) + 1] AS country FROM documents)""".format(
    codes=", ".join(f"'{c}'" for c in SOURCE_COUNTRIES), last=len(SOURCE_COUNTRIES) - 1
)


def _has(expr: str, pattern: str) -> str:
    return f"regexp_matches({expr}, {duck.quote(pattern)})"


def _country_sql() -> str:
    cases = " ".join(
        f"WHEN country = '{old}' AND {_has('place', pattern) if pattern else 'true'} THEN '{new}'"
        for old, pattern, new in places.COUNTRY_RECODES
    )
    return f"WITH {_CITY_SOURCE}, {_place_sql('src', 'city')} SELECT city, country, CASE {cases} ELSE country END AS new_country FROM _p3"


def _city_sql() -> str:
    listed = ", ".join(f"'{c}'" for c in places.CITY_WORD_COUNTRIES)
    spelled = f"CASE WHEN country IN ({listed}) THEN {duck.swap('place', *places.CITY_WORD)} ELSE place END"
    abroad = f"CASE WHEN country <> 'US' THEN {duck.swap('c0', *places.SAINT_ABROAD)} ELSE c0 END"
    rules, used = [], [c for c in SOURCE_COUNTRIES if c in places.CITY_RULES]
    for code in used:
        out = duck.swap_all("c1", places.CITY_RULES[code])
        if code == "DE":
            out = f"CASE WHEN {_has(out, places.UMLAUT_KEEPERS)} THEN {out} ELSE {duck.swap(out, *places.WRITTEN_UMLAUT)} END"
        rules.append(f"WHEN country = '{code}' THEN {out}")
    marks = []
    for code in [c for c in SOURCE_COUNTRIES if c in places.PROVINCES]:
        steps = []
        for is_pattern, pattern, name in places.provinces(code):
            wrapped = rf"([, ]|\b)({pattern})([, ]|\b)"
            test = _has("c2", wrapped) if is_pattern else f"contains(c2, '{pattern}')"
            steps.append(f"WHEN {test} THEN {duck.swap('c2', wrapped, f',{name},')}")
        marks.append(f"WHEN country = '{code}' THEN CASE {' '.join(steps)} ELSE c2 END")
    edged = "regexp_replace(regexp_replace(c3, '^,', ''), ',$', '')"
    return f"""WITH {_CITY_SOURCE}, {_place_sql('src', 'city')},
c0 AS (SELECT *, {spelled} AS c0 FROM _p3), c1 AS (SELECT *, {abroad} AS c1 FROM c0),
c2 AS (SELECT *, CASE {' '.join(rules)} ELSE c1 END AS c2 FROM c1),
c3 AS (SELECT *, CASE {' '.join(marks)} ELSE c2 END AS c3 FROM c2)
SELECT city, country, {duck.strip(f"regexp_replace({edged}, '[-]|  +', ' ', 'g')")} AS clean_city FROM c3"""


_MARKUP = f"lower(regexp_replace(nfc_normalize(html), '[\\r\\n\\t\\x0B\\x08\\f\\x07 ]+', ' ', 'g'))"
for _idiom in text.UNDERSCORE_IDIOMS:
    _MARKUP = f"replace({_MARKUP}, '{_idiom}', '_')"
_MARKUP = f"replace(replace(replace({_MARKUP}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_MARKUP = f"array_to_string(list_transform(string_split({_MARKUP}, 'ß'), lambda part: upper(part)), 'ß')"
_SPLIT = "regexp_split_to_array(text, ' *?[,|] *')"

# RE2 has no look-around: protect what stays, escape the rest, restore.
_KEEP = [("&amp;", "\x02a"), ("&lt;", "\x02l"), ("&gt;", "\x02g")]
_ESC = "html"
for _entity, _mark in _KEEP:
    _ESC = f"replace({_ESC}, '{_entity}', '{_mark}')"
_ESC = f"replace({_ESC}, '&', '&amp;')"
_ESC = f"regexp_replace({_ESC}, '<(/?)(sub)>', '\x03\\1\\2\x04', 'gi')"
_ESC = f"replace(replace({_ESC}, '<', '&lt;'), '>', '&gt;')"
_ESC = f"replace(replace({_ESC}, '\x03', '<'), '\x04', '>')"
for _entity, _mark in _KEEP:
    _ESC = f"replace({_ESC}, '{_mark}', '{_entity}')"

_WORDS = "SELECT DISTINCT w FROM (SELECT unnest(regexp_split_to_array(upper(replace(text, 'ß', 'SS')), '[ .,\\n]+')) AS w FROM {0}) WHERE w <> ''"

ORACLES = {
    "clean_names": f"SELECT doc_id, {_name_sql('text')} AS text FROM documents",
    "clean_assignee": f"""SELECT conv_id, turn, replace(upper(replace({duck.strip(duck.swap_all('text', [text.ACCENT_IDIOM, text.BRACKETED, text.ASSIGNEE_PUNCTUATION]))}, 'ß', '·')), '·', 'SS') AS assignee_asc FROM conversations""",
    "clean_roles": "SELECT conv_id, turn, upper(role) AS role FROM conversations",
    "clean_report": f"""SELECT 'text' AS "column", count(*) AS n_rows, count(*) FILTER (text <> {_name_sql('text')}) AS n_changed,
        count(*) FILTER (text <> '' AND {_name_sql('text')} = '') AS n_emptied FROM documents
        UNION ALL SELECT 'source', count(*), count(*) FILTER (source <> {_name_sql('source')}),
        count(*) FILTER (source <> '' AND {_name_sql('source')} = '') FROM documents""",
    "clean_lawyers": "SELECT s_suppkey, replace(s_name, '#', '') AS orgname FROM supplier",
    "clean_inventors": f"""SELECT doc_id, {_name_sql("string_split(text, ' ')[1]")} AS firstname, {_name_sql('source')} AS lastname, {_name_sql('substr(text, 1, 200)')} AS street FROM documents""",
    "clean_markup": f"SELECT page_id, {_MARKUP} AS html FROM pages",
    "escape_outside_sub": f"SELECT page_id, {_ESC} AS html FROM pages",
    "valid_text": "SELECT doc_id, text FROM documents",
    "fold_ascii": f"SELECT doc_id, {duck.fold('text')} AS text FROM documents",
    "clean_places": f"WITH {_place_sql('documents', 'text')} SELECT doc_id, place AS text FROM _p3",
    "country_recode": _country_sql(),
    "city_rules": _city_sql(),
    "segment_split": f"""SELECT doc_id, len(regexp_extract_all(text, '[,|]'))::INTEGER AS seps, text AS whole,
        {_SPLIT}[1] AS seg0, coalesce({_SPLIT}[2], '') AS seg1, coalesce({_SPLIT}[3], '') AS seg2,
        left(replace(text, ' ', ''), 3) AS first3, right(replace(text, ' ', ''), 4) AS last4 FROM documents""",
    "date_normalise": """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS short, strftime(o_orderdate, '%Y-%m-%d') AS slashed,
        strftime(o_orderdate, '%Y-%m-%d') AS digits, strftime(o_orderdate, '%Y.%m') AS other,
        date_trunc('month', o_orderdate)::DATE AS month FROM orders""",
    "doc_number_formats": """SELECT o_orderkey, 'D' || o_orderkey AS simple, 'RE' || lpad(o_orderkey::VARCHAR, greatest(6, length(o_orderkey::VARCHAR))::INTEGER, '0') AS padded,
        CASE WHEN length('PP' || o_orderkey) = 8 THEN 'PP' || o_orderkey ELSE 'PP' || lpad(o_orderkey::VARCHAR, greatest(6, length(o_orderkey::VARCHAR))::INTEGER, '0') END AS national,
        o_orderkey::VARCHAR AS "foreign", '07/' || o_orderkey AS application, 'D' AS letter_type, 'U' AS plain_type, 'US' || o_orderkey AS stripped,
        substr(lpad(o_orderkey::VARCHAR, 9, '0'), 1, 3) || '/' || substr(lpad(o_orderkey::VARCHAR, 9, '0'), 4, 3) || '.' || substr(lpad(o_orderkey::VARCHAR, 9, '0'), 7) AS label,
        'H' || lpad(o_orderkey::VARCHAR, 12, '0') AS minted, 'H' || lpad(o_orderkey::VARCHAR, 12, '0') AS expanded FROM orders""",
    "name_prefix": """SELECT p_partkey, string_split(p_name, ' ')[1] AS first, array_to_string(list_append(string_split(p_name, ' ')[2:], p_type), ' ') AS last,
        p_type || ', ' || p_name AS person,
        array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title FROM part""",
    "year_list": """WITH s AS (SELECT o_custkey, min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders GROUP BY 1)
        SELECT o_custkey, 1990::INTEGER AS year FROM s UNION ALL SELECT o_custkey, unnest(range(lo, hi + 1))::INTEGER FROM s""",
    "similar_words": f"""WITH a AS ({_WORDS.format('conversations')}), b AS ({_WORDS.format('benchmark')}),
        src AS (SELECT a.w AS a, b.w AS b FROM a JOIN b ON left(a.w, 3) = left(b.w, 3)), {duck.jarow_ctes('jw', 'src')}
        SELECT left(a, 3) AS block, a AS said, b AS known, round(j, 6) AS similarity FROM jw WHERE j > 0.92""",
}
