"""Grant documents parsed once and shredded into relational child tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.dates import citation_date
from linkloom.functions.ids import class_label, strip_leading_zero
from linkloom.functions.names import join_prefix, person_label, split_given
from linkloom.functions.text import clean_markup, escape_outside_sub
from linkloom.operators.normalize import compute_once

GRANT_ROOT = "us-patent-grant"

_DOC_ID = "`document-id` struct<country string, `doc-number` string, kind string, name string, date string>"
_ADDRESS = "address struct<street string, city string, state string, country string, postcode string>"
_BOOK = (
    "addressbook struct<orgname string, role string, `first-name` string, `last-name` string, " + _ADDRESS + ">"
)
_PERSON = f"struct<{_BOOK}, nationality struct<country string>, residence struct<country string>>"
_CITATION = f"struct<patcit struct<{_DOC_ID}>, othercit string, category string>"
_RELATED_DOC = f"struct<{_DOC_ID}, `parent-status` string>"
_PARENT = (
    f"struct<{_DOC_ID}, `parent-status` string, `parent-grant-document` {_RELATED_DOC}, "
    f"`parent-pct-document` {_RELATED_DOC}>"
)
_RELATION = f"array<struct<relation array<struct<`parent-doc` {_PARENT}, `child-doc` struct<{_DOC_ID}>>>>>"
RELATION_KINDS = (
    "addition", "continuation-in-part", "continuation", "continuing-reissue", "division",
    "reexamination", "reissue", "substitution", "utility-model-basis",
)
PLAIN_RELATIONS = ("related-publication", "us-provisional-application")
_RELATED = ", ".join(
    [f"`{k}` {_RELATION}" for k in RELATION_KINDS]
    + [f"`{k}` array<struct<{_DOC_ID}>>" for k in PLAIN_RELATIONS]
)
IPC_FIELDS = (
    "classification-level", "section", "class", "subclass", "main-group", "subgroup", "symbol-position",
    "classification-value", "classification-status", "classification-data-source",
)
_IPC = (
    "array<struct<" + ", ".join(f"`{f}` string" for f in IPC_FIELDS)
    + ", `ipc-version-indicator` struct<date string>, `action-date` struct<date string>>>"
)
_AGENTS = f"agents struct<agent array<struct<{_BOOK}>>>"
_PARTIES = (
    f"struct<applicants struct<applicant array<{_PERSON}>>, inventors struct<inventor array<{_PERSON}>>, {_AGENTS}>"
)
#: The parts of a grant's data that the tables read, each with its type.
GRANT_PARTS = {
    "publication-reference": f"struct<{_DOC_ID}>",
    "application-reference": f"struct<`_appl-type` string, {_DOC_ID}>",
    "us-application-series-code": "string",
    "number-of-claims": "string",
    "invention-title": "string",
    "classification-national": "struct<`main-classification` string, `further-classification` array<string>>",
    "classifications-ipcr": f"struct<`classification-ipcr` {_IPC}>",
    "assignees": f"struct<assignee array<{_PERSON}>>",
    "references-cited": f"struct<citation array<{_CITATION}>>",
    "us-references-cited": f"struct<`us-citation` array<{_CITATION}>>",
    "parties": _PARTIES,
    "us-parties": _PARTIES,
    "inventors": f"struct<inventor array<{_PERSON}>>",
    "agents": _AGENTS.removeprefix("agents "),
    "us-related-documents": f"struct<{_RELATED}>",
}
#: What every grant needs: its number.
NUMBER_PART = "publication-reference"


def grant_schema(parts: Iterable[str] = tuple(GRANT_PARTS)) -> str:
    """The schema of a grant with the given parts and its number; the reader passes over all other elements."""
    chosen = {NUMBER_PART, *parts}
    fields = ", ".join(f"`{name}` {kind}" for name, kind in GRANT_PARTS.items() if name in chosen)
    return f"`us-bibliographic-data-grant` struct<{fields}>, abstract struct<p array<string>>, _corrupt_record string"


GRANT_SCHEMA = grant_schema()


def prepare_markup(body: Column) -> Column:
    """Inline tags flattened into text, subscripts kept as escaped text, unknown entities dropped."""
    text = F.regexp_replace(body, r"(?i)</?(b|i|u|o|sup|smallcaps)( [^>]*)?>", "")
    text = F.regexp_replace(text, r"(?i)<(/?sub)( [^>]*)?>", "&lt;$1&gt;")
    return F.regexp_replace(text, r"&(?!(amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)[A-Za-z0-9.-]+;", "")


def relation_order(body: Column) -> Column:
    """Names of the related-document elements in the order of the text, which a schema-bound parse does not keep."""
    opening, closing = "<us-related-documents", "</us-related-documents>"
    section = F.substring_index(F.substring_index(F.regexp_replace(body, r"(?s)<!--.*?-->", ""), closing, 1), opening, -1)
    names = F.regexp_extract_all(section, F.lit(rf"<({'|'.join(RELATION_KINDS + PLAIN_RELATIONS)})(?=[\s/>])"), F.lit(1))
    return F.when(body.contains(closing), names).otherwise(F.array().cast("array<string>"))


def parse_grants(documents: DataFrame, body: str = "body", root: str = "root", parts: Iterable[str] = tuple(GRANT_PARTS)) -> DataFrame:
    """(patent, g, abstract, relation_order, plus the input's other columns) for every readable grant.

    ``g`` holds the ``parts`` and the number; whether a grant is readable does not depend on them.
    """
    parsed = compute_once(
        documents.where(F.lower(root) == GRANT_ROOT),
        "_x",
        F.from_xml(
            prepare_markup(F.col(body)), grant_schema(parts),
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
        ),
    )
    number = F.col("_x.us-bibliographic-data-grant.publication-reference.document-id.doc-number")
    keep = [c for c in documents.columns if c not in (body, root)]
    return parsed.where(F.col("_x._corrupt_record").isNull() & number.isNotNull()).select(
        *keep,
        strip_leading_zero(clean_markup(number)).alias("patent"),
        F.col("_x.us-bibliographic-data-grant").alias("g"),
        F.col("_x.abstract.p").alias("abstract"),
        relation_order(F.col(body)).alias("relation_order"),
    )


def bad_documents(documents: DataFrame, body: str = "body", root: str = "root") -> DataFrame:
    """Documents of other kinds and grants that do not parse, with the reason."""
    # only grants are parsed, and of them the number alone is kept
    text = F.when(F.lower(root) == GRANT_ROOT, prepare_markup(F.col(body)))
    corrupt = F.from_xml(text, grant_schema(()), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    number = F.col("_x.us-bibliographic-data-grant.publication-reference.document-id.doc-number")
    reason = (
        F.when(F.lower(root) != GRANT_ROOT, "other kind")
        .when(F.col("_x._corrupt_record").isNotNull(), "not well-formed")
        .when(number.isNull(), "no document number")
    )
    return compute_once(documents, "_x", corrupt).withColumn("reason", reason).where("reason is not null").drop("_x")


def _text(path: str) -> Column:
    return clean_markup(F.coalesce(F.col(path), F.lit("")))


def _cleaned(rows: DataFrame, paths: dict[str, str], keep: tuple[str, ...] = ("patent", "seq")) -> DataFrame:
    """``keep`` and the cleaned text of every path under its name.

    One rule runs over all texts of a row, so the plan holds its long expression once, and later columns refer to the results.
    """
    texts = F.array(*(F.coalesce(F.col(path), F.lit("")) for path in paths.values()))
    done = compute_once(rows, "_texts", F.transform(texts, clean_markup))
    return done.select(*keep, *(F.get("_texts", F.lit(i)).alias(name) for i, name in enumerate(paths)))


def _at(path: str) -> Column:
    return F.col("g." + path)


def _position(grants: DataFrame, array: Column) -> DataFrame:
    return grants.select("patent", F.posexplode(array).alias("seq", "e"))


def _first_array(*paths: str) -> Column:
    return F.coalesce(*[_at(p) for p in paths])


def patents(grants: DataFrame) -> DataFrame:
    pub, app = "g.publication-reference.document-id.", "g.application-reference."
    texts = _cleaned(grants, {
        "kind": pub + "kind", "claims": "g.number-of-claims", "apptype": "g.us-application-series-code", "appnum": app + "document-id.doc-number",
        "gdate": pub + "date", "appdate": app + "document-id.date", "pattype": app + "_appl-type"}, ("patent",))
    return texts.select(
        "patent", "kind", "claims", "apptype", "appnum", "gdate", F.substring("gdate", 1, 4).alias("gyear"), "appdate",
        F.substring("appdate", 1, 4).alias("appyear"), "pattype")


def descriptions(grants: DataFrame) -> DataFrame:
    joined = clean_markup(F.coalesce(F.array_join("abstract", ""), F.lit("")))
    return grants.select("patent", joined.alias("abstract"), _text("g.invention-title").alias("title"))


def assignees(grants: DataFrame) -> DataFrame:
    """One row per assignee: organisations under their role, persons as ``LAST, FIRST`` under 00."""
    rows = _position(grants, _at("assignees.assignee"))
    where = "e.addressbook.address."
    texts = _cleaned(rows, {
        "first": "e.addressbook.first-name", "last": "e.addressbook.last-name", "role": "e.addressbook.role", "orgname": "e.addressbook.orgname",
        **{c: where + c for c in ("city", "state", "country")}, "nationality": "e.nationality.country", "residence": "e.residence.country"})
    first, last = F.col("first"), F.col("last")
    person = (first != "") | (last != "")
    return texts.select(
        "patent",
        F.when(person, "00").otherwise(F.col("role")).alias("asgtype"),
        F.when(person, person_label(join_prefix(first, last), split_given(first))).otherwise(F.col("orgname")).alias("assignee"),
        "city", "state", "country", "nationality", "residence", F.col("seq").alias("asgseq"),
    )


def _citations(grants: DataFrame) -> Column:
    return _first_array("references-cited.citation", "us-references-cited.us-citation")


def citations(grants: DataFrame) -> DataFrame:
    """Citations that name a country, numbered among themselves."""
    cited = F.filter(_citations(grants), lambda c: F.coalesce(c["patcit"]["document-id"]["country"], F.lit("")) != "")
    doc = "e.patcit.document-id."
    texts = _cleaned(_position(grants, cited), {
        "cit_date": doc + "date", "cit_name": doc + "name", "cit_kind": doc + "kind", "cit_country": doc + "country", "citation": doc + "doc-number",
        "category": "e.category"})
    return texts.select(
        "patent", "cit_date", "cit_name", "cit_kind", "cit_country", "citation", "category", F.col("seq").alias("citseq"),
        citation_date(F.col("cit_date")).alias("cit_day"),
    )


def other_references(grants: DataFrame) -> DataFrame:
    """Citations of other literature, numbered among themselves."""
    other = F.filter(_citations(grants), lambda c: c["othercit"].isNotNull())
    text = F.upper(escape_outside_sub(F.regexp_replace(F.col("e.othercit"), r"\s+", " ")))
    return _position(grants, other).select("patent", text.alias("descrip"), F.col("seq").alias("citseq"))


def classes(grants: DataFrame) -> DataFrame:
    """Class codes split after three characters; the main code comes first and is primary."""
    codes = F.concat(
        F.array(_at("classification-national.main-classification")),
        F.coalesce(_at("classification-national.further-classification"), F.array().cast("array<string>")),
    )
    code = F.col("code")
    return _cleaned(_position(grants, F.filter(codes, lambda c: c.isNotNull())), {"code": "e"}).select(
        "patent", F.when(F.col("seq") == 0, 1).otherwise(0).alias("prim"),
        F.replace(F.substring(code, 1, 3), F.lit(" "), F.lit("")).alias("class"),
        F.replace(F.substr(code, F.lit(4)), F.lit(" "), F.lit("")).alias("subclass"),
        class_label(code).alias("label"), F.col("seq").alias("clsseq"),
    )


def inventors(grants: DataFrame) -> DataFrame:
    rows = _position(
        grants,
        _first_array(
            "parties.applicants.applicant", "us-parties.inventors.inventor", "inventors.inventor",
            "parties.inventors.inventor",
        ),
    )
    where = "e.addressbook.address."
    texts = _cleaned(rows, {
        "first": "e.addressbook.first-name", "last": "e.addressbook.last-name", **{c: where + c for c in ("street", "city", "state", "country")},
        "zipcode": where + "postcode", "nationality": "e.nationality.country"})
    return texts.select(
        "patent", split_given(F.col("first")).alias("firstname"), join_prefix(F.col("first"), F.col("last")).alias("lastname"),
        "street", "city", "state", "country", "zipcode", "nationality", F.col("seq").alias("invseq"),
    )


def lawyers(grants: DataFrame) -> DataFrame:
    rows = _position(grants, _first_array("parties.agents.agent", "us-parties.agents.agent", "agents.agent"))
    texts = _cleaned(rows, {
        "first": "e.addressbook.first-name", "last": "e.addressbook.last-name", "lawcountry": "e.addressbook.address.country", "orgname": "e.addressbook.orgname"})
    return texts.select(
        "patent", split_given(F.col("first")).alias("firstname"), join_prefix(F.col("first"), F.col("last")).alias("lastname"),
        "lawcountry", "orgname", F.col("seq").alias("lawseq"),
    )


def related_documents(grants: DataFrame) -> DataFrame:
    """Relations in document order: type, relationship, number, kind, date, status."""

    def row(at: Column, part: Column, kind: str, relationship: Column, doc: Column, status: Column) -> Column:
        return F.struct(
            at.alias("at"), part.alias("part"), F.lit(kind).alias("doctype"), relationship.alias("relationship"), doc["country"].alias("country"),
            doc["doc-number"].alias("number"), doc["kind"].alias("kind"), doc["date"].alias("date"), status.alias("status"),
        )

    none = F.lit(None).cast("string")

    def of_relation(kind: str, at: Column):
        def found(r: Column, n: Column) -> Column:
            parent, child = r["parent-doc"], r["child-doc"]
            docs = [
                row(at, 4 * n + k, kind, F.lit(name), doc["document-id"], doc["parent-status"])
                for k, (name, doc) in enumerate((
                    ("parent-doc", parent),
                    ("parent-grant-document", parent["parent-grant-document"]),
                    ("parent-pct-document", parent["parent-pct-document"]),
                ))
            ]
            docs.append(row(at, 4 * n + 3, kind, F.lit("child-doc"), child["document-id"], none))
            return F.filter(F.array(*docs), lambda d: d["number"].isNotNull())

        return found

    def places(kind: str) -> Column:
        """Where the elements of a name stand among all of them."""
        numbered = F.transform("relation_order", lambda name, i: F.struct(name.alias("name"), i.alias("at")))
        return F.filter(numbered, lambda e: e["name"] == kind)

    def located(kind: str) -> Column:
        """The elements of a name, each with its place."""
        return F.arrays_zip(F.coalesce(_at(f"us-related-documents.{kind}"), F.array()).alias("block"), places(kind).alias("place"))

    def relations(kind: str) -> Column:
        return F.flatten(F.transform(located(kind), lambda z: F.flatten(
            F.transform(F.coalesce(z["block"]["relation"], F.array()), of_relation(kind, z["place"]["at"])))))

    def plain(kind: str) -> Column:
        return F.transform(located(kind), lambda z: row(z["place"]["at"], F.lit(0), kind, none, z["block"]["document-id"], none))

    lists = [relations(kind) for kind in RELATION_KINDS] + [plain(kind) for kind in PLAIN_RELATIONS]
    rows = _position(grants, F.array_sort(F.flatten(F.array(*lists))))
    order = F.when(F.col("e.relationship") == "child-doc", -1).when(F.col("e.relationship").isNull(), 0).otherwise(1)
    texts = _cleaned(rows.withColumn("_order", order), {c: f"e.{c}" for c in ("country", "number", "kind", "date", "status")}, ("patent", "seq", "e", "_order"))
    return texts.select(
        "patent", F.upper("e.doctype").alias("doctype"), F.col("_order").alias("orderseq"), "country", strip_leading_zero(F.col("number")).alias("relpatent"),
        "kind", F.col("date").alias("reldate"), "status", F.coalesce("e.relationship", F.lit("")).alias("relationship"), "seq",
    )


def ipc_classes(grants: DataFrame) -> DataFrame:
    rows = _position(grants, _at("classifications-ipcr.classification-ipcr"))
    return _cleaned(rows, {
        **{f.replace("-", "_"): f"e.{f}" for f in IPC_FIELDS}, "ipc_version_indicator": "e.ipc-version-indicator.date", "action_date": "e.action-date.date",
    }).select("patent", *(f.replace("-", "_") for f in IPC_FIELDS), "ipc_version_indicator", "action_date", "seq")


TABLES = {
    "assignee": assignees, "citation": citations, "class": classes, "inventor": inventors, "patent": patents,
    "patdesc": descriptions, "lawyer": lawyers, "sciref": other_references, "usreldoc": related_documents,
    "ipcr": ipc_classes,
}

#: The parts that each table reads.
PARTS = {
    "assignee": ("assignees",), "citation": ("references-cited", "us-references-cited"), "class": ("classification-national",),
    "inventor": ("parties", "us-parties", "inventors"), "patent": ("application-reference", "us-application-series-code", "number-of-claims"),
    "patdesc": ("invention-title",), "lawyer": ("parties", "us-parties", "agents"), "sciref": ("references-cited", "us-references-cited"),
    "usreldoc": ("us-related-documents",), "ipcr": ("classifications-ipcr",),
}
