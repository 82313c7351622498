"""A table from the parts it reads is the table from whole grants, odd documents included."""

import pytest

from linkloom.bindings import sources
from linkloom.sources import shred

_HEAD = "<us-patent-grant><us-bibliographic-data-grant><publication-reference><document-id><country>US</country><doc-number>D0{0}</doc-number></document-id></publication-reference>"
_TAIL = "</us-bibliographic-data-grant></us-patent-grant>"
_CITED = "<references-cited><citation><patcit><document-id><country>US</country><doc-number>7</doc-number></document-id></patcit></citation><citation><othercit>Some</othercit></citation></references-cited>"
_ASSIGNEE = "<assignees><assignee><addressbook><orgname>A</orgname></addressbook></assignee></assignees>"
_INNER = (
    _CITED + _ASSIGNEE, _CITED.replace("</citation>", "", 1) + _ASSIGNEE, "<references-cited>words</references-cited>" + _ASSIGNEE,
    "words between" + _ASSIGNEE + "and after" + _CITED, _ASSIGNEE + _ASSIGNEE, _CITED + _CITED, "<references-cited/><assignees/>", "<references-cited a='1'/>",
    "<assignees><assignee>text</assignee></assignees>", "<assignees><assignee><addressbook>B</addressbook></assignee></assignees>", "<classification-national>D3</classification-national>",
    "<classification-national><main-classification><x>D3</x></main-classification><further-classification/></classification-national>", "<invention-title>A <x>b</x> c</invention-title>",
    "<number-of-claims><n>3</n></number-of-claims>", "<parties><agents><agent/></agents><inventors><inventor><addressbook/></inventor></inventors></parties>", "<parties>none</parties>",
    "<inventors><inventor><addressbook><last-name>L</last-name></addressbook></inventor></inventors><assignees", "<unknown><references-cited/></unknown>", "<unknown>", "a < b & c", "&nosuch;" + _CITED,
    "<![CDATA[<x>]]>" + _CITED, "<!-- a -- b -->" + _CITED, "<references-cited><citation a=1></citation></references-cited>", "<agents><agent><addressbook><orgname>L</orgname></addressbook></agent></agents>\x01",
    "<us-related-documents><division><relation><parent-doc><document-id><doc-number>1</doc-number></document-id></parent-doc></relation></division></us-related-documents>",
    "<us-related-documents><division>text</division><reissue/></us-related-documents>", "<application-reference appl-type='x'>none</application-reference>",
    "<classifications-ipcr><classification-ipcr>A</classification-ipcr><classification-ipcr><section>B</section></classification-ipcr></classifications-ipcr>",
)


def _documents(spark):
    bodies = [_HEAD.format(i) + inner + _TAIL for i, inner in enumerate(_INNER)]
    whole = _HEAD.format(900) + _CITED + _ASSIGNEE + _TAIL
    bodies += [whole[: len(whole) * k // 12] for k in range(12)] + [whole + "<more", whole + whole, _TAIL, "", None, "<us-patent-grant/>", whole.replace("D0900", "")]
    rows = [("us-patent-grant", b) for b in bodies] + [("sequence-cwu", whole), ("sequence-cwu", "<broken"), ("US-PATENT-GRANT", whole), (None, whole), (None, "<broken")]
    return spark.createDataFrame(rows, "root string, body string").cache()


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", shred.TABLES)
def test_parts_give_the_table_of_whole_grants(spark, name):
    documents = _documents(spark)
    table = shred.TABLES[name]
    assert _rows(table(shred.parse_grants(documents, parts=shred.PARTS[name]))) == _rows(table(shred.parse_grants(documents)))


def test_bad_documents_are_those_of_the_whole_schema(spark, monkeypatch):
    documents = _documents(spark)
    found = _rows(shred.bad_documents(documents))
    monkeypatch.setattr(shred, "grant_schema", lambda parts=(): shred.GRANT_SCHEMA)
    assert found == _rows(shred.bad_documents(documents))
    assert len(found) > 10


def test_one_table_writes_no_grants(spark, monkeypatch):
    from linkloom import session

    def refuse(df):
        raise AssertionError("a single table needs no written grants")

    for module in (session, sources):
        monkeypatch.setattr(module, "cut_lineage", refuse)
    assert sources.QUERIES["shred_sciref"](spark, "/root/testdata/sf0.001").count() > 0
