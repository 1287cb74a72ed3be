"""Hand-written documents through the parser, node tables, edges and full text."""

from gneiss.operators import fulltext as FT
from gneiss.operators import graph as G
from gneiss.operators import nodes as N
from gneiss.operators.edges import RULES, edges, edges_in_row, shape_counts
from gneiss.operators.parse import parse, split_failures

FULL = """<ep-patent-document country="EP" doc-number=" 123 " kind="A1" date-publ="20240102" lang="en" id="EP24000001XY">
<SDOBI><B200><B220><date> 20230101 </date></B220></B200><B400><B405><date>20240103</date><bnum>7</bnum></B405></B400>
<B500><B510EP><classification-ipcr><text>G16B  15/00  2019</text></classification-ipcr><x><classification-ipcr><text>A61K 9/00</text><text>second</text></classification-ipcr></x><classification-ipcr/></B510EP>
<B520EP><classification-cpc><text>G16B 15/00 2013 1</text></classification-cpc><classification-cpc><text> </text></classification-cpc></B520EP></B500>
<B500><B510EP><classification-ipcr><text>IGNORED</text></classification-ipcr></B510EP></B500>
<B700><B710><B711><snm> Acme <i>x</i>y</snm><iid>9</iid><irf>r</irf><adr><str>S 1</str><city>Bonn</city><ctry>DE</ctry></adr></B711><y><B711><snm>Beta</snm></B711></y></B710>
<B720><B721><snm>Ann B </snm><adr><city>Rome</city><ctry>IT</ctry></adr></B721><B721><snm> </snm></B721></B720>
<B740><B741><snm>Law</snm><sfx>Dr</sfx><iid>88</iid></B741></B740></B700></SDOBI>
<part><abstract>any  <b>bold</b>\ttail</abstract></part><abstract lang=" en ">later</abstract>
<description><heading>H</heading><p>one <b>1</b> <!-- c -->x</p><p> </p><s><p>nested</p></s><p>two</p></description>
<claims lang="en"><claim id="c1" num="1">first <i>claim</i></claim><claim id="c2">  </claim><claim id="c3">third</claim></claims><claims lang=" en"><claim>no</claim></claims><claims lang="en"><claim id="d" num="4">more</claim></claims></ep-patent-document>"""


def documents(spark, **xml):
    return spark.createDataFrame([(f"T.zip::DOC/{k}.xml", v.encode() if v is not None else None) for k, v in xml.items()], "source_id string, xml binary")


def one(df):
    (row,) = df.collect()
    return row.asDict()


def test_full_document(spark):
    p = parse(documents(spark, full=FULL))
    s = "T.zip::DOC/full.xml"
    assert one(N.publications(p)) == {"pub_id": "EP123A1", "country": "EP", "pub_number": "123", "kind_code": "A1", "publication_date": "20240102", "pub_language": "en", "source_id": s}
    assert one(N.applications(p)) == {"appln_id": "EP24000001XY", "appln_country": "EP", "appln_number": "24000001", "appln_kind_code": "XY", "appln_filing_date": "20230101", "gazette_date": "20240103", "gazette_issue": "7", "source_id": s}
    assert {tuple(x)[:3] for x in N.ipc_codes(p).collect()} == {("G16B  15/00  2019", "G16B 15/00", "G16B"), ("A61K 9/00", "A61K 9/00", "A61K")}
    assert {tuple(x)[:3] for x in N.cpc_codes(p).collect()} == {("G16B 15/00 2013 1", "G16B 15/00", "G16B"), ("", "", "")}
    assert {tuple(x)[:-1] for x in N.applicants(p).collect()} == {("9", "Acme", "9", "r", "S 1", "Bonn", "DE"), ("NAME:beta|CC:", "Beta", "", "", "", "", "")}
    assert {tuple(x)[:-1] for x in N.inventors(p).collect()} == {("INV:ann b|CITY:rome|CC:IT", "Ann B", "", "Rome", "IT")}
    assert {tuple(x)[:-1] for x in N.attorneys(p).collect()} == {("88", "Law", "Dr", "88", "", "", "")}
    assert [x[0] for x in N.source_files(p).collect()] == [s]
    tables = N.node_tables(p)
    assert tables["citation"].columns == ["from_pub_id", "to_pub_id", "cite_type", "source_id"] and tables["citation"].count() == 0
    a, b = edges(tables), edges_in_row(p)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    shapes = {x["rel_type"]: x["n"] for x in shape_counts(a).collect()}
    assert shapes == {"FROM_SOURCE": 1, "HAS_PUBLICATION": 1, "OF_APPLICATION": 1, "HAS_IPC": 2, "HAS_CPC": 1, "APPLIES_FOR": 2, "INVENTED": 1, "REPRESENTS": 1} and len(RULES) == 8


def test_fulltext(spark):
    p = parse(documents(spark, full=FULL))
    got = {x["lang"]: x for x in FT.fulltext(p, ["en", "fr"]).collect()}
    assert got["en"]["abstract_text"] == got["fr"]["abstract_text"] == "any bold tail"
    assert got["en"]["description_text"] == got["fr"]["description_text"] == "one 1 x\n\ntwo"
    assert got["en"]["claims_text"] == "1. first claim\n\nthird\n\n4. more" and got["fr"]["claims_text"] is None and got["fr"]["claims_json"] is None
    assert got["en"]["claims_json"] == '[{"id":"c1","num":"1","text":"first claim"},{"id":"c3","num":"","text":"third"},{"id":"d","num":"4","text":"more"}]'


def head(body="", attrs='country="EP" doc-number="1" kind="A1" id="EP1"'):
    return f"<ep-patent-document {attrs}>{body}</ep-patent-document>"


def test_fulltext_odd(spark):
    p = parse(
        documents(
            spark,
            flat=head("<description>only <h>flat</h> text</description>"),
            none=head("<description> </description>"),
            first_empty=head("<abstract lang='en'/><abstract lang='en'>x</abstract>"),
            other=head("<abstract lang='de'>x</abstract>"),
            nopub=head("<abstract>x</abstract>", 'country="EP" id="EP1"'),
        )
    )
    assert {x["source_id"]: x["description_text"] for x in FT.fulltext(p).collect()} == {"T.zip::DOC/flat.xml": "only flat text"}


def test_strictness_and_isolation(spark):
    blank = "<SDOBI><B500><B510EP><classification-ipcr><text> </text></classification-ipcr></B510EP></B500></SDOBI>"
    docs = documents(spark, ok=head(), noid=head("", 'country="EP" doc-number="2" kind="A1"'), blank=head(blank, 'country="EP" doc-number="3" kind="A1"'), bad="<a><b></a>", empty="", null=None, dtd='<!DOCTYPE ep-patent-document SYSTEM "x.dtd">' + head("", 'country="EP" doc-number="4" kind="A1"'))
    p = parse(docs)
    good, bad = split_failures(p)
    assert {x["source_id"][11:-4] for x in bad.collect()} == {"bad", "empty", "null"} and N.publications(good).count() == 4
    assert {x["source_id"][11:-4] for x in split_failures(p, strict_application=True, strict_ipc=True)[1].collect()} == {"bad", "empty", "null", "ok", "blank"}
    assert {tuple(x)[:3] for x in N.ipc_codes(good).collect()} == {("", "", "")}


def test_no_publication_keeps_party_edges(spark):
    p = parse(documents(spark, x=head("<SDOBI><B700><B710><B711><snm>A</snm></B711></B710></B700></SDOBI>", 'id="EP1"')))
    assert [(x["rel_type"], x["from_id"], x["to_id"]) for x in edges(N.node_tables(p)).collect()] == [("APPLIES_FOR", "NAME:a|CC:", "EP1")]
    assert N.source_files(p).count() == 0


def test_resolution_in_row(spark):
    """As the joins resolve: shared publications, ids that stripping changes, blank ones, with and without aliases."""
    body = FULL[FULL.index(">") + 1 :]
    other = head("<SDOBI><B700><B710><B711><snm>Beta</snm></B711></B710></B700></SDOBI>", 'country="EP" doc-number="123" kind="A1" id="EP24000001XY"')
    made = [("a", FULL), ("b", FULL), ("c", other), (" c", other), (" d ", other), ("e", head()), (" e", head("", 'country="EP" doc-number="9" kind="A1" id="EP1"')), (" ", FULL), ("", FULL), (None, FULL), ("f", "<x"), ("g", f'<ep-patent-document id="EP24000001XY">{body}')]
    parsed = parse(spark.createDataFrame([(k, v.encode()) for k, v in made], "source_id string, xml binary"))
    for aliases in (True, False):
        want = G.resolve(edges_in_row(parsed, once=True), G.vertex_ids_in_row(parsed), aliases=aliases)
        got = G.resolve_in_row(parsed, aliases=aliases)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
        assert got.where("to_id = 'c' and rel_type = 'FROM_SOURCE'").count() == 1 and got.where("to_id = 'd'").count() == 0


def test_edges_are_made_once(spark):
    """No filter before the explode makes all edges of a row once more."""
    plan = edges_in_row(parse(documents(spark, full=FULL)), ["FROM_SOURCE", "HAS_PUBLICATION"], once=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array(") == 2 and "size(" not in plan


def test_root_without_a_tree(spark):
    """The quick way to the root's attributes says what the tree says, of broken documents too."""
    odd = {"full": FULL, "broken": "<x country='EP'><y></x>", "none": "", "null": None, "spaces": '<x country=" EP " doc-number="1\n"/>', "prefix": '<p:x xmlns:p="u" p:country="no" country="EP"/>', "unbound": "<p:x country='EP'/>", "twice": "<x/><x/>", "dtd": '<!DOCTYPE x SYSTEM "x.dtd"><x country="EP">&foo;</x>', "entity": "<x country='EP'>&foo;</x>", "nested": "<x><y country='EP'/></x>"}
    docs = documents(spark, **odd)
    quick, tree = (sorted(map(tuple, parse(docs, f).select("source_id", "root", "error").collect())) for f in (["root"], ["root", "appl"]))
    assert quick == tree


def test_parse_in_bounded_batches(spark):
    """What leaves Python at once is bounded by rows and by bytes of XML, whatever comes in at once."""
    from gneiss.operators import parse as P
    from pyspark.sql.pandas.types import to_arrow_schema
    import pyarrow as pa

    long = f"<x>{'a' * (P.CHUNK_BYTES // 2)}</x>".encode()
    bodies = [b"<x/>"] * 1200 + [long] * 5 + [None]
    b = pa.record_batch([pa.array([str(i) for i in range(len(bodies))]), pa.array([0] * len(bodies)), pa.array([[]] * len(bodies), pa.list_(pa.string())), pa.array(bodies)], names=list("abcd"))
    out = list(P._parse(iter([b]), to_arrow_schema(P.PARSED), ("root",)))
    assert [x for r in out for x in r.column(0).to_pylist()] == [str(i) for i in range(len(bodies))]
    assert max(r.num_rows for r in out) <= P.CHUNK_ROWS and len(out) >= 6


def test_edges_are_joined_over_all_partitions(spark):
    """Rows are dealt by number, so the session may not put partitions together before the join."""
    p = parse(documents(spark, full=FULL))
    both = [r for r in RULES if r.rel_type in ("HAS_PUBLICATION", "OF_APPLICATION")]
    out = edges({"publication": N.publications(p), "application": N.applications(p)}, both)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 3 and "hashpartitioning(source_id" in plan
    assert {(r["from_id"], r["rel_type"], r["to_id"]) for r in out.collect()} == {("EP24000001XY", "HAS_PUBLICATION", "EP123A1"), ("EP123A1", "OF_APPLICATION", "EP24000001XY")}
