"""The driver's queries over the engine's own operators, and the same in SQL."""

from __future__ import annotations

import io
import tarfile
import uuid
import zipfile
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.functions import text as T
from gneiss.operators import edges as E
from gneiss.operators import fulltext as FT
from gneiss.operators import graph as G
from gneiss.operators import ingest as I
from gneiss.operators import nodes as N
from gneiss.operators import status as S
from gneiss.operators.parse import failure, parse, split_failures
from gneiss.plans.fixtures import application, kind, order_facts, patents, source_id, table
from gneiss.schemas import FULLTEXT, VERTICES
from gneiss.sources import tables as TB
from gneiss.sources.archives import DOCUMENTS, _rows, filtered_archive
from gneiss.sources.http import metadata_url
from gneiss.sources.tables import set_aside

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("select c_custkey, 'NAME:'||lower(trim(c_name))||'|CC:'||trim(n_name) as org_key from customer join nation on c_nationkey=n_nationkey")
def q01_org_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select("c_custkey", T.organisation_key(F.lit(None).cast("string"), F.col("c_name"), F.col("n_name")).alias("org_key"))


@query("select s_suppkey, 'INV:'||lower(s_name)||'|CITY:'||lower(r_name)||'|CC:'||n_name as person_key from supplier join nation on s_nationkey=n_nationkey join region on n_regionkey=r_regionkey")
def q02_inventor_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    rows = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    return rows.select("s_suppkey", T.inventor_key(F.col("s_name"), F.col("r_name"), F.col("n_name")).alias("person_key"))


@query("select c_custkey, case when c_custkey%2=0 then 'ID'||c_custkey else 'ATT:'||lower(c_name)||'|CITY:'||lower(c_mktsegment)||'|CC:'||n_name end as person_key from customer join nation on c_nationkey=n_nationkey")
def q03_attorney_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    ident = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit(" ID"), F.col("c_custkey").cast("string")))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select("c_custkey", T.attorney_key(ident, F.col("c_name"), F.col("c_mktsegment"), F.col("n_name")).alias("person_key"))


@query("select p_partkey, p_brand||' '||p_type as long_code, p_brand as short_code from part")
def q04_ipc_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit(" "), "p_brand", F.lit("   "), "p_type", F.lit("  "), F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", T.ipc_long(raw).alias("long_code"), T.ipc_short(raw).alias("short_code"))


@query("select p_partkey, case when p_partkey%4=3 then p_brand||' '||p_type else p_brand end as long_code, substr(p_brand,1,4) as short_code from part")
def q05_cpc_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    raw = F.concat_ws("  ", "p_brand", F.when(k >= 1, F.col("p_type")), F.when(k >= 2, F.col("p_size").cast("string")), F.when(k >= 3, F.lit("X")))
    return table(spark, sf_dir, "part").select("p_partkey", T.cpc_long(raw).alias("long_code"), T.cpc_short(raw).alias("short_code"))


@query("select o_orderkey, substr(i,1,2) as country, substr(i,3,8) as number, substr(i,11) as kind, 'EP'||o_orderkey||o_orderstatus as pub_id from (select *, 'EP'||lpad(o_orderkey::varchar,8,'0')||o_orderstatus as i from orders)")
def q06_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    country, number, kind_code = T.application_parts(F.concat(F.lit("EP"), F.lpad(key, 8, "0"), "o_orderstatus"))
    return table(spark, sf_dir, "orders").select("o_orderkey", country.alias("country"), number.alias("number"), kind_code.alias("kind"), T.publication_id(F.lit("EP"), key, F.col("o_orderstatus")).alias("pub_id"))


# the documents of order_facts() and what they say, in SQL
_KIND = "case o_orderstatus when 'F' then 'A1' when 'O' then 'A2' else 'B1' end"
_ORDERS = f"(select *, 'EP'||lpad(o_orderkey::varchar,9,'0')||{_KIND} as pub_id, 'EP'||lpad(o_custkey::varchar,8,'0')||o_orderstatus as appln_id, 'T'||(o_orderkey%7)||'.zip::DOC/'||o_orderkey||'.xml' as source_id, strftime(o_orderdate,'%Y%m%d') as day from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey)"


@query(f"select pub_id, 'EP' as country, lpad(o_orderkey::varchar,9,'0') as pub_number, {_KIND} as kind_code, day as publication_date, 'en' as pub_language, source_id from {_ORDERS}")
def q07_publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.publications(parse(patents(spark, sf_dir, codes=False), ["root"]))


@query(f"select appln_id, substr(appln_id,1,2) as appln_country, substr(appln_id,3,8) as appln_number, substr(appln_id,11) as appln_kind_code, day as appln_filing_date, case when o_orderkey%3=0 then '' else day end as gazette_date, case when o_orderkey%3=0 then '' else o_custkey::varchar end as gazette_issue, source_id, o_orderkey%3=0 as fails_if_strict from {_ORDERS}")
def q08_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse(patents(spark, sf_dir, codes=False), ["root", "appl"])
    told = parsed.withColumn("fails_if_strict", failure(strict_application=True).isNotNull())
    return N.applications(told, "fails_if_strict")


_PARTY = "case when o_custkey%2=0 then 'ID'||o_custkey else '{0}' || lower(c_name)||'{1}|CC:'||n_name end"


@query(
    f"select 'applicant' as party, {_PARTY.format('NAME:', '')} as key, c_name as name, n_name as country, source_id from {_ORDERS} union all "
    f"select 'inventor', 'INV:'||lower(c_name)||'|CITY:city '||c_nationkey||'|CC:'||n_name, c_name, n_name, source_id from {_ORDERS} where o_orderkey%2=0 union all "
    f"select 'attorney', case when o_custkey%2=0 then 'ID'||o_custkey else 'ATT:'||lower(c_name)||'|CITY:city '||c_nationkey||'|CC:'||n_name end, c_name, n_name, source_id from {_ORDERS} where o_orderkey%2=0"
)
def q09_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = set_aside(parse(patents(spark, sf_dir, codes=False), ["applicants", "inventors", "attorneys"]), "parties")  # parsed once for three tables
    parts = [rows.select(F.lit(p).alias("party"), F.col(k).alias("key"), F.col(f"{p}_name").alias("name"), F.col(f"{p}_country").alias("country"), "source_id") for p, k, rows in (("applicant", "org_key", N.applicants(parsed)), ("inventor", "person_key", N.inventors(parsed)), ("attorney", "person_key", N.attorneys(parsed)))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_LINES = f"{_ORDERS} o join lineitem on l_orderkey=o.o_orderkey join part on l_partkey=p_partkey"


@query(f"select p_brand as ipc_short_code, count(distinct pub_id) as n_publications, count(distinct o_orderkey||'|'||p_brand||' '||p_type) as n_edges from {_LINES} group by 1")
def q10_publications_per_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse(patents(spark, sf_dir), E.fields_for(("HAS_IPC",)))
    links = E.edges_in_row(parsed, ("HAS_IPC",), once=True)  # both ends come from one document: no join, no dedupe over documents
    return links.groupBy(T.ipc_short(F.col("to_id")).alias("ipc_short_code")).agg(F.countDistinct("from_id").alias("n_publications"), F.count(F.lit(1)).alias("n_edges"))


@query(f"select distinct pub_id as from_id, 'HAS_IPC' as rel_type, 'IPC' as to_label, p_brand||' '||p_type as to_id, source_id from {_LINES}")
def q11_ipc_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = set_aside(parse(patents(spark, sf_dir), ["root", "ipc"]), "codes")  # parsed once for both sides of the join
    links = E.edges({"publication": N.publications(parsed), "ipc": N.ipc_codes(parsed)}, [r for r in E.RULES if r.rel_type == "HAS_IPC"])
    return links.select("from_id", "rel_type", "to_label", "to_id", "source_id")


@query(f"select {_PARTY.format('NAME:', '')} as from_id, 'APPLIES_FOR' as rel_type, appln_id as to_id, source_id from {_ORDERS}")
def q12_applicant_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_facts(spark, sf_dir).withColumns({"source_id": source_id(), "appln_id": application()})
    ident = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("ID"), F.col("o_custkey").cast("string")))
    tables = {"applicant": rows.select(T.organisation_key(ident, F.col("c_name"), F.col("n_name")).alias("org_key"), "source_id"), "application": rows.select("appln_id", "source_id")}
    return E.edges(tables, [r for r in E.RULES if r.rel_type == "APPLIES_FOR"]).select("from_id", "rel_type", "to_id", "source_id")


@query(f"select appln_id as from_id, 'HAS_PUBLICATION' as rel_type, pub_id as to_id from {_ORDERS} union all select pub_id, 'OF_APPLICATION', appln_id from {_ORDERS}")
def q13_publication_application_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_facts(spark, sf_dir).select(T.publication_id(F.lit("EP"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), kind()).alias("pub_id"), application().alias("appln_id"), source_id().alias("source_id"))
    return E.edges({"publication": rows.select("pub_id", "source_id"), "application": rows.select("appln_id", "source_id")}, [r for r in E.RULES if r.rel_type in ("HAS_PUBLICATION", "OF_APPLICATION")]).select("from_id", "rel_type", "to_id")


@query(f"select pub_id as from_id, 'SourceFile' as to_label, source_id as to_id from {_ORDERS} union all select null, 'source_file', source_id from {_ORDERS}")
def q14_source_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse(patents(spark, sf_dir, codes=False), ["root"])
    links = E.edges({"publication": N.publications(parsed)}, [r for r in E.RULES if r.rel_type == "FROM_SOURCE"])
    return links.select("from_id", "to_label", "to_id").unionByName(N.source_files(parsed).select(F.lit(None).cast("string").alias("from_id"), F.lit("source_file").alias("to_label"), F.col("source_id").alias("to_id")))


_CPC = "case when l_linenumber%4=0 then p_brand||' '||p_type else p_brand end"
_SHAPES = (
    ("Publication", "pub_id", "FROM_SOURCE", "SourceFile", "source_id", f"select count(*) from {_ORDERS}"),
    ("Application", "appln_id", "HAS_PUBLICATION", "Publication", "pub_id", f"select count(*) from {_ORDERS}"),
    ("Publication", "pub_id", "OF_APPLICATION", "Application", "appln_id", f"select count(*) from {_ORDERS}"),
    ("Publication", "pub_id", "HAS_IPC", "IPC", "long_code", f"select count(distinct o_orderkey||'|'||p_brand||' '||p_type) from {_LINES}"),
    ("Publication", "pub_id", "HAS_CPC", "CPC", "long_code", f"select count(distinct o_orderkey||'|'||{_CPC}) from {_LINES}"),
    ("Organisation", "org_key", "APPLIES_FOR", "Application", "appln_id", f"select count(*) from {_ORDERS}"),
    ("Person", "person_key", "INVENTED", "Application", "appln_id", f"select count(*) from {_ORDERS} where o_orderkey%2=0"),
    ("Person", "person_key", "REPRESENTS", "Application", "appln_id", f"select count(*) from {_ORDERS} where o_orderkey%2=0"),
)


@query(" union all ".join(f"select '{a}' as from_label, '{b}' as from_key, '{r}' as rel_type, '{x}' as to_label, '{y}' as to_key, ({n}) as n" for a, b, r, x, y, n in _SHAPES))
def q15_edge_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.shape_counts(E.edges_in_row(parse(patents(spark, sf_dir), E.fields_for([r.rel_type for r in E.RULES])), once=True))


def _graph(spark: SparkSession, sf_dir: str, aliases: bool) -> DataFrame:
    types = G.resolved_types(aliases=aliases)  # without aliases, no vertex has the other types' labels
    parsed = set_aside(parse(patents(spark, sf_dir), E.fields_for(list(types))), "graph")  # parsed once for all passes
    return G.resolve_in_row(parsed, aliases=aliases).groupBy("rel_type", "from_label", "to_label").agg(F.count(F.lit(1)).alias("n"))


_MERGED = {
    "FROM_SOURCE": f"select count(*) from {_ORDERS}",
    "HAS_PUBLICATION": f"select count(distinct appln_id||pub_id) from {_ORDERS}",
    "OF_APPLICATION": f"select count(distinct appln_id||pub_id) from {_ORDERS}",
    "HAS_IPC": f"select count(distinct pub_id||'|'||p_brand||' '||p_type) from {_LINES}",
    "HAS_CPC": f"select count(distinct pub_id||'|'||{_CPC}) from {_LINES}",
    "APPLIES_FOR": f"select count(distinct appln_id||'|'||o_custkey) from {_ORDERS}",
    "INVENTED": f"select count(distinct appln_id||'|'||o_custkey) from {_ORDERS} where o_orderkey%2=0",
    "REPRESENTS": f"select count(distinct appln_id||'|'||o_custkey) from {_ORDERS} where o_orderkey%2=0",
}


def _merged_sql(ends: dict[str, tuple[str, str]]) -> str:
    return " union all ".join(f"select '{r}' as rel_type, '{a}' as from_label, '{b}' as to_label, ({_MERGED[r]}) as n" for r, (a, b) in ends.items())


_STATIC = {"FROM_SOURCE": ("Publication", "SourceFile"), "HAS_PUBLICATION": ("Application", "Publication"), "OF_APPLICATION": ("Publication", "Application")}


@query(_merged_sql(_STATIC))
def q16_resolved_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _graph(spark, sf_dir, False)


@query(_merged_sql({**_STATIC, "HAS_IPC": ("Publication", "IpcClassification"), "HAS_CPC": ("Publication", "CpcClassification"), "APPLIES_FOR": ("Applicant", "Application"), "INVENTED": ("Inventor", "Application"), "REPRESENTS": ("Attorney", "Application")}))
def q17_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _graph(spark, sf_dir, True)


@query("select distinct 'User' as from_label, 'user_id' as from_key, user_id::varchar as from_id, event_type as rel_type, 'Day' as to_label, 'day' as to_key, strftime(ts,'%Y%m%d') as to_id from events")
def q18_merged_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    rows = e.select(F.lit("User").alias("from_label"), F.lit("user_id").alias("from_key"), F.col("user_id").cast("string").alias("from_id"), F.col("event_type").alias("rel_type"), F.lit("Day").alias("to_label"), F.lit("day").alias("to_key"), F.date_format("ts", "yyyyMMdd").alias("to_id"), F.col("event_id").cast("string").alias("source_id"))
    # what is there and what comes overlap and together are all rows
    return G.merge_edges(rows.where("event_type <> 'click'"), rows.where("event_type = 'click' or value > 50"))


@query("select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events) where n=1")
def q19_last_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.last_rows(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("select user_id::varchar as source_id, event_type as pub_id from (select *, row_number() over (partition by user_id order by ts, event_id) as n from events) where n=1")
def q20_first_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("source_id"), F.col("event_type").alias("pub_id"), "ts", "event_id")
    return E.first_by_source(e, "pub_id", ["ts", "event_id"])


@query("select distinct source_id from (select (o_custkey)::varchar as source_id from orders union all select user_id::varchar from events) where source_id not in (select s_suppkey::varchar from supplier)")
def q21_new_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    def ids(name, column):
        return table(spark, sf_dir, name).select(F.col(column).cast("string").alias("source_id"))

    blank = spark.range(1).select(F.lit("").alias("source_id"))
    return G.new_source_ids({"orders": ids("orders", "o_custkey"), "events": ids("events", "user_id"), "blank": blank}, ids("supplier", "s_suppkey"))


@query("select event_id, user_id::varchar as source_id, event_type from events where user_id not in (select user_id from events where event_id < 100)")
def q22_incremental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("source_id"), "event_type")
    loaded = e.where("event_id < 100")
    return G.only_sources({"e": e}, G.new_source_ids({"e": e}, loaded))["e"]


@query(r"select doc_id, md5(trim(regexp_replace(text,'\s+',' ','g'))) as digest from documents")
def q23_collapse_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.encode(T.collapse(F.col("text")), "UTF-8")).alias("digest"))


@query(r"select doc_id, md5(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x,'\s+',' ','g'))), lambda x: x <> ''), chr(10)||chr(10))) as digest from documents")
def q24_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.filter(F.transform(F.split("text", "\n"), T.collapse), lambda x: x != "")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.struct(parts.alias("paragraphs"), F.col("text").alias("flat")).alias("description"))
    return rows.select("doc_id", F.md5(F.encode(F.coalesce(FT.description_text(), F.lit("")), "UTF-8")).alias("digest"))


def _conversation_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.struct("turn", F.struct(F.col("role").alias("id"), F.when(F.col("turn") % 3 == 0, F.lit("")).otherwise(F.col("turn").cast("string")).alias("num"), T.collapse(F.col("text")).alias("text")).alias("c"))
    per = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return per.select("conv_id", F.array(F.struct(F.lit("en").alias("lang"), F.transform("t", lambda x: x["c"]).alias("claims"))).alias("claims"))


_CLAIM = r"select conv_id, turn, role, case when turn%3=0 then '' else turn::varchar end as num, trim(regexp_replace(text,'\s+',' ','g')) as body from conversations"


@query(f"select conv_id, md5(string_agg(case when num<>'' then num||'. '||body else body end, chr(10)||chr(10) order by turn)) as digest from ({_CLAIM}) where body<>'' group by conv_id")
def q25_claims_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _conversation_claims(spark, sf_dir).select("conv_id", FT.claims_text(FT.claims_of(F.lit("en"))).alias("c")).where("c is not null")
    return rows.select("conv_id", F.md5(F.encode("c", "UTF-8")).alias("digest"))


@query(f"select conv_id, md5('['||string_agg('{{\"id\":'||to_json(role)||',\"num\":'||to_json(num)||',\"text\":'||to_json(body)||'}}', ',' order by turn)||']') as digest from ({_CLAIM}) where body<>'' group by conv_id")
def q26_claims_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _conversation_claims(spark, sf_dir).select("conv_id", FT.claims_json(FT.claims_of(F.lit("en"))).alias("c")).where("c is not null")
    return rows.select("conv_id", F.md5(F.encode("c", "UTF-8")).alias("digest"))


_LANGS = ("en", "fr", "de")


@query(
    r"select source_id, pub_id, l.lang, md5(case when d.lang=l.lang then body end) as abstract, case when d.lang=l.lang and doc_id%2=0 then md5('1. '||body) end as claims from "
    r"(select *, doc_id::varchar as source_id, 'EP'||doc_id||'A1' as pub_id, trim(regexp_replace(text,'\s+',' ','g')) as body from documents) d, (values ('en'),('fr'),('de')) l(lang) where d.lang=l.lang and body<>''"
)
def q27_fulltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    claim = F.struct(F.lit("c1").alias("id"), F.lit("1").alias("num"), T.collapse(F.col("text")).alias("text"))
    rows = d.select(
        F.col("doc_id").cast("string").alias("source_id"),
        F.struct(F.lit("EP").alias("country"), F.col("doc_id").cast("string").alias("doc_number"), F.lit("A1").alias("kind"), F.lit("").alias("id")).alias("root"),
        F.array(F.struct("lang", T.collapse(F.col("text")).alias("text"))).alias("abstracts"),
        F.lit(None).cast("struct<paragraphs:array<string>,flat:string>").alias("description"),
        F.when(F.col("doc_id") % 2 == 0, F.array(F.struct("lang", F.array(claim).alias("claims")))).otherwise(F.array().cast("array<struct<lang:string,claims:array<struct<id:string,num:string,text:string>>>>")).alias("claims"),
    )

    def digest(c):
        return F.md5(F.encode(c, "UTF-8"))

    return FT.fulltext(rows, _LANGS).select("source_id", "pub_id", "lang", digest("abstract_text").alias("abstract"), digest("claims_text").alias("claims"))


@query(
    "select 'P'||coalesce(t.doc_id,s.doc_id) as pub_id, coalesce(t.lang,'en') as lang, case when s.doc_id is not null then 's2' else 's1' end as source_id, case when t.doc_id is not null then 'A'||t.doc_id else 'B'||s.doc_id end as appln_id, "
    "md5(case when s.doc_id is null then t.text when s.quality=1 then 'toxic '||s.toxic end) as abstract from documents t full join labels s on t.doc_id=s.doc_id and t.lang='en'"
)
def q28_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their texts, and all labels set over them as English records; what is null overwrites too."""

    def records(rows, source, prefix, lang, abstract):
        own = {"source_id": F.lit(source), "appln_id": F.concat(F.lit(prefix), F.col("doc_id").cast("string")), "pub_id": F.concat(F.lit("P"), F.col("doc_id").cast("string")), "lang": lang, "abstract_text": abstract}
        return rows.select(*[own.get(f.name, F.lit(None).cast("string")).alias(f.name) for f in FULLTEXT])

    target = records(table(spark, sf_dir, "documents"), "s1", "A", F.col("lang"), F.col("text"))
    batch = records(table(spark, sf_dir, "labels"), "s2", "B", F.lit("en"), F.when(F.col("quality") == 1, F.concat(F.lit("toxic "), F.col("toxic").cast("string"))))
    return FT.upsert(target, batch).select("pub_id", "lang", "source_id", "appln_id", F.md5(F.encode("abstract_text", "UTF-8")).alias("abstract"))


@query("select doc_id::varchar as source_id from documents where doc_id not in (select doc_id from labels where quality=1)")
def q29_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("source_id"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("source_id"), "quality")
    log = S.done_rows(labels.where("quality = 1")).unionByName(S.failed_rows(labels.where("quality = 0").withColumn("error", F.lit("ParseError"))))
    return S.pending(ids, log)


@query("select 'page'||page_id as source_id, 'failed' as status, 'ParseError' as class from pages union all select 'doc'||doc_id, 'done', null from documents")
def q30_parse_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, none of which is XML, and documents as XML, in one run: each is told by its status and the kind of its error."""
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("page"), F.col("page_id").cast("string")).alias("source_id"), F.encode("html", "UTF-8").alias("xml"))
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("source_id"), F.encode(F.concat(F.lit("<x>"), xml_text(F.col("text")), F.lit("</x>")), "UTF-8").alias("xml"))
    good, bad = split_failures(set_aside(parse(pages.union(docs), ["root"]), "status"))
    return S.done_rows(good).unionByName(S.failed_rows(bad)).select("source_id", "status", F.substring_index("error", ":", 1).alias("class"))


@query("select 'a'||user_id||'.zip' as filename, event_type as status, event_id::varchar as raw_size, '' as message from (select *, row_number() over (partition by user_id order by event_id desc) as n from events) where n=1")
def q31_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    raw = e.select(F.concat(F.lit(" a"), F.col("user_id").cast("string"), F.lit(".zip ")).alias("filename"), F.col("event_type").alias("status"), F.col("event_id").cast("string").alias("raw_size"), F.col("event_id").alias("row"))
    return S.manifest_rows(raw, ["row"]).select("filename", "status", "raw_size", "message")


@query(
    "select o_orderkey, case when o_orderkey%11=0 then 'skipped' when o_orderkey%7=0 then 'moved' when o_orderkey%5=0 then case when o_custkey%4<>0 then 'moved' else 'failed' end "
    "when not o_orderkey%3=0 and o_custkey%3=0 then 'failed' when o_custkey%5=0 then 'failed' when o_custkey%7=0 then 'empty' when o_custkey%4<>0 then 'moved' else 'failed' end as status from orders"
)
def q32_ingest_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    name = F.when(o % 11 == 0, F.lit("a.rar")).otherwise(F.lit("A.TAR.GZ"))
    state = I.ingest_state(name, o % 7 == 0, o % 5 == 0, o % 3 == 0, c % 3 != 0, c % 5 != 0, c % 7 != 0, c % 4 != 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", state["status"].alias("status"))


@query(
    "select p_partkey, case p_partkey%5 when 0 then 'zip' when 1 then 'tar.gz' when 2 then 'tar' when 3 then 'tar.gz' end as kind, case p_partkey%5 when 1 then 'r:gz' when 2 then 'r:' when 3 then 'r:gz' end as mode, p_partkey%5=4 and p_size%3=0 as keep, p_size%2=0 as in_doc from part"
)
def q33_member_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 5
    name = F.concat(F.when(F.col("p_size") % 2 == 0, F.lit("./DOC/")).otherwise(F.lit("./DOCS/doc/")), F.when(F.col("p_size") % 3 == 0, F.lit("Ep")).otherwise(F.lit("us")), F.col("p_partkey").cast("string"), F.when(k == 0, ".ZIP").when(k == 1, ".tgz").when(k == 2, ".tar").when(k == 3, ".Tar.Gz").otherwise(".XML"))
    return table(spark, sf_dir, "part").select("p_partkey", T.archive_kind(name).alias("kind"), T.tar_mode(name).alias("mode"), T.keeps_xml(name).alias("keep"), T.under_doc(name).alias("in_doc"))


@query("select event_id::varchar as delivery_id, user_id::varchar as file_id, event_type||'.zip' as filename, case when event_id%3<>0 then event_id end as expected_size from events where event_id%4<>0")
def q34_archive_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    size = F.when(e % 3 == 0, F.lit('"n/a"')).when(e % 3 == 1, e.cast("string")).otherwise(F.concat(F.lit('"'), e.cast("string"), F.lit('"')))
    file = F.concat(F.lit('{"fileId":'), F.col("user_id").cast("string"), F.lit(',"name":null,"fileName":"'), "event_type", F.lit('.zip","size":'), size, F.lit("}"))
    delivery = F.concat(F.when(e % 4 == 0, F.lit('{"other":')).otherwise(F.lit('{"deliveryId":')), e.cast("string"), F.lit(',"files":['), file, F.lit(',7,{"id":1}]}'))
    return I.archive_refs(table(spark, sf_dir, "events").select(F.concat(F.lit('{"deliveries":["x",'), delivery, F.lit("]}")).alias("metadata")))


@query("select o_orderkey, floor((n-1)/500)::bigint as batch from (select *, row_number() over (order by o_orderkey) as n from (select * from orders where o_orderstatus<>'P' order by o_orderkey limit 1250))")
def q35_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gneiss.plans.pipelines import take_successes

    good = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select("o_orderkey", F.lit(0).alias("batch_id"), F.col("o_orderkey").alias("member_path"))
    return G.batch_ids(take_successes(good, 1250), ["o_orderkey"], 500).select("o_orderkey", "batch")


def xml_text(c: Column) -> Column:
    """A text as XML holds it: escaped, without control characters that XML does not allow."""
    return T.xml_escape(F.regexp_replace(F.coalesce(c, F.lit("")), "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\ufffe\\uffff]", " "))


@query("select 'EP'||doc_id||'A1' as pub_id, source||'-'||floor(doc_id/1000)::bigint||'.zip::DOC/'||case when doc_id%2=1 then 'a.zip::EP'||doc_id||'.xml' else 'b.tgz::EP'||doc_id||'.XML' end as source_id from documents")
def q36_nested_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents zipped twice, or put into a tar in a zip, in one archive per source; then walked."""
    walked = packed(spark, sf_dir).mapInArrow(lambda it: _rows(it, {"doc_only": True, "prefix": "ep"}), DOCUMENTS)
    return N.publications(parse(walked, ["root"]).where("error is null")).select("pub_id", "source_id")


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, content): a zip per source and thousand of document ids, holding a zip and a tar.gz, and members to leave out."""

    def pack(pdf):
        import pandas as pd

        top, inner, tar = io.BytesIO(), io.BytesIO(), io.BytesIO()
        with zipfile.ZipFile(inner, "w") as z, tarfile.open(fileobj=tar, mode="w:gz") as t:
            for i in pdf["doc_id"]:
                xml = f'<ep-patent-document country="EP" doc-number="{i}" kind="A1"/>'.encode()
                if i % 2:
                    z.writestr(f"EP{i}.xml", xml)
                else:
                    info = tarfile.TarInfo(f"EP{i}.XML")
                    info.size = len(xml)
                    t.addfile(info, io.BytesIO(xml))
        with zipfile.ZipFile(top, "w") as z:
            z.writestr("DOC/a.zip", inner.getvalue())
            z.writestr("DOC/b.tgz", tar.getvalue())
            z.writestr("DOC/notes.txt", b"-")
            z.writestr("INDEX/x.xml", b"<x/>")
        return pd.DataFrame({"path": [f"/in/{pdf['source'].iloc[0]}-{pdf['part'].iloc[0]}.zip"], "content": [top.getvalue()]})

    docs = table(spark, sf_dir, "documents").select("source", "doc_id")
    return docs.withColumn("part", F.floor(F.col("doc_id") / 1000)).groupBy("source", "part").applyInPandas(pack, "path string, content binary")


@query("select source||'-'||floor(doc_id/1000)::bigint||'.zip' as archive, 'DOC/'||case when doc_id%2=1 then 'a.zip::EP'||doc_id||'.xml' else 'b.tgz::EP'||doc_id||'.XML' end as member, 58+length(doc_id::varchar) as size from documents")
def q37_filtered_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archives of q36 filtered to their wanted XML files; then everything that is left in them is listed with its size."""

    def filtered(batches):
        for b in batches:
            paths, bodies = b.column(0), [filtered_archive(c, p) for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.record_batch([paths, pa.array(bodies, pa.binary())], names=["path", "content"])

    left = packed(spark, sf_dir).mapInArrow(filtered, "path string, content binary").mapInArrow(lambda it: _rows(it, {"doc_only": False, "prefix": ""}), DOCUMENTS)
    return left.select("archive", F.array_join(F.slice("member_path", 2, 9), "::").alias("member"), F.octet_length("xml").cast("bigint").alias("size"))


@query(
    "select case when page_id%7=0 then '__invalid_source_id__:source_id is empty/blank (expected a non-empty string)' else page_id::varchar end as source_id, 'failed' as status, md5(substr(html,1,2000)) as error, length(substr(html,1,2000)) as error_length, "
    "case when page_id%3<>0 then 'at '||url end as context from pages"
)
def q38_failure_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures with long errors, blank ids and blank contexts, as the status log keeps them."""
    p = table(spark, sf_dir, "pages")
    rows = p.select(F.when(F.col("page_id") % 7 == 0, F.lit(" \u00a0\t")).otherwise(F.concat(F.lit(" "), F.col("page_id").cast("string"))).alias("source_id"), F.col("html").alias("error"), F.when(F.col("page_id") % 3 == 0, F.lit(" \n")).otherwise(F.concat(F.lit("  at "), "url", F.lit(" "))).alias("c"))
    out = S.failed_rows(rows, F.col("c"))
    return out.select("source_id", "status", F.md5(F.encode("error", "UTF-8")).alias("error"), F.length("error").cast("bigint").alias("error_length"), "context")


@query("select event_id, user_id from events where event_type='view' or event_id%5=0")
def q39_invalid_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    ident = F.when(F.col("event_type") == "view", F.lit("")).when(F.col("event_id") % 5 == 0, F.lit("\u2003 \n")).otherwise(F.col("user_id").cast("string"))
    return S.invalid_source_ids(e.withColumn("source_id", ident)).select("event_id", "user_id")


@query("select distinct o_custkey::varchar as source_id from orders where o_custkey not in (select user_id from events)")
def q40_ids_to_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An insert-or-ignore list: ids that come with orders and are not among those known from events."""
    known = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("source_id"))
    return S.add_ids(known, table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("source_id")))


@query("select distinct c_custkey::varchar as source_id from customer union select distinct o_custkey::varchar from orders")
def q41_id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text list of ids, one per line, appended to twice; written and read again."""
    path = f"{TB.shared_folder(spark)}/gneiss-ids-{uuid.uuid4().hex[:12]}"
    for name, column in (("customer", "c_custkey"), ("orders", "o_custkey")):
        ids = table(spark, sf_dir, name).select(F.concat(F.lit(" "), F.col(column).cast("string"), F.lit("  ")).alias("source_id"))
        TB.append_ids(ids.unionByName(spark.range(1).select(F.lit(" ").alias("source_id"))), path)
    # the list itself, not only its distinct ids: none was added twice
    return spark.read.text(path).select(F.col("value").alias("source_id"))


@query(f"select 'publication' as part, pub_id as id, day as a, source_id from {_ORDERS} union all select 'application', appln_id, case when o_orderkey%3=0 then '' else day end, source_id from {_ORDERS} union all select 'applicant', c_name, case when o_custkey%2=0 then 'ID'||o_custkey else '' end, source_id from {_ORDERS} union all select 'citation', null, null, null where false")
def q42_csv_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node tables written to their CSV files, nulls as blanks, and read again."""
    folder = f"{TB.shared_folder(spark)}/gneiss-csv-{uuid.uuid4().hex[:12]}"
    parsed = set_aside(parse(patents(spark, sf_dir, codes=False)), "csv")
    TB.write_node_tables(N.node_tables(parsed), folder)
    t = TB.read_node_tables(spark, folder)
    picks = (("publication", "pub_id", "publication_date"), ("application", "appln_id", "gazette_date"), ("applicant", "applicant_name", "applicant_epo_id"), ("citation", "from_pub_id", "to_pub_id"))
    return reduce(DataFrame.unionByName, [t[n].select(F.lit(n).alias("part"), F.col(a).alias("id"), F.col(b).alias("a"), "source_id") for n, a, b in picks])


@query(
    "with e as (select 'f'||user_id as filename, event_type as status, event_id::varchar as raw_size, row_number() over (partition by user_id order by event_id desc) as n from events), c as (select distinct 'f'||c_custkey as filename from customer) "
    "select coalesce(c.filename,e.filename) as filename, case when c.filename is not null then 'moved' else e.status end as status, case when c.filename is not null then '' else e.raw_size end as raw_size, row_number() over (order by coalesce(c.filename,e.filename)) - 1 as row from c full join (select * from e where n=1) e on c.filename=e.filename"
)
def q43_manifest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of events, rows of which customers replace as a whole; written sorted by name and read again."""
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("f"), F.col("user_id").cast("string")).alias("filename"), F.col("event_type").alias("status"), F.col("event_id").cast("string").alias("raw_size"), F.col("event_id").alias("row"))
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("f"), F.col("c_custkey").cast("string")).alias("filename"), F.lit("moved").alias("status"), F.lit(0).alias("row"))
    path = f"{TB.shared_folder(spark)}/gneiss-manifest-{uuid.uuid4().hex[:12]}"
    TB.write_manifest(S.manifest_rows(e, ["row"]), path)
    TB.write_manifest(S.set_manifest(TB.read_manifest(spark, path).drop("row"), S.manifest_rows(c, ["row"])), path)
    return TB.read_manifest(spark, path).select("filename", "status", "raw_size", "row")


@query("select event_id, 'https://h/p/7/delivery/'||event_id||'/file/'||user_id||'/download' as url, array_to_string(list_filter(['de', event_type, case when event_id%2=0 then 'x' end], lambda x: x is not null), '+') as items from events")
def q44_urls_and_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id").cast("string")
    listed = F.concat(F.lit(" de ,,"), "event_type", F.lit(" , \t,"), F.when(F.col("event_id") % 2 == 0, F.lit("x")).otherwise(F.lit("")))
    return table(spark, sf_dir, "events").select("event_id", T.download_url(metadata_url("https://h/p/", 7), e, F.col("user_id").cast("string")).alias("url"), F.array_join(T.csv_list(listed), "+").alias("items"))


@query(
    r"""select 'EP'||doc_id||'A1' as pub_id, lang, 'AP'||doc_id as appln_id, md5('Summary: '||body) as abstract, md5('Heading '||body||' end'||chr(10)||chr(10)||'last') as description, md5('1. '||body||chr(10)||chr(10)||'also '||body) as claims, md5('[{"id":"c1","num":"1","text":'||to_json(body)||'},{"id":"","num":"","text":'||to_json('also '||body)||'}]') as json """
    r"from (select *, trim(regexp_replace(regexp_replace(coalesce(text,''),'[\x00-\x08\x0b\x0c\x0e-\x1f\x{fffe}\x{ffff}]',' ','g'),'\s+',' ','g')) as body from documents) where body<>''"
)
def q45_fulltext_of_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as XML with mixed content, nested elements and comments, parsed and taken apart into full text."""
    d = table(spark, sf_dir, "documents")
    t, i = xml_text(F.col("text")), F.col("doc_id").cast("string")
    xml = F.concat(
        F.lit('<ep-patent-document country="EP" kind="A1" doc-number="'), i, F.lit('" id="AP'), i, F.lit('"><abstract lang="xx"><p>no</p></abstract><abstract lang="'), "lang", F.lit('"><p>Summary:<!-- no --> <b>'), t, F.lit("</b></p></abstract><description><p>Heading\n<i>"), t,
        F.lit("</i> end</p><p>  </p><section><p>nested</p></section><p>last</p></description><claims lang=\""), "lang", F.lit('"><claim id="c1" num="1">'), t, F.lit('</claim><claim num="2"> </claim></claims><claims lang="'), "lang", F.lit('"><claim>also <claim-text>'), t, F.lit("</claim-text></claim></claims></ep-patent-document>"),
    )
    parsed = parse(d.where(T.collapse(xml_text(F.col("text"))) != "").select(i.alias("source_id"), F.encode(xml, "UTF-8").alias("xml"), "lang"), ["root", "abstracts", "description", "claims"])
    langs = sorted(r[0] for r in d.select("lang").distinct().collect())

    def digest(c: str, name: str) -> Column:
        return F.md5(F.encode(c, "UTF-8")).alias(name)

    rows = FT.fulltext(parsed, langs).where("claims_text is not null")  # the description stands for every language
    return rows.select("pub_id", "lang", "appln_id", digest("abstract_text", "abstract"), digest("description_text", "description"), digest("claims_text", "claims"), digest("claims_json", "json"))


_VERTEX_COUNTS = {
    "Publication": f"select count(distinct pub_id) from {_ORDERS}",
    "Application": f"select count(distinct appln_id) from {_ORDERS}",
    "SourceFile": f"select count(*) from {_ORDERS}",
    "Applicant": f"select count(distinct o_custkey) from {_ORDERS}",
    "Inventor": f"select count(distinct o_custkey) from {_ORDERS} where o_orderkey%2=0",
    "Attorney": f"select count(distinct o_custkey) from {_ORDERS} where o_orderkey%2=0",
}


@query(" union all ".join(f"select '{k}' as kind, ({v}) as n" for k, v in {**_VERTEX_COUNTS, **{r: _MERGED[r] for r in ("FROM_SOURCE", "HAS_PUBLICATION", "OF_APPLICATION", "APPLIES_FOR", "INVENTED", "REPRESENTS")}, "done": f"select count(*) from {_ORDERS}"}.items()))
def q46_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in an initial run over those of one order status and a weekly run over all: tables, status, bulk and
    incremental merges on disk; then the graph is counted. The second run takes only what the first did not."""
    from gneiss.plans.pipelines import Config, graph_edges, graph_vertices, run, status_table

    cfg = Config(f"{TB.shared_folder(spark)}/gneiss-run-{uuid.uuid4().hex[:12]}", buckets=8)
    docs = set_aside(patents(spark, sf_dir, codes=False).withColumn("member_path", F.split("source_id", "::")), "docs")
    run(spark, docs.where(F.col("xml").contains('kind="A1"')), cfg, "initial", 0, stages=("graph", "load"))
    run(spark, docs, cfg, "weekly", 1, stages=("graph", "load"))
    counted = [graph_vertices(spark, cfg, t).select(F.lit(label).alias("kind")) for t, (label, _) in VERTICES.items()]
    counted += [graph_edges(spark, cfg).select(F.col("rel_type").alias("kind")), status_table(spark, cfg).select(F.col("status").alias("kind"))]
    return reduce(DataFrame.unionByName, counted).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events) where n=1")
def q47_stream_of_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last write of every user, of events that come as a file stream: each batch is set over a bucketed table."""
    folder = f"{TB.shared_folder(spark)}/gneiss-stream-{uuid.uuid4().hex[:12]}"
    events = table(spark, sf_dir, "events")
    wanted = events.select("user_id", "event_id", "event_type", "value", "ts").schema

    def later(old: DataFrame, new: DataFrame) -> DataFrame:
        return G.last_rows(old.unionByName(new), "user_id", ["ts", "event_id"]).select(*wanted.names)

    def one(batch: DataFrame, batch_id: int) -> None:
        TB.merge_buckets(batch.sparkSession, f"{folder}/last", wanted, ["user_id"], later(batch.limit(0), batch), later, 8)

    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]").select(*wanted.names)
    stream.writeStream.foreachBatch(one).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return TB.read_parquet(spark, f"{folder}/last", wanted).select("user_id", "event_id", "event_type", "value")


@query("select event_id, 'file:/raw/'||event_type||'-'||event_id||'.zip' as raw, '/staging/'||event_type||'-'||event_id||'.zip' as staging, '/final/'||event_type||'-'||event_id||'.zip' as final, case when event_type not in ('moved','failed','empty','skipped') then event_type end as unknown_state from events")
def q48_artifact_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where an archive's artifacts lie in each step, and states that no archive can have."""
    e = table(spark, sf_dir, "events").withColumn("status", F.col("event_type"))
    raw, staging, final = I.paths("file:/raw/", "/staging", "/final//", F.concat("event_type", F.lit("-"), F.col("event_id").cast("string"), F.lit(".zip")))
    odd = S.unknown_states(e).select(F.col("event_id").alias("odd_id"), F.col("status").alias("unknown_state"))
    rows = e.select("event_id", raw.alias("raw"), staging.alias("staging"), final.alias("final"))
    return rows.join(odd, rows["event_id"] == odd["odd_id"], "left").drop("odd_id")
