"""Patent-shaped XML made of the driver's tables, so that everything behind the parser has an SQL oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.functions.text import xml_escape


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def element(name: str, *parts) -> Column:
    return F.concat(F.lit(f"<{name}>"), *parts, F.lit(f"</{name}>"))


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: what its document says."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return spread(o).join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])


def spread(rows: DataFrame) -> DataFrame:
    """Narrow rows over all cores if their few files would leave cores idle in the parser behind."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(2 * cores)


def patents(spark: SparkSession, sf_dir: str, *, codes: bool = True) -> DataFrame:
    """(source_id, xml): a document per order; its customer applies, every other order names an inventor and an attorney,
    every third has no gazette section, its line items give the classifications."""
    rows = order_facts(spark, sf_dir)
    if codes:
        li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
        ipc = element("classification-ipcr", element("text", xml_escape(F.concat("p_brand", F.lit("  "), "p_type", F.lit("   "), F.col("p_size").cast("string")))))
        cpc = element("classification-cpc", element("text", xml_escape(F.concat_ws(" ", "p_brand", "p_type", F.when(F.col("l_linenumber") % 2 == 0, F.col("p_size").cast("string")), F.when(F.col("l_linenumber") % 4 == 0, F.lit("X"))))))
        lines = li.join(p, li["l_partkey"] == p["p_partkey"]).groupBy("l_orderkey").agg(F.array_join(F.collect_list(ipc), "").alias("ipcs"), F.array_join(F.collect_list(cpc), "").alias("cpcs"))
        rows = rows.join(lines, rows["o_orderkey"] == lines["l_orderkey"], "left")
        if lines.sparkSession.sparkContext.defaultParallelism > li.rdd.getNumPartitions():
            rows = rows.repartition(2 * lines.sparkSession.sparkContext.defaultParallelism)
    else:
        rows = rows.withColumns({"ipcs": F.lit(""), "cpcs": F.lit("")})
    key = F.col("o_orderkey").cast("string")
    party = F.concat(element("snm", F.lit("  "), xml_escape(F.col("c_name")), F.lit(" ")), F.when(F.col("o_custkey") % 2 == 0, element("iid", F.concat(F.lit("ID"), F.col("o_custkey").cast("string")))).otherwise(F.lit("")), element("adr", element("city", F.concat(F.lit("City "), F.col("c_nationkey").cast("string"))), element("ctry", xml_escape(F.col("n_name")))))
    half = F.col("o_orderkey") % 2 == 0
    gazette = F.when(F.col("o_orderkey") % 3 != 0, element("B400", element("B405", element("date", F.date_format("o_orderdate", "yyyyMMdd")), element("bnum", F.col("o_custkey").cast("string"))))).otherwise(F.lit(""))
    xml = F.concat(
        F.lit('<ep-patent-document country="EP" lang="en" kind="'), kind(), F.lit('" doc-number="'), F.lpad(key, 9, "0"), F.lit('" date-publ="'), F.date_format("o_orderdate", "yyyyMMdd"), F.lit('" id="'), application(), F.lit('"><SDOBI>'),
        element("B200", element("B220", element("date", F.date_format("o_orderdate", "yyyyMMdd")))), gazette,
        element("B500", element("B510EP", F.coalesce("ipcs", F.lit(""))), element("B520EP", F.coalesce("cpcs", F.lit("")))),
        element("B700", element("B710", element("B711", party)), element("B720", F.when(half, element("B721", party)).otherwise(element("B721", element("snm", F.lit(" "))))), element("B740", F.when(half, element("B741", party)).otherwise(F.lit("")))),
        F.lit("</SDOBI></ep-patent-document>"),
    )
    return rows.select(source_id().alias("source_id"), xml.alias("xml"))


def kind() -> Column:
    return F.when(F.col("o_orderstatus") == "F", "A1").when(F.col("o_orderstatus") == "O", "A2").otherwise("B1")


def application() -> Column:
    return F.concat(F.lit("EP"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"), "o_orderstatus")


def source_id() -> Column:
    return F.concat(F.lit("T"), (F.col("o_orderkey") % 7).cast("string"), F.lit(".zip::DOC/"), F.col("o_orderkey").cast("string"), F.lit(".xml"))
