"""Exports written and read back, and the line-record reader."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adjudika.catalog import bindings_sql as B
from adjudika.catalog.registry import query
from adjudika.operators.dedup import new_records
from adjudika.plans import reports as R
from adjudika.plans.listings import filter_tenders
from adjudika.session import work_dir
from adjudika.sinks import archive, exports
from adjudika.sources import driver_tables as D
from adjudika.sinks.keys import KeyTable
from adjudika.sources import jsonl_records, stored_keys

_CSV_SQL = """ref_consultation, titre, organisme_acronyme, type_marche, statut,
  strftime(date_publication, '%Y-%m-%dT%H:%M:%S') AS date_publication,
  coalesce(strftime(date_limite, '%Y-%m-%dT%H:%M:%S'), '') AS date_limite,
  coalesce(CAST(CASE WHEN montant_estime <> 0 THEN montant_estime END AS VARCHAR), '') AS montant_estime"""


def _csv_back(spark, path, names):
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    back = spark.read.schema(schema).options(**exports.CSV, multiLine="true").csv(path)
    return back.select(*(F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names))


@query("exp_csv", B.with_tables(f"""
SELECT {_CSV_SQL} FROM consultations WHERE statut = 'en_cours' AND date_publication >= TIMESTAMP '1996-01-01'
ORDER BY consultations.date_publication DESC, ref_consultation LIMIT 10000""", B.CONSULTATIONS))
def exp_csv(spark, sf_dir):
    path = f"{work_dir(spark, 'csv')}/out"
    exports.tenders_csv(filter_tenders(D.consultations(spark, sf_dir), statut="en_cours", date_debut="1996-01-01"), path)
    return _csv_back(spark, path, exports.FULL_HEADERS)


@query("exp_csv_capped", B.with_tables(f"""
SELECT {_CSV_SQL} FROM consultations ORDER BY consultations.date_publication DESC, ref_consultation LIMIT 10000""", B.CONSULTATIONS))
def exp_csv_capped(spark, sf_dir):
    """All tenders: more than an export takes."""
    path = f"{work_dir(spark, 'csv')}/out"
    exports.tenders_csv(filter_tenders(D.consultations(spark, sf_dir), statut=None), path)
    return _csv_back(spark, path, exports.FULL_HEADERS)


@query("exp_full_csv", B.with_tables(f"SELECT {_CSV_SQL} FROM consultations", B.CONSULTATIONS))
def exp_full_csv(spark, sf_dir):
    path = f"{work_dir(spark, 'fullcsv')}/out"
    exports.full_csv(D.consultations(spark, sf_dir), path)
    back = _csv_back(spark, path, exports.FULL_HEADERS.values())
    return back.select(*(F.col(f"`{h}`").alias(c) for c, h in exports.FULL_HEADERS.items()))


@query("exp_json", B.with_tables("""
SELECT ref_consultation, organisme_acronyme AS organisme, entreprise_nom AS entreprise,
  CASE WHEN montant_ttc <> 0 THEN CAST(montant_ttc AS DOUBLE) END AS montant_ttc,
  strftime(date_attribution, '%Y-%m-%d') AS date_attribution FROM attributions""", B.ATTRIBUTIONS))
def exp_json(spark, sf_dir):
    path = f"{work_dir(spark, 'json')}/out"
    exports.awards_json(D.attributions(spark, sf_dir), path)
    return spark.read.schema(
        "ref_consultation string, organisme string, entreprise string, montant_ttc double, date_attribution string").json(path)


@query("src_jsonl", """
SELECT 'r' || o_orderkey AS id, o_orderpriority AS objet FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0""")
def src_jsonl(spark, sf_dir):
    """Lines of which some are blank and some cut off."""
    path, key = f"{work_dir(spark, 'jsonl')}/out", F.col("o_orderkey")
    full = F.to_json(F.struct(F.concat(F.lit("r"), key.cast("string")).alias("id"), F.col("o_orderpriority").alias("objet")))
    line = F.when(key % 5 == 0, "").when(key % 7 == 0, F.substring(full, 1, 9)).otherwise(full)
    D.read(spark, sf_dir, "orders").select(line).write.text(path)
    return jsonl_records(spark, path).select("id", "objet")


@query("exp_jsonl_append", """
SELECT 'r' || (o_orderkey // 2) AS id, min(o_orderkey) AS premier FROM orders GROUP BY 1""")
def exp_jsonl_append(spark, sf_dir):
    """Two runs append their new records; the second finds most ids stored."""
    path = f"{work_dir(spark, 'records')}/out"
    records = D.read(spark, sf_dir, "orders").select(
        F.concat(F.lit("r"), F.floor(F.col("o_orderkey") / 2).cast("string")).alias("id"), F.col("o_orderkey").alias("premier"))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("premier", T.LongType())])
    early = records.filter(F.floor(F.col("premier") / 2) % 3 == 0)
    exports.jsonl_append(new_records(early, spark.createDataFrame([], "id string"), ["premier"]), path, overwrite=True)
    stored = stored_keys(jsonl_records(spark, path, schema), "id")
    exports.jsonl_append(new_records(records, stored, ["premier"]), path)
    return jsonl_records(spark, path, schema)


@query("exp_jsonl_keys", """
SELECT 'r' || (o_orderkey // 2) AS id, min(o_orderkey) AS premier FROM orders GROUP BY 1""")
def exp_jsonl_keys(spark, sf_dir):
    """Three runs append their new records; which ids are there is looked up by hash prefix, not read from the output."""
    root = work_dir(spark, "records")
    key = F.col("o_orderkey")
    records = D.read(spark, sf_dir, "orders").select(F.concat(F.lit("r"), F.floor(key / 2).cast("string")).alias("id"), key.alias("premier"))
    keys = KeyTable(spark, f"{root}/keys", "id", "id string", prefixes=16)
    for chosen in ("premier div 2 % 3 = 0", "premier div 2 % 3 <= 1", "true"):
        exports.jsonl_append_new(records.filter(chosen), f"{root}/out", keys, ["premier"])
    return jsonl_records(spark, f"{root}/out", T.StructType([T.StructField("id", T.StringType()), T.StructField("premier", T.LongType())]))


@query("exp_overwrite", """
SELECT 'r' || o_orderkey AS id, o_orderkey % 3 AS lot FROM orders WHERE o_orderkey % 3 <> 0""")
def exp_overwrite(spark, sf_dir):
    """A full output, one that replaces it, and one that is added to that."""
    path = f"{work_dir(spark, 'overwrite')}/out"
    key = F.col("o_orderkey")
    records = D.read(spark, sf_dir, "orders").select(F.concat(F.lit("r"), key.cast("string")).alias("id"), (key % 3).alias("lot"))
    for chosen, overwrite in (("true", False), ("lot = 1", True), ("lot = 2", False)):
        exports.jsonl_append(records.filter(chosen), path, overwrite)
    return jsonl_records(spark, path, T.StructType([T.StructField("id", T.StringType()), T.StructField("lot", T.LongType())]))


@query("exp_feed", "SELECT count(*) AS n, true AS ecrit, false AS vide_ecrit FROM orders")
def exp_feed(spark, sf_dir):
    path = work_dir(spark, "feed")
    orders = D.read(spark, sf_dir, "orders").select("o_orderkey")
    written = exports.json_feed(orders, f"{path}/feed")
    empty = exports.json_feed(orders.filter(F.lit(False)), f"{path}/empty")
    exports.json_feed_replacing(orders, f"{path}/manual")
    return spark.read.schema("o_orderkey bigint").json(f"{path}/manual").agg(
        F.count(F.lit(1)).alias("n"), F.lit(written).alias("ecrit"), F.lit(empty).alias("vide_ecrit"))


@query("exp_archive", """
SELECT min(ref) || '_20250101_000000_' || substr(md5(html), 1, 8) || '.html' AS file_name, md5(html) AS content_md5,
  CAST(2 * count(*) AS BIGINT) AS copies, CAST(length(html) AS BIGINT) AS taille FROM (SELECT 'P-' || page_id AS ref, html FROM pages)
GROUP BY html""")
def exp_archive(spark, sf_dir):
    """Every page is offered twice and archived once."""
    path, stamp = f"{work_dir(spark, 'archive')}/out", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    pages = D.pages(spark, sf_dir).select(F.concat(F.lit("P-"), F.col("page_id").cast("string")).alias("ref_consultation"), "html")
    archive.write_archive(pages.unionAll(pages), path, stamp)
    back = spark.read.schema("file_name string, content_md5 string, copies bigint, html string, archive_date date").parquet(path)
    return back.select("file_name", "content_md5", "copies", F.length("html").cast("bigint").alias("taille"))


@query("exp_bundle", B.with_tables("""
SELECT (SELECT count(*) FROM consultations) AS total_consultations, (SELECT count(*) FROM pv_extraits) AS total_pv,
  (SELECT count(*) FROM runs WHERE statut = 'failed') AS total_erreurs, (SELECT count(*) FROM consultations) AS lignes
""", B.CONSULTATIONS_CORE, B.PV, B.RUNS))
def exp_bundle(spark, sf_dir):
    path = work_dir(spark, "bundle")
    tenders, minutes = D.consultations_core(spark, sf_dir), D.pv_extraits(spark, sf_dir)
    errors = D.extraction_logs(spark, sf_dir).filter(F.col("statut") == "failed")
    summary = R.run_summary(tenders, minutes, errors, "2024-01-01 00:00:00", "2024-01-01 00:01:30")
    exports.run_bundle(path, summary, consultations=tenders, pv_extraits=minutes, errors=errors)
    names = ("total_consultations", "total_pv", "total_erreurs")
    rows = spark.read.schema("ref_consultation string").json(f"{path}/consultations").agg(F.count(F.lit(1)).alias("lignes"))
    back = spark.read.schema(", ".join(f"{n} bigint" for n in names)).json(f"{path}/summary")
    both = back.unionByName(rows, allowMissingColumns=True)
    return both.agg(*(F.max(n).alias(n) for n in (*names, "lignes")))
