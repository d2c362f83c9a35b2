"""Binds the tender data model to the order, line-item, event, document and page tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adjudika.functions import build_detail_url, money, normalize_statut, normalize_type_marche
from adjudika.sources.readers import archived_pages

_S, _L, _I, _DBL, _NTZ = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType()

SCHEMAS = {
    "nation": {"n_nationkey": _I, "n_name": _S, "n_regionkey": _I},
    "customer": {"c_custkey": _L, "c_name": _S, "c_nationkey": _I, "c_acctbal": _DBL, "c_mktsegment": _S},
    "supplier": {"s_suppkey": _L, "s_name": _S, "s_nationkey": _I, "s_acctbal": _DBL},
    "part": {"p_partkey": _L, "p_name": _S, "p_brand": _S, "p_type": _S, "p_size": _I, "p_retailprice": _DBL},
    "orders": {"o_orderkey": _L, "o_custkey": _L, "o_orderstatus": _S, "o_totalprice": _DBL, "o_orderdate": _NTZ,
               "o_orderpriority": _S},
    "lineitem": {"l_orderkey": _L, "l_partkey": _L, "l_suppkey": _L, "l_linenumber": _I, "l_quantity": _DBL,
                 "l_extendedprice": _DBL, "l_discount": _DBL, "l_tax": _DBL, "l_returnflag": _S, "l_linestatus": _S,
                 "l_shipdate": _NTZ},
    "events": {"event_id": _L, "ts": _NTZ, "user_id": _L, "event_type": _S, "value": _DBL, "props": _S},
    "documents": {"doc_id": _L, "text": _S, "lang": _S, "source": _S, "n_chars": _L},
}


def schema_of(name: str) -> T.StructType:
    return T.StructType([T.StructField(c, t, True) for c, t in SCHEMAS[name].items()])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(schema_of(name)).parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(spark, f"{sf_dir}/pages.parquet")


def ref_of(key: Column) -> Column:
    return F.concat(F.lit("AO-"), key.cast("string"))


def type_label(priority: Column) -> Column:
    """Raw contract-type label of a tender; the last one is outside the enum on purpose."""
    labels = {"1": "Travaux", "2": "Fournitures", "3": "Services", "4": "Études"}
    digit = F.substring(priority, 1, 1)
    return F.coalesce(*(F.when(digit == d, F.lit(label)) for d, label in labels.items()), F.lit("Autre"))


def status_label(status: Column) -> Column:
    return F.when(status == "O", "En cours").when(status == "F", "Clôturé").otherwise("Annulé")


def _days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


def _core_columns() -> dict[str, Column]:
    key = F.col("o_orderkey")
    ref = ref_of(key)
    return {
        "ref_consultation": ref,
        "objet": F.concat_ws(" / ", "o_orderpriority", F.lit("lot unique")),
        "type_marche": normalize_type_marche(type_label(F.col("o_orderpriority"))),
        "date_publication": F.col("o_orderdate"),
        "date_limite": F.when(key % 7 != 0, F.col("o_orderdate") + _days(30)),
        "statut": normalize_statut(status_label(F.col("o_orderstatus"))),
        "montant_estime": F.when(key % 11 != 0, money(F.col("o_totalprice"))),
        "url_detail": F.when(key % 10 == 7, F.lit("")).when(
            key % 10 != 3, build_detail_url(key.cast("string"), F.lit("org"))),
        "date_extraction": F.col("o_orderdate") + _days(1),
    }


def consultations_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenders without their body: no join, for reports that need none."""
    return read(spark, sf_dir, "orders").select(*(c.alias(n) for n, c in _core_columns().items()))


def consultations(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Tenders with the public body. The planner picks the join by measured size; nothing is hinted. ``orders`` may be
    a micro-batch of the table."""
    orders = read(spark, sf_dir, "orders") if orders is None else orders
    customer, nation = (read(spark, sf_dir, t) for t in ("customer", "nation"))
    joined = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    columns = {
        **_core_columns(),
        "organisme_acronyme": F.col("n_name"),
        "organisme_nom_complet": F.col("c_name"),
        "organisme_ville": F.lower("c_mktsegment"),
        "secteur": F.col("c_mktsegment"),
        "titre": F.concat(F.lit("Marche "), "c_mktsegment", F.lit(" no "), F.col("o_orderkey").cast("string")),
        "organisme_telephone": F.lit(None).cast("string"),
        "organisme_email": F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.org")),
        "cautionnement_provisoire": money(F.lit(None)),
        "code_cpv": F.substring("o_orderpriority", 1, 1),
        "url_avis": F.lit(None).cast("string"),
        "url_dce": F.lit(None).cast("string"),
    }
    return joined.select(*(c.alias(n) for n, c in columns.items()))


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "part")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        ref_of(F.col("l_orderkey")).alias("ref_consultation"),
        F.col("l_linenumber").cast("string").alias("numero_lot"),
        F.col("p_name").alias("designation"),
        money(F.col("l_extendedprice")).alias("montant_estime"),
        (F.col("l_shipdate") + _days(1)).alias("date_extraction"),
    )


def attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, supplier, nation = (read(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    return (
        line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            ref_of(F.col("l_orderkey")).alias("ref_consultation"),
            F.concat(F.lit("ORG-"), (F.col("l_partkey") % 25).cast("string")).alias("organisme_acronyme"),
            F.col("l_shipdate").cast("date").alias("date_attribution"),
            F.col("s_name").alias("entreprise_nom"),
            F.lit(None).cast("string").alias("entreprise_ice"),
            F.col("n_name").alias("entreprise_ville"),
            money(F.col("l_extendedprice")).alias("montant_ttc"),
            money(F.col("l_extendedprice")).alias("_brut"),
            F.col("l_discount").cast("decimal(5,2)").alias("_remise"),
            F.col("l_linenumber").cast("string").alias("numero_lot"),
            F.lit("").alias("url_resultat"),
            (F.col("l_shipdate") + _days(1)).alias("date_extraction"),
        )
        .withColumn("montant_ht", (F.col("_brut") * (F.lit(1).cast("decimal(5,2)") - F.col("_remise")))
                    .cast("decimal(15,2)"))
        .withColumn("taux_rabais", (F.col("_remise") * 100).cast("decimal(5,2)"))
        .drop("_brut", "_remise")
    )


def pv_extraits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        ref_of(F.col("l_orderkey")).alias("ref_consultation"),
        F.concat(F.lit("ORG-"), (F.col("l_partkey") % 25).cast("string")).alias("organisme_acronyme"),
        F.concat("l_returnflag", "l_linestatus").alias("type_pv"),
        (F.col("l_shipdate") - _days(7)).alias("date_seance"),
        F.col("l_shipdate").alias("date_publication_pv"),
        F.lit(None).cast("string").alias("contenu"),
        F.col("l_quantity").cast("int").alias("nombre_soumissionnaires"),
        F.concat(F.lit("pv/"), F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string"))
        .alias("url_pv"),
        (F.col("l_shipdate") + _days(1)).alias("date_extraction"),
    )


def achevements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == "F").select(
        ref_of(F.col("l_orderkey")).alias("ref_consultation"),
        F.concat(F.lit("ORG-"), (F.col("l_partkey") % 25).cast("string")).alias("organisme_acronyme"),
        F.date_add(F.col("l_shipdate").cast("date"), 90).alias("date_achevement"),
        F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")).alias("entreprise_nom"),
        money(F.col("l_extendedprice")).alias("montant_definitif"),
        (F.col("l_shipdate") + _days(91)).alias("date_extraction"),
    )


def text_tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as tenders: the source is the title, the text the subject."""
    return read(spark, sf_dir, "documents").select(
        F.concat(F.lit("DOC-"), F.col("doc_id").cast("string")).alias("ref_consultation"),
        F.upper("lang").alias("organisme_acronyme"),
        F.concat(F.lit("Document "), "source").alias("titre"),
        F.col("text").alias("objet"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval((F.col("doc_id") % 365).cast("int"))).alias("date_publication"),
    )


# Which run counter an event feeds.
EVENT_METRICS = {
    "error": ("spider_errors_total",),
    "view": ("pages_scraped_total", "responses_total"),
    "purchase": ("items_scraped_total",),
    "signup": ("spider_started_total",),
    "click": ("spider_closed_total", "requests_total"),
}


def spider_of(user: Column) -> Column:
    return F.concat(F.lit("spider_"), (user % 5).cast("string"))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric events ``(ts, spider, metric, label, value)``, one row per counter that an event increments."""
    return metrics_of(read(spark, sf_dir, "events"))


def metrics_of(events: DataFrame) -> DataFrame:
    """The metric events of the given events, which may be a stream."""
    names = F.coalesce(*(
        F.when(F.col("event_type") == kind, F.array(*(F.lit(m) for m in names)))
        for kind, names in EVENT_METRICS.items()
    ))
    draw = F.get_json_object("props", "$.k").try_cast("bigint")
    status = F.when(draw % 5 == 0, F.lit("429")).otherwise(F.lit("200"))
    item_type = F.when(F.col("event_id") % 3 == 0, F.lit("lot")).otherwise(F.lit("consultation"))
    return events.select("ts", spider_of(F.col("user_id")).alias("spider"), F.explode(names).alias("metric"),
                         status.alias("_status"), item_type.alias("_item")).select(
        "ts", "spider", "metric",
        F.when(F.col("metric") == "responses_total", F.col("_status"))
        .when(F.col("metric") == "items_scraped_total", F.col("_item"))
        .when(F.col("metric") == "spider_closed_total", F.lit("finished"))
        .alias("label"),
        F.lit(1.0).alias("value"),
    )


def extraction_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run-log row per event."""
    kind = F.col("event_type")
    return read(spark, sf_dir, "events").select(
        F.col("ts").alias("date_execution"),
        spider_of(F.col("user_id")).alias("spider_name"),
        F.when(kind == "error", "failed").otherwise("success").alias("statut"),
        F.when(kind == "view", 1).otherwise(0).cast("bigint").alias("pages_parcourues"),
        F.floor("value").cast("bigint").alias("items_extraits"),
        F.when(kind == "error", 1).otherwise(0).cast("bigint").alias("erreurs"),
    )
