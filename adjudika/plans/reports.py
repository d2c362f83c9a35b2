"""Aggregate reports. One scan and one partial aggregation per table; money is summed as decimal, cast once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudika.functions import collapse, month_bucket


def _total(column: str) -> Column:
    return F.sum(column).cast("double")


def _mean(column: str) -> Column:
    """Average from the exact decimal sum, so that it does not depend on the order of the rows."""
    return _total(column) / F.count(column)


def monthly_stats(consultations: DataFrame, ordered: bool = False) -> DataFrame:
    out = consultations.groupBy(month_bucket(F.col("date_publication")).alias("mois"), "type_marche", "statut").agg(
        F.count(F.lit(1)).alias("nombre_consultations"),
        _total("montant_estime").alias("montant_total_estime"),
        _mean("montant_estime").alias("montant_moyen_estime"),
    )
    return out.orderBy(F.desc("mois"), "type_marche", "statut") if ordered else out


def top_bodies(consultations: DataFrame, ordered: bool = False) -> DataFrame:
    out = consultations.groupBy("organisme_acronyme", "organisme_nom_complet").agg(
        F.count(F.lit(1)).alias("nombre_consultations"), _total("montant_estime").alias("montant_total_estime"))
    return out.orderBy(F.desc("nombre_consultations"), "organisme_acronyme", "organisme_nom_complet") if ordered \
        else out


def top_n_bodies(consultations: DataFrame, n: int = 20) -> DataFrame:
    """The n most active bodies; names break ties, a missing total reads 0."""
    return (
        top_bodies(consultations)
        .select(
            F.col("organisme_acronyme").alias("acronyme"), F.col("organisme_nom_complet").alias("nom"),
            "nombre_consultations", F.coalesce("montant_total_estime", F.lit(0.0)).alias("montant_total"))
        .orderBy(F.desc("nombre_consultations"), "acronyme", "nom")
        .limit(n)
    )


def top_winners(attributions: DataFrame, ordered: bool = False) -> DataFrame:
    out = attributions.groupBy("entreprise_nom", "entreprise_ville").agg(
        F.count(F.lit(1)).alias("nombre_marches"),
        _total("montant_ttc").alias("montant_total_ttc"),
        _mean("montant_ttc").alias("montant_moyen_ttc"),
    )
    return out.orderBy(F.desc("nombre_marches"), "entreprise_nom", "entreprise_ville") if ordered else out


def global_stats(consultations: DataFrame, attributions: DataFrame, approximate: bool = False) -> DataFrame:
    """Eight scalars in one row: each table is aggregated once, the two one-row results are folded by a union.

    ``approximate`` swaps the exact distinct counts for sketches, which need no exchange of the distinct values.
    """
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    tenders = consultations.agg(
        F.count(F.lit(1)).alias("total_consultations"),
        F.count_if(F.col("statut") == "en_cours").alias("consultations_en_cours"),
        F.coalesce(_total("montant_estime"), F.lit(0.0)).alias("montant_total_estime"),
        distinct("organisme_acronyme").alias("nombre_organismes"),
        F.max("date_extraction").alias("derniere_extraction"),
    )
    awards = attributions.agg(
        F.count(F.lit(1)).alias("total_attributions"),
        F.coalesce(_total("montant_ttc"), F.lit(0.0)).alias("montant_total_attribue"),
        distinct("entreprise_nom").alias("nombre_entreprises"),
    )
    both = tenders.unionByName(awards, allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in (
        "total_consultations", "consultations_en_cours", "total_attributions", "montant_total_estime",
        "montant_total_attribue", "nombre_organismes", "nombre_entreprises", "derniere_extraction")))


def run_totals(recent: DataFrame) -> DataFrame:
    """Items and errors of the recent runs, with the alert flag for "nothing extracted"."""
    items = F.coalesce(F.sum("items_extraits"), F.lit(0))
    return recent.agg(
        items.alias("total_items"),
        F.coalesce(F.sum("erreurs"), F.lit(0)).alias("total_erreurs"),
        (items == 0).alias("alerte_aucun_item"),
    )


def url_coverage(consultations: DataFrame) -> DataFrame:
    """How many tenders carry a detail URL. The SQL-style count takes ``''`` as present, the other does not."""
    counted = consultations.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("url_detail").alias("avec_url_sql"),
        F.count_if(collapse(F.col("url_detail")) != "").alias("avec_url"),
    )

    def percent(column: str) -> Column:
        return F.when(F.col("total") > 0, F.round(F.col(column).cast("double") / F.col("total") * 100, 2))

    verdict = (
        F.when(F.col("total") == 0, "echec")
        .when(F.col("avec_url") == F.col("total"), "excellent")
        .when(F.col("avec_url") > F.col("total") * 0.8, "bon")
        .otherwise("attention")
    )
    return counted.select(
        "total", "avec_url", (F.col("total") - F.col("avec_url")).alias("sans_url"), percent("avec_url").alias("pourcentage"),
        "avec_url_sql", percent("avec_url_sql").alias("pourcentage_sql"), verdict.alias("verdict"))


def without_url(consultations: DataFrame) -> DataFrame:
    """Tenders to look into: no detail URL."""
    return consultations.filter(F.col("url_detail").isNull() | (F.col("url_detail") == "")).select(
        "ref_consultation", "titre", "organisme_acronyme")


def url_samples(consultations: DataFrame, n: int = 10, width: int = 60) -> DataFrame:
    """First n tenders with a URL, by reference, with a short title."""
    return (
        consultations.filter(F.col("url_detail").isNotNull())
        .select("ref_consultation", F.substring("titre", 1, width).alias("titre"), "url_detail")
        .orderBy("ref_consultation").limit(n)
    )


def run_counters(metrics: DataFrame) -> DataFrame:
    """Pages, records and errors per crawler and day: the content of the run log."""
    def counted(metric: str) -> Column:
        return F.sum(F.when(F.col("metric") == metric, F.col("value")).otherwise(0.0)).cast("bigint")

    return metrics.groupBy("spider", F.date_trunc("day", "ts").alias("jour")).agg(
        counted("pages_scraped_total").alias("pages"),
        counted("items_scraped_total").alias("items"),
        counted("spider_errors_total").alias("erreurs"),
        F.min("ts").alias("debut"),
        F.max("ts").alias("fin"),
    )


def run_log(counters: DataFrame) -> DataFrame:
    """Run-log rows from the counters of each run."""
    status = F.when((F.col("erreurs") > 0) & (F.col("items") == 0), "failed").when(F.col("erreurs") > 0, "partial")
    return counters.select(
        F.col("debut").alias("date_execution"), F.col("spider").alias("spider_name"),
        status.otherwise("success").alias("statut"), F.col("pages").alias("pages_parcourues"),
        F.col("items").alias("items_extraits"), F.col("erreurs"),
        F.timestamp_diff("SECOND", F.col("debut"), F.col("fin")).alias("duree_secondes"),
    )


def labelled_counters(metrics: DataFrame) -> DataFrame:
    """Every counter per crawler and label (status, item type or closing reason)."""
    return metrics.groupBy("metric", "spider", F.coalesce("label", F.lit("")).alias("label")).agg(
        F.sum("value").cast("bigint").alias("total"))


def item_counters(labelled: DataFrame) -> DataFrame:
    """Items by type, and how many were kept or dropped for which reason (``_reason`` NULL means kept)."""
    return labelled.groupBy("_type", F.coalesce("_reason", F.lit("saved")).alias("issue")).agg(
        F.count(F.lit(1)).alias("n"))


def run_summary(consultations: DataFrame, minutes: DataFrame, errors: DataFrame, started, finished) -> DataFrame:
    """One-row summary of an extraction run."""
    parts = [
        df.agg(F.count(F.lit(1)).alias(name))
        for df, name in ((consultations, "total_consultations"), (minutes, "total_pv"), (errors, "total_erreurs"))
    ]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in ("total_consultations", "total_pv", "total_erreurs"))).select(
        "*", F.lit(started).cast("timestamp_ntz").alias("debut"),
        F.timestamp_diff("SECOND", F.lit(started).cast("timestamp_ntz"), F.lit(finished).cast("timestamp_ntz"))
        .alias("duree_secondes"))
