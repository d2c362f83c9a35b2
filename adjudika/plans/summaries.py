"""Report figures that the ingest keeps up to date: mergeable partial aggregates instead of scans of the stored tables.

A summary holds, per key, how many rows it has, how many of them an amount, and the exact sum: months by type and status, public bodies,
winners, and the extraction times. Every run adds one small folder with what it changed: its new rows count up, the rows they replace count
down, so sums merge in any order and a row that a run leaves as it is cancels out. Distinct bodies and winners are the keys whose rows do not
sum up to nothing, so they can fall as well as rise; the latest extraction is the largest such time.

A run that broke off may have changed rows without its folder, or the other way round. The store finds it in its ledger and has the summary
rebuilt from the rows before the next run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudika.functions import month_bucket
from adjudika.session import cut_lineage, path_exists

KEYS = ["sorte", "k1", "k2", "k3"]
SCHEMA = "sorte string, k1 string, k2 string, k3 string, n bigint, avec_montant bigint, montant decimal(38,2)"
MONTH, BODY, WINNER, EXTRACTION = "mois", "organisme", "entreprise", "extraction"


def _text(c: Column) -> Column:
    return c.cast("string")


#: What ``parts`` reads of a table's rows.
READ = {"consultation": ["montant_estime", "date_publication", "type_marche", "statut", "organisme_acronyme", "organisme_nom_complet", "date_extraction"],
        "attribution": ["montant_ttc", "entreprise_nom", "entreprise_ville"]}


def parts(rows: DataFrame, kind: str, sign: int = 1) -> DataFrame:
    """What the rows of a table add to the summary, or take from it."""
    none = F.lit(None).cast("string")
    if kind == "consultation":
        amount = F.col("montant_estime")
        keys = [(MONTH, _text(month_bucket(F.col("date_publication"))), F.col("type_marche"), F.col("statut")),
                (BODY, F.col("organisme_acronyme"), F.col("organisme_nom_complet"), none), (EXTRACTION, _text(F.col("date_extraction")), none, none)]
    elif kind == "attribution":
        amount = F.col("montant_ttc")
        keys = [(WINNER, F.col("entreprise_nom"), F.col("entreprise_ville"), none)]
    else:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    each = F.explode(F.array(*(F.struct(F.lit(s).alias("sorte"), a.alias("k1"), b.alias("k2"), c.alias("k3")) for s, a, b, c in keys))).alias("_k")
    counted = rows.select(amount.cast("decimal(38,2)").alias("_m"), each).groupBy("_k").agg(
        F.count(F.lit(1)).alias("n"), F.count("_m").alias("avec_montant"), F.coalesce(F.sum("_m"), F.lit(0)).cast("decimal(38,2)").alias("montant"))
    return counted.select("_k.*", *((F.lit(sign) * F.col(c)).cast(t).alias(c) for c, t in (
        ("n", "bigint"), ("avec_montant", "bigint"), ("montant", "decimal(38,2)"))))


def merged(*changes: DataFrame) -> DataFrame:
    """The sum of partial aggregates; keys without a row left go."""
    every = reduce(lambda a, b: a.unionByName(b), changes)
    sums = every.groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("avec_montant").alias("avec_montant"),
                                    F.sum("montant").cast("decimal(38,2)").alias("montant"))
    return sums.filter((F.col("n") != 0) | (F.col("avec_montant") != 0) | (F.col("montant") != 0))


class Summary:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def add(self, seq: int, *changes: DataFrame) -> None:
        """The changes of run ``seq``; a run that adds again replaces what it added."""
        merged(*changes).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/seq={int(seq)}")

    def rebuild(self, tables: dict[str, DataFrame]) -> None:
        """Count the stored tables anew and drop all changes."""
        whole = merged(*(parts(rows, kind) for kind, rows in tables.items())).withColumn("seq", F.lit(-1).cast("bigint"))
        whole.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("seq").parquet(self.path)

    def read(self) -> DataFrame:
        """The summary: one row a key."""
        if not self.exists():
            return self.spark.createDataFrame([], SCHEMA)
        return merged(self.spark.read.schema(f"{SCHEMA}, seq bigint").parquet(self.path).drop("seq"))

    def fold(self) -> None:
        """One folder again, after many runs."""
        whole = cut_lineage(self.read(), "summary").withColumn("seq", F.lit(-1).cast("bigint"))
        whole.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("seq").parquet(self.path)


def _mean() -> Column:
    return F.when(F.col("avec_montant") != 0, F.col("montant").cast("double") / F.col("avec_montant"))


def _total() -> Column:
    return F.when(F.col("avec_montant") != 0, F.col("montant").cast("double"))


def monthly_stats(summary: DataFrame) -> DataFrame:
    """As ``reports.monthly_stats``."""
    return summary.filter(F.col("sorte") == MONTH).select(
        F.col("k1").cast("timestamp_ntz").alias("mois"), F.col("k2").alias("type_marche"), F.col("k3").alias("statut"),
        F.col("n").alias("nombre_consultations"), _total().alias("montant_total_estime"), _mean().alias("montant_moyen_estime"))


def top_bodies(summary: DataFrame) -> DataFrame:
    """As ``reports.top_bodies``."""
    return summary.filter(F.col("sorte") == BODY).select(
        F.col("k1").alias("organisme_acronyme"), F.col("k2").alias("organisme_nom_complet"), F.col("n").alias("nombre_consultations"),
        _total().alias("montant_total_estime"))


def top_winners(summary: DataFrame) -> DataFrame:
    """As ``reports.top_winners``."""
    return summary.filter(F.col("sorte") == WINNER).select(
        F.col("k1").alias("entreprise_nom"), F.col("k2").alias("entreprise_ville"), F.col("n").alias("nombre_marches"),
        _total().alias("montant_total_ttc"), _mean().alias("montant_moyen_ttc"))


def global_stats(summary: DataFrame) -> DataFrame:
    """As ``reports.global_stats``: one pass over the summary."""
    def of(sorte: str, value: Column) -> Column:
        return F.when(F.col("sorte") == sorte, value)

    def total(sorte: str) -> Column:
        return F.coalesce(F.sum(of(sorte, F.col("montant"))).cast("double"), F.lit(0.0))

    def count(sorte: str, extra: Column | None = None) -> Column:
        value = F.col("n") if extra is None else F.when(extra, F.col("n"))
        return F.coalesce(F.sum(of(sorte, value)), F.lit(0)).cast("bigint")

    return summary.filter("n <> 0").agg(
        count(MONTH).alias("total_consultations"), count(MONTH, F.col("k3") == "en_cours").alias("consultations_en_cours"),
        count(WINNER).alias("total_attributions"), total(MONTH).alias("montant_total_estime"), total(WINNER).alias("montant_total_attribue"),
        F.countDistinct(of(BODY, F.col("k1"))).alias("nombre_organismes"), F.countDistinct(of(WINNER, F.col("k1"))).alias("nombre_entreprises"),
        F.max(of(EXTRACTION, F.col("k1").cast("timestamp_ntz"))).alias("derniere_extraction"))
