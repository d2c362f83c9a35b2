"""Output shapes of the listings, with money as double."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudika.functions import iso_or_blank, zero_as_null

# Column lists of the published record shapes.
TENDER_LIST = (
    "ref_consultation", "organisme_acronyme", "titre", "type_marche", "statut", "date_publication", "date_limite",
    "montant_estime", "organisme_nom_complet", "organisme_ville", "secteur", "url_detail",
)
TENDER_DETAIL = TENDER_LIST + (
    "objet", "organisme_telephone", "organisme_email", "cautionnement_provisoire", "code_cpv", "url_avis", "url_dce",
    "date_extraction",
)
MINUTES = (
    "ref_consultation", "organisme_acronyme", "type_pv", "date_seance", "date_publication_pv", "contenu",
    "nombre_soumissionnaires", "url_pv",
)
AWARD = (
    "ref_consultation", "organisme_acronyme", "date_attribution", "entreprise_nom", "entreprise_ice",
    "entreprise_ville", "montant_ht", "montant_ttc", "taux_rabais", "numero_lot", "url_resultat",
)
LOT = ("numero_lot", "designation", "montant_estime")


def shape(df: DataFrame, columns) -> DataFrame:
    decimals = {f.name for f in df.schema if f.dataType.typeName() == "decimal"}
    return df.select(*(F.col(c).cast("double").alias(c) if c in decimals else F.col(c) for c in columns))


def csv_row(df: DataFrame) -> DataFrame:
    """Eight text columns of the CSV export: ISO dates, and blank for a missing or zero amount."""
    return df.select(
        "ref_consultation", "titre", "organisme_acronyme", "type_marche", "statut",
        iso_or_blank(F.col("date_publication")).alias("date_publication"),
        iso_or_blank(F.col("date_limite")).alias("date_limite"),
        F.coalesce(zero_as_null(F.col("montant_estime")).cast("string"), F.lit("")).alias("montant_estime"),
    )


def without_html(df: DataFrame) -> DataFrame:
    """The raw page is archived, never stored with the record."""
    return df.drop("page_html")
