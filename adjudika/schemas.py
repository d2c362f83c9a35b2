"""Explicit schemas, enum domains, required fields and lengths of the tender data model."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DateType()
NTZ, MONEY, PCT = T.TimestampNTZType(), T.DecimalType(15, 2), T.DecimalType(5, 2)


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


CONSULTATIONS = _struct(
    ref_consultation=S, organisme_acronyme=S, titre=S, objet=S, type_marche=S, date_publication=NTZ, date_limite=NTZ,
    date_seance=NTZ, statut=S, montant_estime=MONEY, cautionnement_provisoire=MONEY, organisme_nom_complet=S,
    organisme_ville=S, organisme_telephone=S, organisme_email=S, secteur=S, code_cpv=S, url_detail=S, url_avis=S,
    url_dce=S, date_extraction=NTZ, date_derniere_maj=NTZ, page_html_archivee=S,
)
LOTS = _struct(
    ref_consultation=S, numero_lot=S, designation=S, description=S, montant_estime=MONEY,
    cautionnement_provisoire=MONEY, cautionnement_definitif=MONEY, delai_execution=S, date_extraction=NTZ,
)
PV_EXTRAITS = _struct(
    ref_consultation=S, organisme_acronyme=S, type_pv=S, date_seance=NTZ, date_publication_pv=NTZ, contenu=S,
    nombre_soumissionnaires=I, url_pv=S, date_extraction=NTZ, page_html_archivee=S,
)
ATTRIBUTIONS = _struct(
    ref_consultation=S, organisme_acronyme=S, date_attribution=D, date_publication=NTZ, entreprise_nom=S,
    entreprise_ice=S, entreprise_ville=S, montant_ht=MONEY, montant_ttc=MONEY, taux_rabais=PCT, numero_lot=S,
    designation_lot=S, delai_execution=S, url_resultat=S, date_extraction=NTZ, page_html_archivee=S,
)
ACHEVEMENTS = _struct(
    ref_consultation=S, organisme_acronyme=S, date_achevement=D, date_publication=NTZ, entreprise_nom=S,
    montant_definitif=MONEY, observations=S, url_rapport=S, date_extraction=NTZ, page_html_archivee=S,
)
EXTRACTION_LOGS = _struct(
    date_execution=NTZ, spider_name=S, statut=S, pages_parcourues=L, items_extraits=L, items_inseres=L,
    items_mis_a_jour=L, erreurs=L, duree_secondes=L, message=S, erreur_details=S,
)
METRICS = _struct(ts=NTZ, spider=S, metric=S, label=S, value=T.DoubleType())
PAGES = _struct(page_id=L, url=S, html=S)
FORM_ROWS = _struct(ref=S, objet=S, acheteur=S, date_limite=S, url_detail=S, source_list_url=S)
DETAIL_RECORDS = _struct(**{name: S for name in (
    "date_limite", "ref", "objet", "entite_publique", "type_procedure", "categorie", "lieu_execution",
    "estimation_ttc", "caution_provisoire", "lieu_ouverture_plis", "adresse_retrait_dossiers",
    "adresse_depot_offres", "variante_autorisee", "visites_lieux", "refConsultation", "orgAcronyme", "id",
    "scraped_at", "url_detail",
)})

TABLES = {
    "consultation": CONSULTATIONS, "lot": LOTS, "pv": PV_EXTRAITS, "attribution": ATTRIBUTIONS,
    "achevement": ACHEVEMENTS,
}

# Enum domains.
TYPE_MARCHE = ("travaux", "fournitures", "services", "etudes")
STATUT = ("en_cours", "cloture", "annule", "reporte", "infructueux")

# Fields an incoming record must carry (an empty value counts as missing), in checking order.
REQUIRED_FIELDS = {
    "consultation": ("ref_consultation", "titre", "organisme_acronyme"),
    "lot": ("ref_consultation", "numero_lot"),
    "pv": ("ref_consultation", "date_publication_pv"),
    "attribution": ("ref_consultation", "entreprise_nom"),
    "achevement": ("ref_consultation", "date_achevement"),
}

# Columns that may not be NULL in the stored table.
NOT_NULL = {
    "consultation": ("ref_consultation", "organisme_acronyme", "titre", "type_marche", "date_publication", "statut",
                     "date_extraction"),
    "lot": ("ref_consultation", "numero_lot", "designation", "date_extraction"),
    "pv": ("ref_consultation", "organisme_acronyme", "date_publication_pv", "date_extraction"),
    "attribution": ("ref_consultation", "organisme_acronyme", "date_attribution", "entreprise_nom",
                    "date_extraction"),
    "achevement": ("ref_consultation", "organisme_acronyme", "date_achevement", "date_extraction"),
}

# Longest text a stored column takes.
MAX_LENGTH = {
    "ref_consultation": 100, "organisme_acronyme": 50, "organisme_nom_complet": 255, "organisme_ville": 100,
    "organisme_telephone": 50, "organisme_email": 100, "secteur": 100, "code_cpv": 50, "url_detail": 500,
    "url_avis": 500, "url_dce": 500, "numero_lot": 20, "delai_execution": 100, "type_pv": 50, "url_pv": 500,
    "entreprise_nom": 255, "entreprise_ice": 50, "entreprise_ville": 100, "url_resultat": 500, "url_rapport": 500,
}
ENUMS = {"type_marche": TYPE_MARCHE, "statut": STATUT}
AMOUNT_FIELDS = ("montant_estime", "cautionnement_provisoire", "montant_ht", "montant_ttc")
LONG_TEXT_FIELDS = ("titre", "objet", "designation")
LONG_TEXT_LIMIT = 1000
