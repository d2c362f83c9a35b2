"""Label normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adjudika.functions.text import blank_to_null

# The first fragment found in the lower-cased label decides.
TYPE_FRAGMENTS = (
    ("travaux", "travaux"),
    ("fourniture", "fournitures"),
    ("service", "services"),
    ("etude", "etudes"),
    ("étude", "etudes"),
)
STATUT_FRAGMENTS = (
    ("cours", "en_cours"),
    ("clôtur", "cloture"),
    ("clotur", "cloture"),
    ("annul", "annule"),
)
DEFAULT_STATUT = "en_cours"


def _first_fragment(lowered: Column, fragments) -> Column:
    hits = [F.when(F.contains(lowered, F.lit(part)), F.lit(label)) for part, label in fragments]
    return F.coalesce(*hits, lowered)


def normalize_type_marche(c: Column) -> Column:
    """Known contract type, or the lower-cased label when no fragment matches; empty gives NULL."""
    return _first_fragment(F.lower(blank_to_null(c)), TYPE_FRAGMENTS)


def normalize_statut(c: Column) -> Column:
    """Known status, or the lower-cased label; empty gives the default."""
    return F.coalesce(_first_fragment(F.lower(blank_to_null(c)), STATUT_FRAGMENTS), F.lit(DEFAULT_STATUT))


def procedure_label(kind: Column, mode: Column) -> Column:
    """Type of procedure, then a space and the mode if there is one."""
    return F.concat(
        F.coalesce(kind, F.lit("")),
        F.coalesce(F.concat(F.lit(" "), blank_to_null(mode)), F.lit("")),
    )
