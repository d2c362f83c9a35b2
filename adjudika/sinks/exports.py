"""File exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudika.functions import zero_as_null
from adjudika.operators.dedup import first_per_key, new_keys
from adjudika.operators.projections import csv_row
from adjudika.session import cut_lineage

EXPORT_CAP = 10_000
# Values are written as they are: no trimming, blank for empty, quotes doubled.
CSV = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "",
       "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# Rows of a run's bundle: gzip at its fastest level.
PACKED_JSON = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
#: Rows in a file of a bundle, at most.
BUNDLE_ROWS = 500_000

# Headers of the full export, in column order.
FULL_HEADERS = {
    "ref_consultation": "Référence", "titre": "Titre", "organisme_acronyme": "Organisme", "type_marche": "Type",
    "statut": "Statut", "date_publication": "Date Publication", "date_limite": "Date Limite",
    "montant_estime": "Montant Estimé",
}


def write_mode(overwrite: bool) -> str:
    """``overwrite`` clears the output first; otherwise new rows are added to it."""
    return "overwrite" if overwrite else "append"


def tenders_csv(consultations: DataFrame, path: str, cap: int = EXPORT_CAP) -> None:
    """Newest tenders as CSV, at most ``cap`` rows (a feature of this export; ``full_csv`` has no cap)."""
    newest = consultations.orderBy(F.desc("date_publication"), "ref_consultation").limit(cap)
    csv_row(newest).write.mode("overwrite").options(**CSV).csv(path)


def full_csv(consultations: DataFrame, path: str) -> None:
    """All tenders as CSV under the French headers; every part file carries the header."""
    rows = csv_row(consultations)
    rows.select(*(F.col(c).alias(h) for c, h in FULL_HEADERS.items())).write.mode("overwrite").options(**CSV).csv(path)


def awards_json(awards: DataFrame, path: str) -> None:
    """All awards, five keys each, missing values as null."""
    awards.select(
        "ref_consultation", F.col("organisme_acronyme").alias("organisme"), F.col("entreprise_nom").alias("entreprise"),
        zero_as_null(F.col("montant_ttc").cast("double")).alias("montant_ttc"),
        F.date_format("date_attribution", "yyyy-MM-dd").alias("date_attribution"),
    ).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def jsonl_append(records: DataFrame, path: str, overwrite: bool = False) -> None:
    """One JSON object per line, text as UTF-8, NULL kept as null."""
    records.write.mode(write_mode(overwrite)).option("ignoreNullFields", "false").json(path)


def jsonl_append_new(records: DataFrame, path: str, keys, order: list[str]) -> DataFrame:
    """Append the first record of every id that the output does not hold yet, and return what was appended.

    ``keys`` (a ``KeyTable`` of ids) stands for the output: of a long history only the hash prefixes of the batch are read, no JSON is. A table that is
    missing beside an existing output has to be rebuilt from it first.
    """
    first = cut_lineage(first_per_key(records, [keys.key], order), "first")
    fresh = cut_lineage(new_keys(first, keys.lookup(first), keys.key), "fresh")
    jsonl_append(fresh, path)
    keys.add(fresh)
    return fresh


def json_feed(items: DataFrame, path: str) -> bool:
    """Feed of one run: never replaces an earlier file, and an empty run writes none. True when written."""
    if items.isEmpty():
        return False
    items.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    return True


def json_feed_replacing(items: DataFrame, path: str) -> None:
    """Feed of a manual run: replaces the earlier file, and may be empty."""
    items.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def run_bundle(path: str, summary: DataFrame, **parts: DataFrame) -> None:
    """Result of an extraction run: its rows, its errors and a one-row summary, one folder each.

    Every row repeats its keys, so the rows are written as gzip; the summary is plain. A file of gzip is read by one task, which ``BUNDLE_ROWS`` keeps short.
    """
    for name, df in parts.items():
        df.write.mode("overwrite").options(**PACKED_JSON, maxRecordsPerFile=BUNDLE_ROWS).option("ignoreNullFields", "false").json(f"{path}/{name}")
    summary.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/summary")
