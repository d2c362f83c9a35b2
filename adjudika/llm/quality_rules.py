"""Learned decision lists over text statistics.

One pass computes integer statistics of every whole text. Sequential covering learns ordered rules from labelled statistics: a rule is a
conjunction of thresholds, grown by information gain on two thirds of the rows, pruned on the last third; rows it covers leave and the
next rule is learnt. The list is emitted as one Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from adjudika.llm.minhash import distinct
from adjudika.llm.textarrays import WHITE_SPACE, SpanHasher, bounds, runs, slices, text_bytes, windows, word_spans
from adjudika.session import cut_lineage

#: Labelled rows that the rules are learnt from at most, chosen by a hash of their id.
SAMPLE_ROWS = 50_000
#: Thresholds tried for a statistic, at its quantiles.
THRESHOLDS = 64
MAX_RULES, MAX_CONDITIONS = 16, 4

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_REPEAT_WORDS = 3

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines")


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of every text.

    n_words: words ``[^\\x20\\x09-\\x0D]+``; word_chars: code points in them; n_symbols: characters of ``#*$%&|<>``; n_dup_lines: lines with a word
    that equal an earlier line; n_repeat_words: words in three-word windows that the text has twice or more; n_upper: ASCII capitals;
    n_marks: ASCII characters that are neither letters, digits nor white space; n_lines: lines with a word. A null text has zeros.
    """
    n = len(texts)
    data, offsets = text_bytes(texts)
    starts, ends, owner = word_spans(data, offsets, WHITE_SPACE)
    hasher = SpanHasher(data)

    def per_text(marked: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(marked, dtype=np.int64))
        return total[offsets[1:]] - total[offsets[:-1]]

    white = WHITE_SPACE[data]
    letters = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)
    digits = (data >= 0x30) & (data <= 0x39)
    line_starts, line_ends, line_owner = runs(data != 0x0A, offsets)
    seen = np.append(0, np.cumsum(~white))
    held = seen[line_ends] > seen[line_starts]
    line_starts, line_ends, line_owner = line_starts[held], line_ends[held], line_owner[held]
    n_lines = np.bincount(line_owner, minlength=n)
    _, kinds = distinct(hasher(line_starts, line_ends), line_owner)

    made, first = windows(hasher(starts, ends), owner, _REPEAT_WORDS)
    repeated = np.zeros(len(starts), bool)
    if len(made):
        order = np.lexsort((made, owner[first]))
        h, o, at = made[order], owner[first][order], first[order]
        same = (h[1:] == h[:-1]) & (o[1:] == o[:-1])
        twice = np.append(same, False) | np.append(False, same)
        for k in range(_REPEAT_WORDS):
            repeated[at[twice] + k] = True
    return {
        "n_words": np.diff(bounds(owner, n)), "word_chars": per_text(~white & ((data & 0xC0) != 0x80)), "n_symbols": per_text(_SYMBOLS[data]),
        "n_dup_lines": n_lines - np.bincount(kinds, minlength=n), "n_repeat_words": np.bincount(owner[repeated], minlength=n),
        "n_upper": per_text(letters & (data < 0x60)), "n_marks": per_text((data < 0x80) & ~white & ~letters & ~digits), "n_lines": n_lines,
    }


def with_counts(docs: DataFrame) -> DataFrame:
    """doc_id and ``COUNTS`` of every row of ``docs``; its other columns are ignored."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = counts(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(made[c], pa.int64()) for c in COUNTS]], names=["doc_id", *COUNTS])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        count, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))


#: The statistics that rules may test: a numerator and a denominator of COUNTS.
RATIOS = (("n_words", None), ("word_chars", "n_words"), ("n_symbols", "n_words"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"),
          ("n_upper", "word_chars"), ("n_marks", "word_chars"), ("n_words", "n_lines"))


@dataclass(frozen=True)
class Condition:
    """``numerator >= threshold * denominator`` or ``<=``; a missing denominator is 1."""
    numerator: str
    denominator: str | None
    at_least: bool
    threshold: float

    def column(self) -> Column:
        left, right = F.col(self.numerator).cast("double"), F.lit(self.threshold)
        if self.denominator:
            right = right * F.col(self.denominator).cast("double")
        return left >= right if self.at_least else left <= right

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        right = self.threshold * (rows[self.denominator].astype(float) if self.denominator else 1.0)
        left = rows[self.numerator].astype(float)
        return left >= right if self.at_least else left <= right


Rule = tuple[Condition, ...]


def _covered(rule: Rule, rows: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(rows["n_words"]), bool)
    for condition in rule:
        out &= condition.holds(rows)
    return out


def _candidates(rows: dict[str, np.ndarray]) -> list[tuple[Condition, np.ndarray]]:
    made = []
    for numerator, denominator in RATIOS:
        value = rows[numerator] / (np.maximum(rows[denominator], 1) if denominator else 1.0)
        for threshold in np.unique(np.quantile(value, np.linspace(0, 1, THRESHOLDS))) if len(value) else ():
            for at_least in (True, False):
                condition = Condition(numerator, denominator, at_least, float(round(threshold, 6)))
                made.append((condition, condition.holds(rows)))
    return made


def _grow(rows: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    candidates, rule, live = _candidates(rows), (), np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and (live & ~bad).any():
        p, n = int((live & bad).sum()), int((live & ~bad).sum())
        if not p:
            break
        best, gain = None, 1e-9
        for condition, holds in candidates:
            got = holds & live
            q, m = int((got & bad).sum()), int((got & ~bad).sum())
            if q and (worth := q * (np.log2(q / (q + m)) - np.log2(p / (p + n)))) > gain:
                best, gain = (condition, holds), worth
        if best is None:
            break
        rule, live = (*rule, best[0]), live & best[1]
    return rule


def _worth(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray) -> float:
    got = _covered(rule, rows)
    p, n = int((got & bad).sum()), int((got & ~bad).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn(rows: dict[str, np.ndarray], bad: np.ndarray, part: np.ndarray, precision: float = 0.9) -> list[Rule]:
    """An ordered list of rules for ``bad`` rows. ``part`` 0 or 1: rows to grow on, 2: rows to prune on.

    A rule that finds bad rows with less than ``precision`` on the rows to prune on ends the list. Ties go to the earlier statistic and the
    lower threshold, so equal rows give equal lists. No bad or no good rows: no rules.
    """
    rules: list[Rule] = []
    live = np.ones(len(bad), bool)
    while len(rules) < MAX_RULES and (live & bad).any() and (live & ~bad).any():
        grow, prune = live & (part != 2), live & (part == 2)
        sub = {k: v[grow] for k, v in rows.items()}
        rule = _grow(sub, bad[grow])
        held = {k: v[prune] for k, v in rows.items()}
        if rule and prune.any():
            rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (_worth(r, held, bad[prune]), -len(r)))
        if not rule or (prune.any() and _worth(rule, held, bad[prune]) < 2 * precision - 1):
            break
        rules.append(rule)
        live &= ~_covered(rule, rows)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that a row meets, else 0, as one conditional expression."""
    out = None
    for k, rule in enumerate(rules, 1):
        met = F.lit(True)
        for condition in rule:
            met = met & condition.column()
        out = F.when(met, k) if out is None else out.when(met, k)
    return F.lit(0) if out is None else out.otherwise(0)


def learn_from(counted: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules from counted documents and labels (doc_id, quality), on at most ``sample_rows`` labelled rows chosen by a hash of doc_id.

    Rows whose crc32(doc_id) mod 4 is 2 are left out, so the list can be measured on them. Null ids or labels are no labels. Of several
    labels of one id the least counts.
    """
    known = (labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
             .agg(F.min("quality").alias("quality")).withColumn("_crc", F.crc32(F.col("doc_id").cast("string").cast("binary"))).filter("_crc % 4 <> 2"))
    chosen = (counted.join(known, "doc_id").select(*COUNTS, "quality", "_crc", "doc_id")
              .orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(sample_rows).toPandas())
    rows = {c: chosen[c].to_numpy(np.int64) for c in COUNTS}
    return learn(rows, chosen["quality"].to_numpy() == 0, chosen["_crc"].to_numpy(np.int64) // 4 % 3)


def judge(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the statistics, base_failed, rule and kept of every row of ``docs``.

    base_failed: fewer than 50 words, or more than half of the words in repeated windows. ``rule`` is the first learnt rule that is met, 0 for
    none; ``kept`` is false if base_failed or a rule is met. Null and empty texts fail the base rule; without labels there are no rules.
    """
    counted = cut_lineage(with_counts(docs), "text-statistics")
    rules = learn_from(counted, labels, sample_rows)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (counted.withColumns({"base_failed": failed, "rule": verdict(rules)})
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))
