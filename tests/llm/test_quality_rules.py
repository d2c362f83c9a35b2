import re
from collections import Counter

import numpy as np
import pytest

from adjudika.llm import quality_rules as Q
from adjudika.llm.queries import QUERIES

TEXTS = ["", None, " \n\t ", "one", "a b c a b c", "a b c\na b c\n\na b c\n d", "x | y <z> #*$%&", "É éa Zoë\x0bB\x1cC", "same same same same same",
         "a\nb\n a\n\na\nb", "tail\r\ntail\r\n", "word " * 60, "p q r s p q r t s p q", "\U0001f600 \U0001f600", "A!! B!! c"]


def brute_force(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(re.findall("[A-Z]", text)), len(re.findall(r"[^\x20\x09-\x0DA-Za-z0-9\x80-\U0010ffff]", text)), len(lines))


def test_counts_and_base(spark, docs_of):
    rows = list(enumerate(TEXTS * 3)) + [(None, "x y z"), (2, "again")]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(0, 1, None), (None, 0, 1), (1, None, 0)], "doc_id bigint, quality int, toxic int")
    got = Q.judge(docs, labels).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(key((r.doc_id, *[r[c] for c in Q.COUNTS])) for r in got) == sorted(key((i, *brute_force(t))) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and r.kept == (not r.base_failed and r.rule == 0)
    assert Q.judge(docs.limit(0), labels).count() == 0 and Q.judge(docs, labels.limit(0)).count() == len(rows)


def test_rules_find_a_planted_conjunction(spark):
    rng = np.random.default_rng(1)
    rows = {c: rng.integers(1, 1000, 6000) for c in Q.COUNTS}
    bad = (rows["n_symbols"] >= 0.8 * rows["n_words"]) & (rows["n_words"] >= 600)
    rules = Q.learn(rows, bad, np.arange(6000) % 3)
    caught = np.zeros(6000, bool)
    for rule in rules:
        caught |= Q._covered(rule, rows)
    assert (caught & bad).sum() > 0.85 * bad.sum() and (caught & ~bad).sum() < 0.05 * bad.sum()
    frame = spark.createDataFrame([[int(rows[c][i]) for c in Q.COUNTS] for i in range(500)], ", ".join(f"{c} bigint" for c in Q.COUNTS))
    assert [r[0] > 0 for r in frame.select(Q.verdict(rules)).collect()] == caught[:500].tolist()


@pytest.mark.parametrize("bad", [np.zeros(10, bool), np.ones(10, bool)])
def test_one_class_gives_no_rules(bad):
    assert Q.learn({c: np.arange(10) for c in Q.COUNTS}, bad, np.arange(10) % 3) == []


def test_held_out_labels(spark):
    path = "/root/testdata/sf0.1"
    got = QUERIES["op8_quality_rules"](spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").selectExpr(
        "doc_id", "kept", "base_failed", "quality", "crc32(cast(doc_id as string)) % 4 = 2 as held").filter("held and not base_failed").collect()
    good, bad = [r for r in got if r.quality == 1], [r for r in got if r.quality == 0]
    assert sum(r.kept for r in good) > 0.97 * len(good) and sum(not r.kept for r in bad) > 0.8 * len(bad)
