import public_tokenizers
import pytest

import corpus_pipeline as C
from adjudika.llm import decontaminate, pieces, pii, quality_model
from test_decontaminate import brute_force as contaminated
from test_minhash import brute_force as duplicates

PATH = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that each stage leaves, after being written and read again."""
    root, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{PATH}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        stage(spark, docs, PATH).write.parquet(str(root / name))
        docs = spark.read.parquet(str(root / name))
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_and_their_columns(stages):
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "decontamination", "pseudonyms", "encoding"]
    assert all(df.columns == C.COLUMNS for df in stages[:-1]) and stages[-1].columns == ["doc_id", "ids", "n_chunks"]


def test_quality_decides(spark, stages):
    labels = spark.read.parquet(f"{PATH}/labels.parquet")
    judged = {r.doc_id: r.predicted for r in quality_model.judge(stages[0], labels).collect()}
    assert set(rows(stages[1])) == {i for i, p in judged.items() if p == 1}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    kept = [judged[i] for i, q in truth.items() if q == 1]
    assert sum(kept) > 0.97 * len(kept)


def test_one_document_of_each_group_stays(stages):
    before = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert set(rows(stages[2])) == {x[1] for x in duplicates(before) if x[4]}


def test_benchmark_windows_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{PATH}/benchmark.parquet").collect()]
    before = [(r.doc_id, r.text) for r in stages[2].collect()]
    assert set(rows(stages[3])) == {x[0] for x in contaminated(before, items) if not x[5]}
    assert not any(r.contaminated for r in decontaminate.digests(stages[3], spark.read.parquet(f"{PATH}/benchmark.parquet")).collect())


def test_pseudonyms_take_effect(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert before.keys() == after.keys()
    want = rows(pii.pseudonymised(stages[3], C.PII_KEY))
    for i, r in after.items():
        assert (r.text, r.n_chars, r.lang, r.source) == (want[i].text, len(want[i].text), before[i].lang, before[i].source)


def test_encoding_is_of_the_last_texts(spark, stages):
    after = rows(stages[4])
    back = pieces.decode(stages[5], public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id: r.text for r in back.collect()} == {i: r.text for i, r in after.items()}
    assert sorted(map(tuple, C.run(spark, PATH).select("doc_id", "n_chunks").collect())) == sorted((r.doc_id, r.n_chunks) for r in stages[5].collect())


def test_odd_documents_pass_every_stage(spark, docs_of, tmp_path):
    """Nulls, empty and repeated rows, an empty table, and extra columns."""
    rows = [(1, None), (2, ""), (None, "no id at all"), (3, "same text here"), (3, "same text here"), (4, "x" * 40_000)]
    docs = docs_of(rows)
    for k, (name, stage) in enumerate(C.STAGES):
        for j, given in enumerate((docs, docs.limit(0))):
            out = stage(spark, given, PATH)
            out.write.parquet(str(tmp_path / f"{k}-{j}"))
            n = spark.read.parquet(str(tmp_path / f"{k}-{j}")).count()
            assert n == 0 if j else n <= len(rows)
            assert j or name == "quality" or n == len(rows)
