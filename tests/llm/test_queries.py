"""Registered queries: SQL parity, schemas, and the pipeline against brute force."""

import pytest

import corpus_pipeline
from loanlens.llm.queries import ORACLE_SQL, QUERIES
from tests.llm import brute
from tests.parity import compare, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_parity(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SMALL)["ok"]


@pytest.mark.parametrize("name, columns, table", [
    ("op1_html_extraction", "page_id url text n_chars", "pages"),
    ("op3_jaccard_join", "doc_id n_shingles component_id", "documents"),
    ("op4_source_mixing", "doc_id size source_size target taken", "documents"),
    ("op5_toxicity", "doc_id toxic", "documents"),
    ("op6_token_counts", "doc_id n_words n_tokens", "documents"),
    ("op7_exact_dedup", "doc_id keep_id group_size kept text_sha256", "documents"),
    ("op8_decontamination", "doc_id n_words n_hit n_items items_sha256 contaminated", "documents"),
    ("op9_suffix_dedup", "doc_id n_bytes n_removed n_spans kept_sha256", "documents"),
    ("op10_secret_scan", "doc_id n_assign n_access n_hex base_sha256 spans", "documents"),
    ("op11_token_files", "doc_id start n_tokens ids_crc32", "documents"),
    ("op13_centroid_clustering", "vec_id cluster distance cluster_inertia inertia centroid_sha256", "embeddings")])
def test_one_row_per_input_row(spark, name, columns, table):
    df = QUERIES[name](spark, SMALL)
    assert set(columns.split()) <= set(df.columns)
    assert df.count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    bench = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    before = [(r.doc_id, r.text) for r in docs.collect()]
    texts = dict(before)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SMALL)
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        rows = [(i, texts[i]) for i in sorted(i for i, _ in before)]
        if k < 4:
            assert docs.columns == columns
        if name == "toxicity":
            truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
            wrong = sum((i in after) == bool(truth[i]) for i, _ in rows if i in truth)
            assert wrong <= 0.1 * len(truth)
            assert len(after) > 0.7 * len(rows)
        elif name == "exact dedup":
            assert after == {max(j for j, u in rows if u == t) for _, t in rows}
        elif name == "n-gram Jaccard join":
            assert after == {i for i, c in brute.similarity_classes(rows, 5, 80).items() if c[1] == i}
        elif name == "benchmark decontamination":
            assert after == {i for i, c in brute.contamination(rows, bench).items() if not c[4]}
        else:
            assert after == {i for i, _ in rows}
            assert all(0 <= r.taken <= 2 * r.size for r in docs.collect())
        before = [(i, texts[i]) for i in after]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources"]


def test_pipeline_run_and_an_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, SMALL).count() > 50
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 7) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def test_stages_decide_per_id_and_text(spark, tmp_path):
    text = " ".join(f"w{k}" for k in range(40))
    item = " ".join(f"b{k}" for k in range(12))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def after(stage, rows):
        kept = stage(spark, _docs(spark, rows), str(tmp_path))
        assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        return sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)

    rows = [(5, "same", "a"), (5, "other text only here", "a"), (9, "same", "a"), (None, "same", "a"), (None, "alone", "b"),
            (None, "alone", "c"), (7, "twice", "a"), (7, "twice", "a"), (None, None, "a"), (3, "", "a")]
    assert after(corpus_pipeline.drop_exact_copies, rows) == sorted([
        (5, "other text only here"), (9, "same"), (None, "alone"), (7, "twice"), (3, "")], key=str)
    rows = [(5, text, "a"), (5, "free of links", "a"), (6, text + " x", "a"), (None, text + " y", "a"), (None, "z", "a")]
    assert after(corpus_pipeline.drop_near_copies, rows) == sorted([
        (6, text + " x"), (5, "free of links"), (None, "z")], key=str)
    rows = [(5, "see " + item, "a"), (5, "clean words", "a"), (None, item + " !", "a"), (None, "clean too", "a"), (8, None, "a")]
    assert after(corpus_pipeline.drop_contaminated, rows) == sorted([
        (5, "clean words"), (None, "clean too"), (8, None)], key=str)
    mixed = corpus_pipeline.mix(spark, _docs(spark, rows), str(tmp_path)).collect()
    assert len(mixed) == 5 and all(0 <= r.taken <= 2 * r.size for r in mixed)
