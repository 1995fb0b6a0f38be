from collections import Counter

import corpus_pipeline
from corpus_pipeline import STAGES
from tests.llm.rows import documents, prose
from tests.llm.test_near_duplicates import brute


def test_stages_in_order():
    assert [n for n, _ in STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "personal_data", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_on_what_the_one_before_kept(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (docs, out)
        if name != "packing":
            assert out.columns == columns and out.dtypes == docs.dtypes
        docs = out
    for name in ("quality_rules", "quality_classifier", "near_duplicates"):
        before, after = seen[name]
        assert 0 < after.count() <= before.count() and after.exceptAll(before).isEmpty()
    assert all(b.count() < a.count() for a, b in (seen["quality_rules"], seen["near_duplicates"]))

    before, after = ([tuple(r) for r in df.select("doc_id", "text").collect()] for df in seen["near_duplicates"])
    assert {r[0] for r in after} == {c for _, c, _, _ in brute(before)} and len(after) == len({r[0] for r in after})

    before, after = ({r["doc_id"]: r for r in df.collect()} for df in seen["personal_data"])
    assert before.keys() == after.keys() and any("[EMAIL]" in r["text"] for r in after.values())
    assert all(r["n_chars"] == len(r["text"]) and "@mail" not in r["text"] for r in after.values())

    before, after = seen["packing"]
    assert {r["doc_id"] for r in before.select("doc_id").collect()} == {r["doc_id"] for r in after.collect()}
    filled = Counter()
    for r in after.collect():
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 1024 and len(filled) < 1.05 * sum(filled.values()) / 1024 + 2


def test_clean_documents_stay_and_junk_goes(spark, tmp_path):
    good = [(i, prose(i, 150), "en", "a", 0) for i in range(300)]
    bad = [(1000 + i, " ".join(w + "###" for w in prose(i, 100).split()), "en", "a", 0) for i in range(20)]
    bad += [(2000 + i, "same words again " * 40, "en", "a", 0) for i in range(20)] + [(3000, "too short", "en", "a", 0)]
    spark.createDataFrame([*good, *bad], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    labels = [(i, 1, 0) for i in range(200)] + [(1000 + i, 0, 0) for i in range(10)] + [(2000 + i, 0, 0) for i in range(10)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in good}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_go_through_all_stages(spark, tmp_path):
    """Nulls in any column, empty, wordless and very long texts, repeated rows, and columns whose names the operators use."""
    texts = {i: prose(i, 150) for i in range(40)}
    rows = [(i, t, "en", "a") for i, t in texts.items()]
    rows += [(0, texts[0], "en", "a"), (0, texts[0], "en", "a"), (50, texts[1], None, None), (51, texts[2] + " tail", "de", "b")]
    rows += [(None, prose(60, 150), "en", "a"), (None, prose(61, 150), None, None), (None, None, None, None), (70, None, "en", "a")]
    rows += [(71, "", "en", "a"), (72, " \n\t", "en", "a"), (73, prose(62, 30_000), "en", "a"), (74, "x" * 50_000, "en", "a")]
    rows += [(75, prose(63, 100) + " jo.doe@mail.example.com " + prose(64, 20), "en", "a")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(30)] + [(71, 0, 0), (None, 1, None), (3, None, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for name, stage in STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert name == "packing" or docs.columns == columns
    kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
    # Copies 50 of 1 and 51 near 2 go, and so do texts without enough words; the rest stays, rows without id, too.
    assert kept == {*range(40), None, 73, 75}
    assert docs.filter("doc_id IS NULL AND piece = 0").count() == 2 and docs.filter("doc_id = 0 AND piece = 0").count() == 1
    masked = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tmp_path}/personal_data").collect()}
    assert "[EMAIL]" in masked[75] and "@" not in masked[75] and masked[73] == prose(62, 30_000)
