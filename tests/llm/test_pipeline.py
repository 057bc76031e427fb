import os

import pytest

pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages_keep_columns_and_clean_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, labels = docs.columns, {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
            seen[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
            assert docs.count() <= before.count()
    assert len(seen["language"]) >= 199
    dropped = seen["language"] - seen["toxicity"]
    assert sum(labels.get(i) == 0 for i in dropped) <= 2
    assert docs.select("doc_id").distinct().count() == len(seen["near_duplicates"])


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_run_equals_brute_force(spark):
    """Each stage once more, row by row: letters, scores of the learned lexicon, all pairs of shingle sets, ids of the tokenizer."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from tessera.llm import toxicity
    from tests.llm.test_neardup import brute

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    left = {i: t for i, t in rows.items() if t and any(c.isalpha() for c in t)}
    kept = docs.where(docs["doc_id"].isin(list(left)))
    score = toxicity.Matcher(toxicity.learn(kept, spark.read.parquet(f"{SF}/labels.parquet"))).score
    left = {i: t for i, t in left.items() if score(t) < 0.7}
    first = brute(left.items(), 5, 80, 100)
    left = {i: t for i, t in left.items() if first[i][1] == i}
    encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = {i: len(encoder.encode(t, add_special_tokens=False).ids) + 1 for i, t in left.items()}
    got = pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in got} == wanted
    assert sum(r["length"] for r in got) == sum(wanted.values())


def test_columns_that_clash(spark, odd_docs, tmp_path):
    from pyspark.sql import functions as F

    spark.createDataFrame([(1, 0, 1), (5, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    names = ["_lang_pred", "lang_pred", "lang_score", "_identified", "toxicity", "_toxicity", "_maybe", "maybe", "gone", "_gone", "gone_key", "twice", "_twice", "twice_key", "_tkey", "tkey", "key", "h", "n", "node", "component_id"]
    docs = odd_docs.drop("key").withColumns({c: F.lit(f"{c}!") for c in names})
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
            assert all(r[c] == f"{c}!" for r in out.collect() for c in names)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() > 0


def test_rows_equal_in_id_and_text_leave_the_same_one(spark):
    rows = [(1, "one and the same text", f"s{k}") for k in range(9)] + [(2, "another", "x")]
    got = [sorted(map(tuple, pipeline.drop_near_duplicates(spark, spark.createDataFrame(r, "doc_id long, text string, source string").repartition(n), "").collect())) for n, r in ((1, rows), (4, rows[::-1]))]
    assert got[0] == got[1] and len(got[0]) == 2


def test_kept_tables_are_removed(spark, tmp_path):
    from tessera.sources import scratch

    before = len(scratch._kept)
    out = scratch.keep_result(lambda: scratch.keep(spark.range(3).toDF("x"), "inner"), "outer")
    assert len(scratch._kept) == before + 1 and out.count() == 3
    folder = scratch.shared_dir(spark)
    assert not [n for n in os.listdir(folder) if n.startswith("inner-")] and [n for n in os.listdir(folder) if n.startswith("outer-")]


def test_odd_rows(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for k, docs in enumerate((odd_docs, no_docs)):
        n = docs.count()
        for name, stage in pipeline.STAGES:
            stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"{name}{k}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}{k}"))
        assert docs.count() == 0 if n == 0 else docs.count() > 0


def test_rows_of_one_id_are_documents_of_their_own(spark):
    x, y, z, v = (" ".join(f"{k}{i}" for i in range(60)) for k in "xyzv")
    rows = [(3, x), (3, y), (5, y), (7, z), (7, v), (7, None), (8, x), (8, "another text, unlike all of the rest"), (9, "twice"), (9, "twice"), (None, x), (None, x)]
    got = pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    wanted = [r for r in rows if r not in [(5, y), (8, x), (9, "twice")]] + [(9, "twice")]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))


def test_texts_stay_where_no_language_can_be_learned(spark):
    rows = [(1, "a clean text, long enough to be learned from if it had a label", None), (2, "short", None), (3, "12 34 --", None), (4, None, None)]
    got = pipeline.keep_languages(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), "").collect()
    assert sorted(r["doc_id"] for r in got) == [1, 2]
