from tessera.llm.toxicity import Lexicon, Matcher, learn, score_column, toxicity_query, words_of

from tests.llm.conftest import words


def labelled(spark, n=900):
    docs, labels = [], []
    for i in range(n):
        w = words(i, 60)
        bad = i % 4 == 0
        if bad:
            w[7], w[30] = "nastyword", ("vileness" if i % 8 else "nastyword")
        if not bad and i % 5 == 1:
            w[10:12] = ["nastyword", "spray"]  # a harmless phrase around a bad word
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_folding():
    assert words_of("IDI0T! ｉｄｉｏｔ іdіоt id\u200biot 1d10t id!ot") == ["idiot"] * 6
    assert words_of("ndea$$$ 100 st0p!!") == ["ndea", "stop"]


def test_longest_term_and_exceptions():
    m = Matcher(Lexicon(((" bad ", 2.0), (" ba", 1.0)), (" bad weather ",)))
    assert [(w, t) for _, w, t in m.hits(" bad man baker ")] == [(2.0, " bad "), (1.0, " ba")]
    assert m.hits(" bad weather ") == []


def test_learns_from_rows_that_may_be_learned_from_only(spark):
    docs, labels = labelled(spark)
    got = {r["doc_id"]: r for r in toxicity_query(docs, labels).collect()}
    held = [r for r in got.values() if r["held_out"]]
    right = sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in held)
    assert len(got) == 900 and right / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    from pyspark.sql import functions as F

    from tessera.llm.common import held_out

    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert learn(docs, flipped) == learn(docs, labels)


def test_odd_rows(spark, odd_docs, no_docs):
    docs, labels = labelled(spark, 300)
    lexicon = learn(docs, labels)
    scored = odd_docs.withColumn("s", score_column(lexicon)).collect()
    assert len(scored) == odd_docs.count() and all(0 <= r["s"] <= 1 for r in scored)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity_query(odd_docs, none).collect()} == {0.0}
    assert toxicity_query(no_docs, none).count() == 0


def test_every_disguise_is_folded_alone():
    for odd in ("\u0131d\u0131ot", "id\u2170ot", "\u24d8\u24d3\u24d8\u24de\u24e3", "\u2071diot", "id\u00adiot", "i\u0501iot", "\uff49diot", "id\u200biot"):
        assert words_of(odd) == words_of(odd + " \u2019")[:1] == ["idiot"]
    assert words_of("foo\u0142") == ["fool"]


def test_genuine_words_of_other_scripts_are_not_folded():
    russian = "привет ЗДОРОВО и соха"
    assert words_of(russian) == ["привет", "здорово", "и", "соха"]
    assert words_of("και το νερό") == ["και", "το", "νερό"]
    # masked words: mixed, or all of look-alikes within a Latin text
    assert words_of("an \u0430\u0455\u0455 and an аss") == ["an", "ass", "and", "an", "ass"]


def _rates(spark, docs):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = [r for r in toxicity_query(docs, labels).collect() if r["held_out"] and r["doc_id"] in toxic]
    of = lambda y: [r["predicted"] for r in got if toxic[r["doc_id"]] == y]
    return sum(of(1)) / len(of(1)), sum(of(0)) / len(of(0))


def test_held_out_rows_of_the_tables(spark):
    caught, flagged = _rates(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert caught >= 0.75 and flagged <= 0.05
