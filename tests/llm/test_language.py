"""Held-out accuracy, defined results of odd rows, and the backoff itself."""

import zlib

from marinelake.llm.language import LanguageModel, identify_languages, learn_languages, op10_language_id, predict_languages

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op10_language_id(spark, SF).collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and docs[r["doc_id"]]["lang"] and any(c.isalpha() for c in docs[r["doc_id"]]["text"])]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert right / len(held) > 0.97


def test_label_of_a_held_out_row_is_not_used(spark):
    docs = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate([("ja oui", "a"), ("no si", "b")] * 20)], "doc_id long, text string, lang string")
    flipped = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 'zz' ELSE lang END AS lang")
    assert sorted(identify_languages(docs).collect()) == sorted(identify_languages(flipped).collect())


def test_backoff_goes_from_words_to_shorter_grams():
    model = LanguageModel(["x", "y"], {("ab", "x"): 9, ("ab", "y"): 1, ("zz", "y"): 9, ("zz", "x"): 1}, {(" cd", "y"): 5, ("c", "x"): 50, ("e", "x"): 30}, {"x": 1, "y": 1})
    assert model.word("ab")[0] > 0 > model.word("ab")[1]
    assert model.word("cdf")[1] > 0  # the longer n-gram decides, not the frequent letter
    assert model.word("ezx")[0] > 0 and model.word("qq").tolist() == [0, 0]


def test_odd_rows(spark, odd, empty):
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["lang_pred"], r["held_out"]) for r in identify_languages(odd).collect()))
    assert len(got) == odd.count()
    assert {i for _, i, p, _ in got if p == "und"} >= {2, 3, 6}
    assert identify_languages(empty).count() == 0
    assert {r["lang_pred"] for r in predict_languages(odd, learn_languages(empty)).collect()} == {"und"}
