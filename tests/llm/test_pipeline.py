"""Each stage against what its operator decides, on its own input."""

import re

import corpus_pipeline
from pyspark.sql import functions as F

from marinelake.llm.licences import TEMPLATES, scan_licences, train_licences
from tests.llm.test_minhash import brute
from tests.llm.test_passages import exact_repeats
from tests.llm.test_surrogates import PLANTED
from tests.llm.test_token_ids import public_tokenizer
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], SF).write.parquet(str(tmp_path / name))
        kept.append(spark.read.parquet(str(tmp_path / name)))
    texts = [{r["doc_id"]: r["text"] for r in df.collect()} for df in kept[:5]]
    assert all(df.columns == docs.columns for df in kept[:5])
    # Language: only documents without a letter or a clear language go.
    assert all(not re.search(r"[^\W\d_]", texts[0][i]) for i in texts[0].keys() - texts[1].keys())
    # Near-duplicates: of each class of all pairs the smallest id stays.
    classes, least = brute(spark, kept[1]), {}
    for i, t in texts[1].items():
        c = classes.get(t, i)
        least[c] = min(least.get(c, i), i)
    assert set(texts[2]) == set(least.values())
    # Passages: no long exact repeat is left, other documents are as before.
    repeats = exact_repeats(texts[2])
    assert texts[3].keys() == texts[2].keys() and not exact_repeats(texts[3])
    assert all(texts[3][i] != texts[2][i] for i in repeats)
    assert sum(texts[3][i] == t for i, t in texts[2].items()) >= len(texts[2]) - 2 * len(repeats) - 3
    # Personal data: none of it is left, nothing else changes.
    for i, t in texts[3].items():
        assert PLANTED.split(texts[4][i]) == PLANTED.split(t)
        assert not set(PLANTED.findall(t)) & set(PLANTED.findall(texts[4][i]))
    # Packing: every id once.
    model = Tokenizer.from_file(public_tokenizer("byte_bpe_50k.json"))
    n = sum(len(model.encode(t, add_special_tokens=False).ids) + 1 for t in texts[4].values())
    rows = kept[5].collect()
    assert sum(r["length"] for r in rows) == n and max(r["offset"] + r["length"] for r in rows) <= 2048
    assert corpus_pipeline.run(spark, SF).count() == len(rows)


def test_licences(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = train_licences(docs)
    found = scan_licences(docs, model).collect()
    planted = {(r["doc_id"], n) for r in docs.collect() for n, line in enumerate(r["text"].split("\n")) if re.search(r"(?i)licensed under|under the MIT License|rights reserved", line)}
    assert {(r["doc_id"], r["paragraph"]) for r in found} == planted and planted
    assert all(r["license"] != "unknown" and r["content"] in TEMPLATES[r["license"]] for r in found)
    rows = [
        (1, "Preface.\n\nThe whole is licensed under the terms of the Apache License, Version 2.0, see below.\nEnd"),
        (1, "Preface.\n\nThe whole is licensed under the terms of the Apache License, Version 2.0, see below.\nEnd"),
        (2, "Licensed under the Fancy Sharing License, revision 7 of the club."),
        (3, "He lost his license plate in the general public house."),
        (None, "SPDX-License-Identifier: MIT"),
    ]
    got = {(r["doc_id"], r["paragraph"], r["license"]) for r in scan_licences(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got - {(2, 0, "unknown")} == {(1, 2, "apache"), (None, 0, "mit")}
    assert scan_licences(odd, model).count() == 0 and scan_licences(empty, model).count() == 0
    assert scan_licences(empty).count() == 0


def test_documents_without_any_label_stay(spark, odd, empty):
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.keep_languages(spark, unlabelled, SF)
    assert kept.columns == odd.columns
    with_letters = [r["doc_id"] for r in odd.collect() if r["text"] and any(c.isalpha() for c in r["text"])]
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(with_letters, key=str)
    assert corpus_pipeline.keep_languages(spark, empty, SF).count() == 0
