"""The pipeline keeps clean documents, one of each near-duplicate group, and packs them."""

import random

import corpus_pipeline
from tallyfold.llm import jaccard

WORDS = {"aa": ["river", "stone", "moved", "green"], "bb": ["schlung", "verein", "machen", "ueber"]}


def clean(rng, lang, size=80):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "s", "en", "ly", "te"]) + rng.choice(["", "ing", "er"]) for _ in range(size)) + "."


def tables(spark, folder):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(300):
        lang = rng.choice(sorted(WORDS))
        text = clean(rng, lang)
        bad = i % 5 == 4
        docs.append((i, text.upper().replace(" ", "!! ") if bad else text, lang, "s", len(text)))
        labels.append((i, int(not bad), 0))
    for i in range(300, 330):  # copies, exact and near
        words = docs[i - 300][1].split()
        if i % 2:
            words[-1] = "changed"
        docs.append((i, " ".join(words), docs[i - 300][2], "s", 1))
    docs += [(400, None, "aa", "s", 0), (401, "12 34 56", None, "s", 0), (None, clean(rng, "aa"), None, None, None)]
    docs.append((402, clean(rng, "bb", 3000), "bb", "s", 9))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs


def test_stages(spark, tmp_path):
    rows = tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, docs
    ids = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, str(tmp_path)).collect(), docs.schema)
        assert kept.columns == columns
        ids.append({r.doc_id for r in kept.collect()})
    assert {400, 401}.isdisjoint(ids[0]) and len(ids[0]) == len(rows) - 2
    clean_ids = {r[0] for r in rows if r[0] not in (400, 401) and not (r[0] is not None and r[0] < 330 and r[0] % 300 % 5 == 4)}
    assert ids[1] == clean_ids
    assert ids[2] == {i for i in clean_ids if i is None or not 300 <= i < 330}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == ids[2]


def test_near_duplicate_stage_equals_components(spark):
    docs = spark.createDataFrame([(3, "a b c d e f g h i j"), (2, "a b c d e f g h i j"), (5, "q w e r t y")], "doc_id long, text string")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [2, 5]
    assert jaccard.join(docs).filter("doc_id = component_id").count() == 2
