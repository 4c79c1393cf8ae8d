"""The pipeline stage by stage on a small corpus, against what each stage should keep."""

import hashlib
import random

import pytest
from helpers_llm import AWKWARD, classes

import corpus_pipeline
from tripmill.llm import bpe_files, op3_surrogates
from tripmill.llm.queries import ORACLES, QUERIES

WORDS = ["".join(random.Random(i).choices("abcdefghijklmnopqrst", k=5)) for i in range(500)]
ITEM = "Given 12 red boxes and 7 blue bags, how many things did the small shop sell before noon on the first day?"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    rows, labels = [], []
    for i in range(300):
        text = prose(rng, rng.randint(20, 80))
        bad = i % 6 == 0
        rows.append((i, text.upper().replace(" ", "!! ") if bad else text))
        labels.append((i, int(not bad), 0))
    good = [r for r in rows if r[0] % 6]
    rows += [(400 + k, t) for k, (_, t) in enumerate(good[:10])]
    rows += [(450 + k, t.replace(t.split()[4], "changed", 1)) for k, (_, t) in enumerate(g for g in good if len(g[1].split()) > 60)]
    rows += [(600, prose(rng, 30) + " " + ITEM), (601, prose(rng, 30) + " " + ITEM.replace("12", "90"))]
    rows += [(610, prose(rng, 30) + " write to ann.smith@mail.example.org now")]
    rows += [(700 + i, t) for i, t in AWKWARD if i and i != 9] + [(rows[7][0], rows[7][1])]
    folder = tmp_path_factory.mktemp("corpus")
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns = docs.columns
    (_, good), (_, one), (_, clean), (_, private), (_, encoded) = corpus_pipeline.STAGES
    kept = good(spark, docs, corpus)
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert not [i for i, _ in rows if i < 300 and i % 6 == 0]
    assert {i for i in range(300) if i % 6} <= {i for i, _ in rows}
    distinct = one(spark, kept, corpus)
    wanted, _ = classes(rows, corpus_pipeline.WORDS, corpus_pipeline.NUMERATOR, corpus_pipeline.DENOMINATOR)
    assert sorted(r["doc_id"] for r in distinct.collect()) == sorted({c for c in wanted})
    unleaked = clean(spark, distinct, corpus)
    ids = {r["doc_id"] for r in unleaked.collect()}
    assert ids == {c for c in wanted} - {600, 601}
    safe = private(spark, unleaked, corpus)
    texts = {r["doc_id"]: r for r in safe.collect()}
    assert set(texts) == ids and "ann.smith@" not in texts[610]["text"]
    assert texts[610]["n_chars"] == len(texts[610]["text"]) and op3_surrogates.entities(texts[610]["text"])
    assert kept.columns == distinct.columns == unleaked.columns == safe.columns == columns
    encode = bpe_files.encoding(bpe_files.default_path()).encode_ordinary
    for r in encoded(spark, safe, corpus).collect():
        text = texts[r["doc_id"]]["text"] or ""
        assert r["n_tokens"] == len(encode(text))
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_run_gives_the_rows_of_the_stages(spark, corpus):
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, corpus).select("doc_id").collect()} >= {1, 2, 3, 610}


def test_empty_corpus(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, corpus)
        assert docs.count() == 0


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
