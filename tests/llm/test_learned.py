"""Languages, quality and toxicity on small labelled sets, and their awkward cases."""

import random

import numpy as np
import pytest
from helpers_llm import AWKWARD, documents, no_documents
from pyspark.sql import functions as F

from tripmill.llm import op2_context_trees, op4_discriminant, op6_classifier_chain
from tripmill.llm.common import bounded_sample

EN = "the a of and to in that with for was were house river garden people water light morning evening walked found".split()
DE = "der die das und zu in mit für war waren haus fluss garten leute wasser licht morgen abend ging fand ich über".split()


def prose(rng, words, n=60):
    return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, EN if i % 2 else DE), "en" if i % 2 else "de") for i in range(120)]
    return spark.createDataFrame([*rows, (None, "no id", "en"), (900, None, "en"), (901, "x", None)], "doc_id long, text string, lang string")


def test_code_lengths_are_a_distribution(labelled):
    model = op2_context_trees.train(labelled)
    assert model.names == ["de", "en"]
    for context in (b"the ", b"zq\xffx", b"\0\0\0\0", b"und "):
        keys = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], dtype=np.uint64)
        for tree in model.trees:
            assert np.exp2(-tree.code_lengths(keys)).sum() == pytest.approx(1.0, abs=1e-9)


def test_code_lengths_equal_a_plain_tree():
    """Against a byte-by-byte computation with dictionaries and explicit exclusion sets."""
    rng = random.Random(3)
    data, probe = bytes(rng.choice(b"abc") for _ in range(400)), bytes(rng.choice(b"abcd") for _ in range(60))
    keys, counts = np.unique(op2_context_trees.grams([data])[0], return_counts=True)
    tree, order = op2_context_trees.Tree(keys, counts), op2_context_trees.ORDER
    seen: dict[bytes, dict[int, int]] = {}
    padded = b"\0" * order + data
    for i in range(order, len(padded)):
        for k in range(order + 1):
            own = seen.setdefault(padded[i - k : i], {})
            own[padded[i]] = own.get(padded[i], 0) + 1
    padded, bits = b"\0" * order + probe, 0.0
    for i in range(order, len(padded)):
        excluded: set[int] = set()
        for k in range(order, -1, -1):
            own = seen.get(padded[i - k : i])
            if own is None:
                continue
            left = {s: n for s, n in own.items() if s not in excluded}
            whole = sum(left.values()) + len(left)
            if padded[i] in left:
                bits -= np.log2(left[padded[i]] / whole)
                break
            if left:
                bits -= np.log2(len(left) / whole)
            excluded |= set(own)
        else:
            bits -= np.log2(1 / (256 - len(excluded)))
    assert tree.code_lengths(op2_context_trees.grams([probe])[0]).sum() == pytest.approx(bits)


def test_a_long_text_is_scored_in_blocks(spark, labelled, monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdé ß") for _ in range(n)) for n in (3000, 1, 257, 64, 0, 5)]
    whole = [np.sort(op2_context_trees.grams([t.encode()])[0]) for t in texts]
    monkeypatch.setattr(op2_context_trees, "BLOCK", 64)
    for text, wanted in zip(texts, whole):
        runs = list(op2_context_trees.gram_runs([text.encode()]))
        assert all(len(keys) <= 64 for keys, _ in runs)
        assert (np.sort(np.concatenate([k for k, _ in runs] or [np.zeros(0, dtype=np.uint64)])) == wanted).all()


def test_languages_of_held_out_texts(spark, labelled):
    rng = random.Random(6)
    model = op2_context_trees.train(labelled)
    rows = [(i, prose(rng, EN if i % 2 else DE, 15).upper()) for i in range(60)]
    found = op2_context_trees.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert all(r["lang_pred"] == ("en" if r["doc_id"] % 2 else "de") and 0.5 < r["score"] <= 1 for r in found)


def test_languages_of_awkward_texts(spark, labelled):
    model = op2_context_trees.train(labelled)
    found = op2_context_trees.identify(documents(spark), model).collect()
    assert len(found) == len(AWKWARD)
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (3, 4, 5, 6))
    assert by_id[1]["lang_pred"] == by_id[2]["lang_pred"] == "en"
    assert op2_context_trees.identify(no_documents(spark), model).count() == 0
    untrained = op2_context_trees.train(labelled.filter("lang = 'xx'"))
    assert {r["lang_pred"] for r in op2_context_trees.identify(documents(spark), untrained).collect()} == {"und"}


def test_bounded_sample_keeps_small_groups_whole(spark):
    rows = spark.range(5000).selectExpr("id", "if(id < 30, 'few', 'many') AS kind")
    got = {r["kind"]: r["count"] for r in bounded_sample(rows, rows["id"], "kind", 400).groupBy("kind").count().collect()}
    assert got["few"] == 30 and 300 < got["many"] < 500


def quality_rows(rng, n):
    rows = []
    for i in range(n):
        text = prose(rng, EN, rng.randint(5, 120))
        if i % 4 == 0:
            text = [" ".join(w.upper() + "!!" for w in text.split()), " ".join(w + "%%%" for w in text.split()), " ".join(w + " " + w for w in text.split())][i // 4 % 3]
        rows.append((i, text, int(i % 4 != 0)))
    return rows


def test_quality_on_held_out_texts(spark):
    rng = random.Random(8)
    rows = quality_rows(rng, 800)
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = op4_discriminant.fit(frame.filter("doc_id < 600").select("doc_id", "text"), frame.select("doc_id", "quality"))
    scores = model.scores(op4_discriminant.statistics([t for _, t, _ in rows[600:]]))
    wrong = [(s, q) for s, (_, _, q) in zip(scores, rows[600:]) if (s >= op4_discriminant.THRESHOLD) != (q == 1)]
    assert len(wrong) <= 4


def test_quality_scores_equal_the_formula(spark):
    rng = random.Random(9)
    rows = quality_rows(rng, 200)
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(5)
    model = op4_discriminant.fit(frame.select("doc_id", "text"), frame.select("doc_id", "quality"))
    x = op4_discriminant.statistics([t for _, t, _ in rows])
    y = np.array([q for _, _, q in rows])
    pooled = sum(np.cov(x[y == c].T) * (np.sum(y == c) - 1) for c in (0, 1)) / (len(y) - 2)
    logs = []
    for c in (0, 1):
        s = (1 - op4_discriminant.TO_POOLED) * np.cov(x[y == c].T) + op4_discriminant.TO_POOLED * pooled
        s = (1 - op4_discriminant.TO_IDENTITY) * s + op4_discriminant.TO_IDENTITY * np.trace(s) / len(s) * np.eye(len(s))
        d = x - x[y == c].mean(axis=0)
        logs.append(np.log(np.mean(y == c)) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ni,ij,nj->n", d, np.linalg.inv(s), d))
    wanted = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
    assert np.allclose(model.scores(x), wanted, atol=1e-6)


def test_statistics_do_not_depend_on_neighbours():
    texts = [t for _, t in AWKWARD]
    together = op4_discriminant.statistics(texts)
    assert np.allclose(together, np.vstack([op4_discriminant.statistics([t]) for t in texts]))
    assert (together[3] == 0).all() and (together[2] == 0).all()
    assert op4_discriminant.statistics(["ha ha ha ha"])[0, -3] == pytest.approx(np.sqrt(3 / (4 + op4_discriminant.EXTRA_WORDS)))


@pytest.mark.parametrize(("marks", "score"), [([], 0.5), ([1, 1], 1.0), ([0], 0.0), ([None, 7], 0.5)])
def test_quality_without_both_labels(spark, marks, score):
    labels = spark.createDataFrame([(i + 1, m) for i, m in enumerate(marks)], "doc_id long, quality int")
    model = op4_discriminant.fit(documents(spark), labels)
    got = documents(spark).select(op4_discriminant.quality_score(F.col("text"), model).alias("s")).collect()
    assert len(got) == len(AWKWARD) and {r["s"] for r in got} == {score}


def toxic_rows(rng, n):
    rows = []
    for i in range(n):
        text = prose(rng, EN, 40).split()
        if i % 5 == 0:
            text.insert(rng.randrange(len(text)), rng.choice(["idiot", "scum", "pathetic", "blargh"]))
        rows.append((i, " ".join(text), int(i % 5 == 0)))
    return rows


def test_toxic_documents_are_found_and_clean_ones_left(spark):
    rows = toxic_rows(random.Random(11), 900)
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    chain = op6_classifier_chain.train(frame.select("doc_id", "text"), frame.filter("doc_id < 600").select("doc_id", "toxic"))
    assert "blargh" in chain.vocabulary
    found = op6_classifier_chain.score(frame.filter("doc_id >= 600").select("doc_id", "text"), chain).collect()
    assert all(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in found)
    scum = next(r for r in found if "scum" in rows[r["doc_id"]][1])
    assert scum["p_degrading"] > 0.5 > scum["p_insult"]


def test_many_toxic_words_are_all_learned(spark):
    rng = random.Random(12)
    bad = ["".join(rng.choice("bcdfgklmnprstvz") for _ in range(8)) for _ in range(300)]
    learned = [*((f"{prose(rng, EN, 40)} {w}", 1) for w in bad * 3), *((prose(rng, EN, 42), 0) for _ in range(900))]
    asked = [*((f"{prose(rng, EN, 40)} {w}", 1) for w in bad), *((prose(rng, EN, 42), 0) for _ in range(300))]
    frame = spark.createDataFrame([(i, t, m) for i, (t, m) in enumerate(learned + asked)], "doc_id long, text string, toxic int")
    first = F.col("doc_id") < len(learned)
    chain = op6_classifier_chain.train(frame.select("doc_id", "text"), frame.filter(first).select("doc_id", "toxic"))
    assert set(bad) <= chain.vocabulary.keys()
    found = op6_classifier_chain.score(frame.filter(~first).select("doc_id", "text"), chain).collect()
    assert [r["predicted"] for r in sorted(found, key=lambda r: r["doc_id"])] == [m for _, m in asked]


def test_later_links_use_earlier_probabilities():
    rng = np.random.default_rng(1)
    present = (rng.random((400, 3)) < 0.3).astype(float)
    first = present[:, 0]
    weights = op6_classifier_chain.fit_chain(present, np.column_stack([first, first]), np.arange(400) % op6_classifier_chain.FOLDS)
    assert [len(w) for w in weights] == [4, 5] and weights[1][4] > 0.5


def test_true_odds_reach_the_last_link_only(spark, monkeypatch):
    rows = toxic_rows(random.Random(4), 400)
    docs = documents(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, int(m)) for i, _, m in rows], "doc_id long, toxic int")
    fit, made = op6_classifier_chain.fit_chain, []
    monkeypatch.setattr(op6_classifier_chain, "fit_chain", lambda *a: made.append([w.copy() for w in fit(*a)]) or [w.copy() for w in made[0]])
    chain = op6_classifier_chain.train(docs, labels, per_label=30)
    assert all((a == b).all() for a, b in zip(chain.weights[:-1], made[0][:-1]))
    assert (chain.weights[-1][1:] == made[0][-1][1:]).all()
    assert chain.weights[-1][0] != made[0][-1][0]


def test_logistic_is_at_its_optimum():
    rng = np.random.default_rng(2)
    x = np.column_stack([np.ones(300), (rng.random((300, 4)) < 0.5).astype(float)])
    y = (rng.random(300) < 1 / (1 + np.exp(-(x @ np.array([-1, 2, -1, 0.5, 0]))))).astype(float)
    w = op6_classifier_chain.logistic(x, y)
    penalty = np.array([1e-3, *[op6_classifier_chain.PENALTY] * 4])
    assert np.abs(x.T @ (1 / (1 + np.exp(-(x @ w))) - y) + penalty * w).max() < 1e-4


def test_toxicity_of_awkward_texts(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (None, 1), (9, 7)], "doc_id long, toxic int")
    chain = op6_classifier_chain.train(documents(spark), labels)
    assert op6_classifier_chain.score(documents(spark), chain).count() == len(AWKWARD)
    assert op6_classifier_chain.score(no_documents(spark), chain).count() == 0
    none = op6_classifier_chain.train(documents(spark), labels.filter("toxic = 5"))
    assert {r["p_toxic"] for r in op6_classifier_chain.score(documents(spark), none).collect()} == {0.0}
