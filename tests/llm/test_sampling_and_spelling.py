"""Importance resampling and spelling variants against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import AWKWARD, documents, no_documents

from tripmill.llm import op11_importance, op12_spelling

LOWER = {c: c + 32 for c in range(65, 91)}
TARGET = ["the quick brown river", None, "Old fox; old bank", "", "日本語 word"]


def buckets(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    grams = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(g.encode()) % 10000 for g in grams]


def resampled(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets(text)[1])
    for text in target:
        t.update(buckets(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in rows:
        n_words, own = buckets(text)
        gain = [math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10000.0) / ((s[b] + 1.0) * (big_t + 10000.0)))) for b in own]
        weight = math.floor(sum(gain) / len(gain)) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, n_words, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: 25 * len(able) // 100], 1):
        r[5] = rank
    return Counter(map(tuple, out))


def benchmark(spark, target=TARGET):
    return spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id long, text string, weight int")


def test_resampling_equals_brute_force(spark):
    rows = [*AWKWARD, *[(100 + i, f"The old bank of word{i % 7}, " * (2 + i % 5) + AWKWARD[i % 4][1][:20 * (i % 3)] if AWKWARD[i % 4][1] else "x y " * 15) for i in range(120)]]
    rows += [(100, rows[-1][1])] * 3  # repeated rows under one id
    found = op11_importance.resampled(documents(spark, rows), benchmark(spark)).collect()
    own = Counter((r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found)
    assert own == resampled(rows, TARGET)


def test_long_texts_are_cut_without_losing_a_pair(monkeypatch):
    monkeypatch.setattr(op11_importance, "PIECE_BYTES", 64)
    texts = ["one, two three -- " * 30 + "end" * 40 + " after", "", "!" * 300 + "lone" + "?" * 300 + "pair", "short one", None, "ü" * 200 + " x"]
    total = [[] for _ in texts]
    for place, bucket, _ in op11_importance.own_features(pa.array(texts)):
        for p, b in zip(place.tolist(), bucket.tolist()):
            total[p].append(b)
    assert [sorted(x) for x in total] == [sorted(buckets(t)[1]) for t in texts]


@pytest.mark.parametrize("b", ["", "a", "word", "日本語", "z" * 64])
def test_crc_of_joined_texts(b):
    first = np.array([zlib.crc32(x.encode()) for x in ("", "Ä", "some text ")], dtype=np.uint32)
    data = b.encode()
    made = op11_importance.joined_crc(first, np.full(3, zlib.crc32(data), dtype=np.uint32), np.full(3, len(data)))
    assert made.tolist() == [zlib.crc32(x.encode() + data) for x in ("", "Ä", "some text ")]


def test_resampling_of_nothing(spark):
    assert op11_importance.resampled(no_documents(spark), benchmark(spark)).count() == 0
    one = op11_importance.resampled(documents(spark, [(1, "a b " * 40)] * 8), benchmark(spark, [])).collect()
    assert sorted(r["rank"] for r in one if r["rank"]) == [1, 2]


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelled(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: [v for v in n if one_edit(v, w)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def misspelt_rows(seed=3, n=220):
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdeéßx"))
    base = ["".join(rng.choice(letters, size=rng.integers(6, 12))) for _ in range(25)]
    words = []
    for w in base:
        for k in range(6):
            at = int(rng.integers(0, len(w)))
            c = str(rng.choice(letters))
            words += [w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :]]
    words += base * 40
    chosen = [str(rng.choice(words)) for _ in range(n * 60)]
    return [(i, " ".join(chosen[i * 60 : i * 60 + 60]).replace("abc", "ABC", 1)) for i in range(n)]


@pytest.mark.parametrize("block", [2048, 3])
def test_spelling_variants_equal_brute_force(spark, monkeypatch, block):
    rows = [*AWKWARD, *misspelt_rows(), (None, "wordss " * 9), (7000, "aaaaaaa " * 30 + "aaaaaa " * 5 + "aaaaaaaa " * 150)]
    # Workers import the module anew, so the bound is passed through the closure of the reader under test.
    compare = op12_spelling._compare
    if block != op12_spelling.BLOCK_WORDS:

        def compare(batches, compare=op12_spelling._compare, block=block):
            import tripmill.llm.op12_spelling as module

            module.BLOCK_WORDS, before = block, module.BLOCK_WORDS
            try:
                yield from compare(batches)
            finally:
                module.BLOCK_WORDS = before

        monkeypatch.setattr(op12_spelling, "_compare", compare)
    found = op12_spelling.variants(documents(spark, rows)).collect()
    wanted = spelled(rows)
    assert len(wanted) > 100 and len({r[2] for r in wanted}) < len(wanted)
    assert {tuple(r) for r in found} == wanted and len(found) == len(wanted)


@pytest.mark.parametrize("seed", range(5))
def test_scan_of_a_sorted_list(seed):
    rng = np.random.default_rng(seed)
    words = sorted({"".join(rng.choice(list("abc"), size=rng.integers(1, 7))) for _ in range(300)})
    assert set(op12_spelling.near_in(words)) == {
        (i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])
    }


def test_every_filed_pair_counts_once():
    words = ["aaaaaa", "aaaaaaa", "aaaaab", "baaaaa", "aaabaaa", "abcdef", "abcde", "bcdef", "xabcdef"]
    for u in words:
        for v in words:
            if u < v and one_edit(u, v):
                m = min(len(u), len(v))
                for lo, hi in ((0, m // 2), (m // 2, m)):
                    at = min(op12_spelling.common_prefix(u, v), m - 1)
                    if lo <= at < hi:
                        assert op12_spelling._filed(lo, hi, m, u) == op12_spelling._filed(lo, hi, m, v)


def test_no_documents_have_no_words(spark):
    assert op12_spelling.variants(no_documents(spark)).count() == 0


def test_long_texts_are_cut_outside_of_words(monkeypatch):
    monkeypatch.setattr(op12_spelling, "PIECE_CHARS", 10)
    text = "alpha beta,gammadeltaepsilon zeta  " * 5
    cut = list(op12_spelling._pieces(text))
    assert "".join(cut) == text
    assert [w for p in cut for w in re.findall("[a-z]+", p)] == re.findall("[a-z]+", text)
