"""Length histogram, training-order shards and merge replay against the library encoder."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from helpers_llm import AWKWARD, documents, no_documents

from tripmill.llm import bpe_files, op1_token_counts, op5_training_order, op9_merge_replay

encode = bpe_files.encoding(bpe_files.default_path()).encode_ordinary


def lengths():
    return [len(encode(t)) if t else 0 for _, t in AWKWARD]


def test_suffix_sums_match_brute_force(spark):
    sums = op1_token_counts.suffix_sums(op1_token_counts.length_histogram(documents(spark))).collect()
    own = lengths()
    assert {r["n_tokens"]: r["n_docs"] for r in sums} == Counter(own)
    for r in sums:
        limit = r["n_tokens"]
        assert r["docs_within"] == sum(n <= limit for n in own)
        assert r["docs_over"] == sum(n > limit for n in own)
        assert r["tokens_within"] == sum(n for n in own if n <= limit)
        assert r["tokens_over"] == sum(n for n in own if n > limit)
        assert r["tokens_truncated"] == sum(min(n, limit) for n in own)
        assert r["quantile"] == r["docs_within"] / len(own)


def test_totals_for_any_limit_and_quantiles(spark):
    histogram = op1_token_counts.length_histogram(documents(spark))
    own = lengths()
    for r in op1_token_counts.totals_at(histogram, [1, 9, 100, 10**6]).collect():
        assert r["tokens_truncated"] == sum(min(n, r["context_limit"]) for n in own)
        assert r["docs_within"] == sum(n <= r["context_limit"] for n in own)
    found = {r["share"]: r["length"] for r in op1_token_counts.quantiles(op1_token_counts.suffix_sums(histogram), [0.5, 1.0]).collect()}
    assert found == {0.5: sorted(own)[len(own) // 2 - 1], 1.0: max(own)}


def test_no_documents_give_no_rows(spark, tmp_path):
    empty = no_documents(spark)
    assert op1_token_counts.suffix_sums(op1_token_counts.length_histogram(empty)).count() == 0
    assert op9_merge_replay.encode_documents(empty).count() == 0
    shards, rows = op5_training_order.write_training_order(empty, str(tmp_path / "none"))
    assert rows.count() == 0 and shards.n_sequences == 0


def test_merge_replay_equals_the_library(spark):
    rows = op9_merge_replay.encode_documents(documents(spark), keep_ids=True).collect()
    assert sorted(((r["doc_id"] is None, r["doc_id"]), r["n_tokens"]) for r in rows if r["doc_id"]) == sorted(
        ((False, i), n) for (i, _), n in zip(AWKWARD, lengths()) if i
    )
    wanted = Counter()
    for i, text in AWKWARD:
        ids = np.array(encode(text or ""), dtype="<u4").tobytes()
        wanted[i, ids, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], bytes(r["ids"]), r["ids_sha256"], r["decoded_sha256"]) for r in rows) == wanted


@pytest.mark.parametrize("word", ["aaaa", "aaaaa", "abababab", "!!!!!!!!!!!", "xyzzy" * 50, "日本語日本語", "=" * 999])
def test_replay_of_runs(word):
    path = bpe_files.default_path()
    ids, offsets = op9_merge_replay.encode_block([word, word + "b", ""], path, bpe_files.public_tokenizers.PATTERN)
    assert ids[: offsets[1]].tolist() == encode(word)
    assert ids[offsets[1] : offsets[2]].tolist() == encode(word + "b")
    assert offsets[3] == offsets[2]


def test_words_with_a_lower_rank_after_a_merge():
    """A made-up vocabulary where merging creates a pair that comes first: such words go one by one."""
    vocab = op9_merge_replay.Vocabulary.__new__(op9_merge_replay.Vocabulary)
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 257, b"bcd": 258, b"xa": 259}
    vocab.rank, vocab.bytes = ranks, [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
    vocab.byte_ids = np.arange(256)
    joined = {
        ranks[t[:c]] << 32 | ranks[t[c:]]: r for t, r in ranks.items() for c in range(1, len(t)) if t[:c] in ranks and t[c:] in ranks
    }
    vocab.pairs = np.array(sorted(joined), dtype=np.int64)
    vocab.pair_ranks = np.array([joined[p] for p in sorted(joined)], dtype=np.int64)
    words = [b"abcbcd", b"bcbc", b"xabc", b"q", b"abcd" * 5]
    ids, offsets = op9_merge_replay.replay(words, vocab)
    for i, w in enumerate(words):
        parts = [bytes([b]) for b in w]
        while True:
            best = min(((ranks[parts[k] + parts[k + 1]], k) for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in ranks), default=None)
            if best is None:
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        assert ids[offsets[i] : offsets[i + 1]].tolist() == [ranks[p] for p in parts]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_feistel_is_a_bijection(n):
    order = op5_training_order.Feistel(n, 99)
    slots = order.slot(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert order.sequence(slots).tolist() == list(range(n))
    assert n < 100 or slots.tolist() != op5_training_order.Feistel(n, 100).slot(np.arange(n)).tolist()


def test_shards_hold_every_token_once_and_can_be_resumed(spark, tmp_path):
    docs, stride = documents(spark).repartition(3, "doc_id"), 16
    end = max(bpe_files.ranks(bpe_files.default_path()).values()) + 1
    shards, rows = op5_training_order.write_training_order(docs, str(tmp_path / "out"), stride=stride, shard_slots=64)
    written = rows.orderBy("slot").collect()
    assert [r["slot"] for r in written] == list(range(shards.n_sequences))
    got = list(op5_training_order.read_slots(shards, 0))
    assert [hashlib.sha256(g.tobytes()).hexdigest() for g in got] == [r["sha256"] for r in written]
    assert all((a == b).all() for a, b in zip(op5_training_order.read_slots(shards, 100), got[100:]))
    stream = np.concatenate([got[s] for s in op5_training_order.Feistel(shards.n_sequences, shards.key).slot(np.arange(len(got)))])
    kept, pieces = [], []
    for token in stream.tolist():
        if token == end:
            pieces.append(tuple(kept))
            kept = []
        else:
            kept.append(token)
    wanted = Counter(tuple(encode(t)) for _, t in AWKWARD if t is not None)
    filled = sum(len(p) + 1 for p in wanted.elements())
    assert Counter(pieces[: len(list(wanted.elements()))]) == wanted
    assert set(stream[filled:].tolist()) <= {end}
