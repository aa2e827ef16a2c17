"""Encoding and packing against the tokenizers library and plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterflow.llm import bpe_prefix, packing_mixture
from meterflow.llm.common import bytes_of, table, tokenizer_file

BYTES, WORDS = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")
LETTERS = "ab The'S'll  \n\t\r\x0b\x1c\x85   ́éÉßñ漢字🙂0123!!?--AKΣς_İKſ<>≠.,"


def strings(n, seed=3):
    rng = random.Random(seed)
    out = ["", " ", "<|endoftext|>", "a<|endoftext|> <|startoftext|>b", "a" * 5000, "\n\n x  y \n"]
    return out + ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 50))) + ("<|endoftext|>z" if k % 20 == 0 else "") for k in range(n)]


def test_bpe_equals_the_library():
    library, own = Tokenizer.from_file(BYTES), bpe_prefix.Vocabulary(BYTES)
    for text in strings(4000):
        ids = library.encode(text, add_special_tokens=False).ids
        told, decoded, n = own.encode(text)
        assert told == ",".join(map(str, ids)) and n == len(ids), repr(text)
        assert decoded.decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False) == own.decode(ids)


def test_every_token_is_its_own_encoding_or_not_as_merges_say():
    own = bpe_prefix.Vocabulary(BYTES)
    library = Tokenizer.from_file(BYTES)
    for i in range(300, 50_000, 97):
        text = own.text[i].decode("utf-8", "ignore")
        if text.encode() == own.text[i]:
            assert own.encode(text)[0] == ",".join(map(str, library.encode(text, add_special_tokens=False).ids))


def test_small_stores_change_nothing():
    """Generations that fill within a text, and parts met again in the old one."""
    library, own = Tokenizer.from_file(BYTES), bpe_prefix.Vocabulary(BYTES)
    own.most = 3
    for text in ["the cat and the dog", "dog the  and, and the", "x" * 70 + " cat cat", "one two three four five six", "the cat"] * 3:
        assert own.encode(text)[0] == ",".join(map(str, library.encode(text, add_special_tokens=False).ids))
    assert len(own.spaced) < 12 and len(own.old) < 12 and own.old


def test_bpe_query_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "the the", "x"), (3, "the the", "x"), (None, "ü" * 40_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    library = Tokenizer.from_file(BYTES)
    got = bpe_prefix.digests(docs, BYTES).collect()
    for r, (i, text, _) in zip(got, rows, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (r.doc_id, r.n_tokens) == (i, len(ids))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    plain = bpe_prefix.encode(docs, BYTES).collect()
    assert [r.decoded for r in plain] == [t or "" for _, t, _ in rows] and len(plain[0].ids) == 0
    assert bpe_prefix.digests(docs.limit(0), BYTES).count() == 0


def test_words_equal_the_library():
    own = packing_mixture.Words(WORDS)
    texts = strings(6000)
    for i in range(0, len(texts), 7):
        some = texts[i:i + 7]
        for text, ids in zip(some, own.encode(packing_mixture.loosened(*bytes_of(pa.array(some)))), strict=True):
            assert np.frombuffer(ids, own.kind).tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_with_small_stores(monkeypatch):
    monkeypatch.setattr(packing_mixture, "REMEMBERED", 5)
    own = packing_mixture.Words(WORDS)
    for some in (["the cat, and the dog", "a b c d e f g"], ["the DOG's é cat"], ["x y z the cat"], ["a b dog"]):
        for text, ids in zip(some, own.encode(packing_mixture.loosened(*bytes_of(pa.array(some)))), strict=True):
            assert np.frombuffer(ids, own.kind).tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("weighted", [False, True])
def test_rounds_place_each_token_once_and_hold_proportions(weighted):
    rng = random.Random(5)
    for _ in range(40):
        many = rng.randint(1, 9)
        totals = [rng.choice([0, 1, 3, rng.randint(0, 9000), rng.randint(0, 60_000)]) for _ in range(many)]
        weights = [rng.random() + 0.05 for _ in totals] if weighted else None
        rounds, pieces = packing_mixture.Rounds(totals, weights), []
        for queue, total in enumerate(totals):
            at = 0
            while at < total:
                pieces.append((queue, at, min(total - at, rng.randint(1, 3000))))
                at += pieces[-1][2]
        queue, first, n = (np.array([p[c] for p in pieces], dtype=np.int64) for c in range(3))
        which, start, length, place = rounds.place(queue, first, n)
        owner = np.full(sum(totals), -1)
        for w, a, size, p in zip(which, start, length, place, strict=True):
            assert size > 0 and p // 2048 == (p + size - 1) // 2048 and a + size <= n[w] and (owner[p:p + size] == -1).all()
            owner[p:p + size] = queue[w]
        assert (owner >= 0).all()
        if not weighted:
            for s in range(sum(totals) // 2048):
                share = np.bincount(owner[s * 2048:(s + 1) * 2048], minlength=many) - 2048 * np.array(totals) / max(1, sum(totals))
                assert np.abs(share).max() <= many + 1


def test_weights_hold_while_sources_last():
    rounds = packing_mixture.Rounds([40_000, 40_000], [3.0, 1.0])
    which, _, length, place = rounds.place(np.array([0, 1]), np.array([0, 0]), np.array([40_000, 40_000]))
    early = place < 20 * 2048
    assert abs(length[early & (which == 0)].sum() - 20 * 2048 * 0.75) < 2048


def test_large_totals_are_placed_exactly():
    """Products beyond 64 bits: offsets still leave no gap."""
    totals = [3 * 10**13, 10**13, 7]
    rounds = packing_mixture.Rounds(totals)
    at = 2 * 10**13
    which, start, length, place = rounds.place(np.array([0, 0]), np.array([at, at + 5000]), np.array([5000, 5000]))
    order = np.lexsort((start, which))
    joined = [(int(w) * 5000 + int(a), int(n), int(p)) for w, a, n, p in zip(which[order], start[order], length[order], place[order], strict=True)]
    assert sum(n for _, n, _ in joined) == 10_000
    assert all(b[0] == a[0] + a[1] and b[2] >= a[2] + a[1] for a, b in zip(joined, joined[1:], strict=False))


def checked(spark, docs, **settings):
    library = Tokenizer.from_file(WORDS)
    rows = packing_mixture.pack(docs, WORDS, with_ids=True, **settings).collect()
    pieces = {}
    for r in rows:
        assert r.length == len(r.ids) > 0 and r.offset + r.length <= 2048
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        pieces.setdefault(r.doc_id, []).append(r)
    want = {}
    for r in docs.select("doc_id", "text").collect():
        want.setdefault(r.doc_id, []).append([*library.encode(r.text or "", add_special_tokens=False).ids, 1])
    assert set(pieces) == set(want)
    for i, own in pieces.items():
        if len(want[i]) == 1:
            own.sort(key=lambda r: r.start)
            assert [x for r in own for x in r.ids] == want[i][0] and all(r.doc_tokens == len(want[i][0]) for r in own)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    sizes = []
    for spans in by_sequence.values():
        at = 0
        for a, n in sorted(spans):
            assert a == at
            at += n
        sizes.append(at)
    assert sorted(by_sequence) == list(range(len(by_sequence))) and sum(s < 2048 for s in sizes) <= 1
    assert sum(sizes) == sum(len(x) for many in want.values() for x in many)


def test_packing_equals_the_plain_version(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    checked(spark, docs)
    checked(spark, docs.repartition(5), queues=3)
    checked(spark, docs, weights={"src0": 5.0})


def test_packing_of_odd_rows(spark):
    rows = [(1, None, None, 1), (2, "", "a", 1), (3, "the end", "a", 1), (3, "the end", "a", 1), (None, "x y " * 3000, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, part int")
    checked(spark, docs)
    assert packing_mixture.pack(docs.limit(0), WORDS).count() == 0
    shares = packing_mixture.pack(docs, WORDS).agg(F.max("sequence_id")).first()[0]
    assert shares >= 2


def shares_of_sequences(rows, source_of):
    """Tokens of each source in each sequence."""
    out = {}
    for r in rows:
        out.setdefault(r.sequence_id, Counter())[source_of[r.doc_id]] += r.length
    return [out[s] for s in sorted(out)]


def test_every_one_of_a_thousand_sources_keeps_its_share(spark):
    """Sources beyond the cap stood in clumps: whole windows of the shared queue were one source's."""
    rng = random.Random(3)
    rows = [(i, "the cat and dog " * rng.randint(10, 40), f"site{i % 1000}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    checked(spark, docs)
    pieces = packing_mixture.pack(docs, WORDS).collect()
    source_of = {i: s for i, _, s in rows}
    assert len({r.queue for r in pieces}) == 1000
    windows = shares_of_sequences(pieces, source_of)
    total = sum(windows, Counter())
    everything = sum(total.values())
    for w in windows[:-1]:
        assert all(abs(w[s] - 2048 * n / everything) <= 4 for s, n in total.items())


def test_runs_of_many_sources_are_not_single_tokens(spark):
    """Pieces stay within tokens / run and documents; at no round's end has a source had more
    or less than its share by more than one run, however many rounds went before."""
    rng = random.Random(4)
    rows = [(i, "the cat and dog " * rng.randint(40, 160), f"site{i % 1000}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    checked(spark, docs, run=64)
    found = packing_mixture.pack(docs, WORDS, run=64).collect()
    tokens, source_of = sum(r.length for r in found), {i: s for i, _, s in rows}
    assert len(found) <= 1.5 * tokens / 64 + 3 * len(rows) + tokens / 2048
    windows, total = shares_of_sequences(found, source_of), Counter()
    for r in found:
        total[source_of[r.doc_id]] += r.length
    in_round = -(-64 * 1000 // 2048)
    for k in range(in_round, len(windows), in_round):
        so_far = sum(windows[:k], Counter())
        assert all(abs(so_far[s] - k * 2048 * n / tokens) <= in_round * 2048 * n / tokens + 8 for s, n in total.items())


def test_rounds_of_several_windows_place_each_token_once():
    rounds = packing_mixture.Rounds([90_000, 500, 3, 0], None, 3 * 2048)
    which, start, length, place = rounds.place(np.arange(4), np.zeros(4, dtype=np.int64), np.array([90_000, 500, 3, 0]))
    owner = np.full(90_503, -1)
    for w, n, p in zip(which, length, place, strict=True):
        assert (owner[p:p + n] == -1).all()
        owner[p:p + n] = w
    assert (owner >= 0).all() and np.bincount(owner).tolist() == [90_000, 500, 3]


def test_shared_sources_serve_by_weight_while_they_last(spark):
    """A weight given to a source that was not among the largest was ignored."""
    rows = [(i, "the cat and dog " * (4 + i % 7 * 20), f"site{i % 50}") for i in range(500)] + [(1000, "a dog " * 4000, "rare")]
    rows += [(2000, "one two " * 600, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    settings = {"weights": {"rare": 10.0}, "queues": 4}
    checked(spark, docs, **settings)
    pieces = packing_mixture.pack(docs, WORDS, **settings).collect()
    early = shares_of_sequences(pieces, {i: s for i, _, s in rows})[0]
    share = 2048 / 61
    assert abs(early["rare"] - 10 * share) <= len(early) == 52
    assert all(abs(n - share) <= 3 for s, n in early.items() if s != "rare")
