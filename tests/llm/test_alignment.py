"""Alignment of two tokenizers against a plain version."""

import hashlib
import random
from collections import Counter

import numpy as np
import sentencepiece
from tokenizers import Tokenizer

from meterflow.llm import token_alignment
from meterflow.llm.common import table, tokenizer_file

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
ODD = ["", None, " ", "  ", "a", " a", "a ", "a  ", "\n", "a \n b", "a  b", "a　 b  c", "x▁ y", "▁", "<s> </s><unk><0x41> <|endoftext|> b",
       "日本 語 テスト", "a\x00 b\x1c c!\x1c d", "don't  we'll\t x", "a\r\n b \x85 c", "🙂 🙂🙂  👩‍👩‍👧 z", "!\x1c !", "a​ b", "﻿ a"]


class Plain:
    """One text at a time by the libraries, cut where both sides' ends meet."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        own = token_alignment.Aligner(A, B)
        self.bytes_a, self.bytes_b = own.a_bytes, own.b_bytes

    def __call__(self, text):
        nothing = (0, 0, "", [])
        if not text:
            return nothing
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        for ids, of in ((a, self.bytes_a), (b, self.bytes_b)):
            if b"".join(of[i] for i in ids) != (" " + text).encode():
                return nothing
        ends_a, ends_b = (np.cumsum([len(of[i]) for i in ids]).tolist() for ids, of in ((a, self.bytes_a), (b, self.bytes_b)))
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            i2, j2 = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append(f"{','.join(map(str, a[i:i2]))}|{','.join(map(str, b[j:j2]))}")
            links.append((a[i2 - 1], b[j2 - 1]))
            i, j = i2, j2
        return len(a), len(b), ";".join(groups), links


def test_texts_against_the_plain_version():
    rng = random.Random(1)
    letters = " \n\t  ab'sé日🙂.1\x1c▁\x85\x00"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    own, plain = token_alignment.Aligner(A, B), Plain()
    n_a, n_b, n_groups, groups, pairs, times, lengths = own.texts(texts)
    at = 0
    for k, text in enumerate(texts):
        want = plain(text)
        assert (n_a[k], n_b[k], groups[k]) == want[:3], repr(text)
        assert n_groups[k] == (want[2].count(";") + 1 if want[2] else 0)
        found = dict(zip(pairs[at:at + lengths[k]].tolist(), times[at:at + lengths[k]].tolist()))
        assert found == Counter(a * len(own.b_bytes) + b for a, b in want[3])
        at += lengths[k]


def test_intervals_of_any_tokens():
    """Groups and overlaps of intervals that lie end to end, against all pairs."""
    rng = np.random.default_rng(2)
    for _ in range(200):
        cut = [np.unique(np.concatenate(([0, 60], rng.integers(1, 60, rng.integers(0, 25))))) for _ in range(2)]
        (a0, a1), (b0, b1) = ((c[:-1], c[1:]) for c in cut)
        over = set(zip(*(x.tolist() for x in token_alignment.overlaps(a0, a1, b0, b1)), strict=True))
        assert over == {(i, j) for i in range(len(a0)) for j in range(len(b0)) if a0[i] < b1[j] and b0[j] < a1[i]}
        group_a, group_b = token_alignment.coalesced(a0, a1, b0, b1)
        meet = sorted(set(a1.tolist()) & set(b1.tolist()))
        assert group_a.tolist() == [sum(m <= s for m in meet) for s in a0] and group_b.tolist() == [sum(m <= s for m in meet) for s in b0]
        assert all(group_a[i] == group_b[j] for i, j in over)


def test_small_stores_change_nothing(monkeypatch):
    monkeypatch.setattr(token_alignment, "REMEMBERED", 3)
    monkeypatch.setattr(token_alignment, "CALL_BYTES", 4)
    own, plain = token_alignment.Aligner(A, B), Plain()
    texts = ["the cat and the dog", "dog the  and", "x" * 70 + " cat cat", "one two three four five six", "the cat"] * 3
    for part in (texts[:4], texts[4:]):
        n_a, n_b, _, groups, *_ = own.texts(part)
        assert list(zip(n_a, n_b, groups)) == [plain(t)[:3] for t in part]


def expected(rows):
    plain = Plain()
    told = [plain(t) for _, t in rows]
    counts = Counter(link for t in told for link in t[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return sorted(((i, t[0], t[1], t[2].count(";") + 1 if t[2] else 0, len(t[3]), sum(counts[x] == most[x[1]] for x in t[3]),
                    sum(counts[x] for x in t[3]), hashlib.sha256(t[2].encode()).hexdigest() if t[0] else "") for (i, _), t in zip(rows, told, strict=True)), key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_scores_of_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(1, "the the cat"), (1, "the the cat"), (None, "the dog"), (None, None), (77, "ü" * 30_000)]
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, row int, pair string")
    got = token_alignment.link_scores(docs, A, B)
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr) == expected(rows)
    assert token_alignment.link_scores(docs.limit(0), A, B).count() == 0


def test_scores_of_the_given_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = token_alignment.link_scores(docs.repartition(5), A, B)
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr) == expected(rows)


def test_pair_counts_have_their_bound(spark, sf_dir):
    """Linked tokens end each other, which bounds the table that is broadcast."""
    own = token_alignment.aligner(A, B)
    pairs = token_alignment.align(table(spark, sf_dir, "documents"), A, B).selectExpr("explode(pairs) p").distinct().collect()
    for (p,) in pairs:
        a, b = own.a_bytes[p // len(own.b_bytes)], own.b_bytes[p % len(own.b_bytes)]
        assert a.endswith(b) or b.endswith(a)
    assert len(pairs) <= sum(map(len, own.a_bytes)) + sum(map(len, own.b_bytes)) < 600_000
