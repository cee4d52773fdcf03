from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from wattloom.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_shared_cuts_equal_the_common_values():
    rng = np.random.default_rng(1)
    for k in range(60):
        a = np.unique(rng.integers(0, 400, rng.integers(1, 120)))
        b = np.unique(rng.integers(0, 400, rng.integers(1, 120)))
        if k % 5 == 0:
            b = b[~np.isin(b, a)]
        i, j = align.shared_cuts(a, b, np.array([[0, len(a), 0, len(b)]]))
        assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
    lo, hi = np.array([0, 2, 4, 6, 8]), np.array([1, 2, 6, 7, 8])
    i, j = align.shared_cuts(lo, hi, np.array([[0, 2, 0, 2], [3, 5, 2, 5]]))
    assert lo[i].tolist() == [2, 6, 8]  # 4..: spans keep apart
    assert j.tolist() == [1, 2, 4]


def plain(texts):
    """The contract in plain Python: every pair of ends compared by value."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    a_bytes, b_bytes = align.byte_level_tokens(A), align.piece_tokens(B)
    rows, links = [], []
    for text in texts:
        whole = b" " + (text or "").encode()
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        good = text and b"".join(a_bytes[i] for i in a) == whole and b"".join(b_bytes[i] for i in b) == whole
        if not good:
            rows.append((0, 0, 0, 0, ""))
            links.append([])
            continue
        ends_a, ends_b, at = {}, {}, 0
        for k, i in enumerate(a):
            at += len(a_bytes[i])
            ends_a[at] = k
        at = 0
        for k, i in enumerate(b):
            at += len(b_bytes[i])
            ends_b[at] = k
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, x, y = [], 0, 0
        for c in cuts:
            p, q = ends_a[c] + 1, ends_b[c] + 1
            groups.append(",".join(map(str, a[x:p])) + "|" + ",".join(map(str, b[y:q])))
            x, y = p, q
        rows.append((len(a), len(b), len(groups), len(cuts), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append([(a[ends_a[c]], b[ends_b[c]]) for c in cuts])
    counts = Counter(p for own in links for p in own)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [
        (*row, sum(counts[p] == most[p[1]] for p in own), sum(counts[p] for p in own))
        for row, own in zip(rows, links)
    ]


NAMES = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


def test_equal_to_plain_python(table, corpus):
    rng = random.Random(3)
    texts = [t for _, t, _ in corpus]
    texts += ["a <|endoftext|> b", "<s> </s> <unk>", "x\u0000y", "▁▁ spaces", "  two  ", "\t\n\r", "naïve café — “x”", "🙂🙂‍👩‍👧", "a" * 5000]
    texts += ["".join(chr(rng.choice([32, 10, 97, 101, 233, 0x4E2D, 0x1F600, 0x2581, 49])) for _ in range(n)) for n in range(1, 60)]
    rows = [(k, t, k, "x") for k, t in enumerate(texts)] + [(None, "no id", 0, None), (0, "again", 0, None)]
    docs = table(rows, "doc_id long, text string, n_a long, links string").repartition(5)
    got = align.link_quality(docs, A, B).collect()
    want = plain([t for _, t, _, _ in rows])
    seen = Counter((r["doc_id"], *(r[n] for n in NAMES)) for r in got)
    assert seen == Counter((k, *w) for (k, *_), w in zip(rows, want))


def test_groups_hold_all_ids_in_order(table, corpus):
    docs = table([(k, t) for k, (_, t, _) in enumerate(corpus)], "doc_id long, text string")
    a_bytes, b_bytes = align.byte_level_tokens(A), align.piece_tokens(B)
    for row in align.align(docs, A, B, with_groups=True).collect():
        text = corpus[row["doc_id"]][1]
        for side, tokens in (("a", a_bytes), ("b", b_bytes)):
            assert b"".join(tokens[i] for g in row["groups"] for i in g[side]) == (b" " + text.encode() if row["n_a"] else b"")
        assert all(
            b"".join(a_bytes[i] for i in g["a"]) == b"".join(b_bytes[i] for i in g["b"]) for g in row["groups"]
        )


def test_empty_table(table):
    got = align.link_quality(table([], "doc_id long, text string"), A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert got.count() == 0


def test_linked_tokens_are_suffixes():
    codes = align.linkable([b"", b"ab", b"b"], [b"b", b"ab", b"xab", b"c", b""])
    assert [divmod(int(c), 5) for c in codes] == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2)]
