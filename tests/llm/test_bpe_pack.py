from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import pytest

from wattloom.llm import bpe, pack

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def fuzz(n=4000):
    rng = np.random.default_rng(1)
    parts = [*"aZ09 '\n\t!.stmdrevl  é中 　½٣😀", "'s", "'re", "'ll", " '", "'S", "<|endoftext|>", "\x85", "́"]
    return ["".join(rng.choice(parts, rng.integers(0, 60))) for _ in range(n)]


def test_encoding_equals_the_library(reference, monkeypatch):
    texts = [*fuzz(), "", "x" * 3000, " " * 999, "'", "''s", "a'", "word " * 50_000]
    for chars, block in ((bpe.CHARS, bpe.BLOCK), (500, 7)):  # also with very short blocks
        monkeypatch.setattr(bpe, "CHARS", chars)
        monkeypatch.setattr(bpe, "BLOCK", block)
        own = bpe.Encoder(RANKS)
        own.cache.size = 300
        for text, ids in zip(texts, own.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
            assert own.decode(ids) == text.encode()
            if len(ids):
                assert own.offsets(ids)[-1] == len(text.encode())


def test_digests_of_a_table(docs, corpus, no_docs, reference):
    got = {(r[0], r[3]): r for r in bpe.digests(docs, RANKS).collect()}
    for doc_id, text, _ in corpus:
        raw = (text or "").encode()
        r = got[(doc_id, hashlib.sha256(raw).hexdigest())]
        ids = np.array(reference.encode_ordinary(text or ""), "<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
    assert bpe.digests(no_docs, RANKS).count() == 0
    ends = bpe.encode(docs, RANKS).filter("doc_id = -5").first()
    assert len(ends["ids"]) == len(ends["token_ends"])


def check_packing(pieces, texts, size, end_id):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(JSON)
    ids = [np.array([*e.ids, end_id], "<u4") for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert sum(p["length"] for p in pieces) == sum(map(len, ids))
    assert sorted(p["doc_tokens"] for p in pieces if p["start"] == 0) == sorted(map(len, ids))
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append(p)
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
    padding = 0
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert 0 < at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return ids, padding


def test_packing_covers_every_token_once(docs, corpus):
    texts = [t or "" for _, t, _ in corpus]
    pieces = pack.pack(docs, JSON, 256, 1).collect()
    ids, padding = check_packing(pieces, texts, 256, 1)
    assert padding == 0
    for doc, own in zip(corpus, ids):
        if doc[0] is not None:
            parts = sorted((p for p in pieces if p["doc_id"] == doc[0]), key=lambda p: p["start"])
            assert b"".join(p["ids"] for p in parts) == own.tobytes()
            assert [p["start"] for p in parts] == np.cumsum([0, *[p["length"] for p in parts[:-1]]]).tolist()


def test_special_strings_and_odd_words_are_encoded_as_the_tokenizer_does(table):
    """The plain call: the string of a special token is that token."""
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(JSON), np.random.default_rng(6)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "<|endoftext| >", "", " ", "  two", " ª º ǅ ﬁ x"]
    letters = [chr(c) for c in [32, 32, 32, 97, 233, 0x301, 0x4E2D, 0x5D0, 0x660, 0x1F600, 0x10428, 0x16A0, 10, 39, 0x2160, 0xAA, 0x345]]
    texts += ["".join(rng.choice(letters, rng.integers(1, 40))) for _ in range(400)]
    texts += [" ".join("".join(rng.choice(list("abcdeé"), rng.integers(1, 9))) for _ in range(300))]
    got = list(pack.tokenise(texts, JSON, 1))
    assert [x.tolist() for x in got] == [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    rows = table([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    check_packing(pack.pack(rows, JSON, 64, 1).collect(), texts, 64, 1)


def test_packing_repeated_rows_many_partitions_and_empty_table(table, no_docs, monkeypatch):
    monkeypatch.setattr(pack, "MERGE", 2)
    rows = [(3, "same words here", "x")] * 40 + [(None, None, None)] * 3
    docs = table(rows, "doc_id long, text string, length string").repartition(7)
    check_packing(pack.pack(docs, JSON, 64, 1).collect(), [r[1] or "" for r in rows], 64, 1)
    assert pack.pack(no_docs, JSON).count() == 0
    with pytest.raises(ValueError):
        pack.pack(no_docs, JSON, 100)


def test_windows_stay_bounded_and_fill():
    windows = pack.Windows(64, 0, keep=4)
    rng = np.random.default_rng(0)
    for k in range(500):
        n = int(rng.integers(1, 200))
        windows.add(k, 0, n, np.zeros(n, np.uint32))
        assert len(windows.held) <= 4
    windows.finish()
    sizes = [sum(len(p[3]) for p in content) for _, content in windows.closed]
    assert all(s == 64 for s in sizes[:-7]) and all(s & (s - 1) == 0 for s in sizes)


def test_workers_hold_no_cached_pieces_after_packing(spark, table):
    """Workers are used again by other steps, beside which a full cache would lie."""
    docs = table([(k, f"odd{k} words{k * 7}") for k in range(400)], "doc_id long, text string").repartition(4)
    assert pack.pack(docs, JSON, 64, 1).count() > 0
    path = JSON

    def held(batches):
        import pyarrow as pa

        for _ in batches:
            known = [x.cache for x in (pack._tokenizers.get(path),) if x]
            yield pa.record_batch({"known": pa.array([len(known)]), "n": pa.array([sum(len(x.young) + len(x.old) for x in known)])})

    rows = spark.range(0, 64, 1, 16).mapInArrow(held, "known long, n long").collect()
    assert sum(r["known"] for r in rows) > 0 and sum(r["n"] for r in rows) == 0
