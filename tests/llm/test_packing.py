import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tradelake.llm import packing as P


def library():
    import public_tokenizers
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_the_library():
    rng, tk, enc = random.Random(1), library(), P.encoder("byte_bpe_50k")
    texts = ["", " ", "a  b", "a \n b", "don't 's", "\tx\t y", "a<|endoftext|>b", "line\nline\n\nend ", "x\0y", "é😀 ü"]
    texts += ["".join(rng.choice("ab 's\n\t,.é0 ") for _ in range(rng.randrange(40))) for _ in range(800)]
    for t in texts:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == tk.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces_cover_every_document_and_sequences_are_tight(docs):
    rng, tk = random.Random(2), library()
    rows = [(i, " ".join(rng.choice(["river", "stone", "cloudy", "x1"]) for _ in range(rng.choice([0, 3, 200, 3000]))))
            for i in range(120)] + [(500, None), (501, "")]
    got = P.pack_documents(docs(rows)).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, text in rows:
        ids = tk.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert sum(r.length for r in got) / (2048 * len(by_seq)) > 0.9


def test_all_limits_hold_at_once(spark):
    rng = random.Random(3)
    rows = []
    for i in range(500):
        n = rng.randrange(1, 100)
        rows.append((i, n, rng.randrange(0, n + 1)))
    items = spark.createDataFrame(rows, "item long, tokens long, loss_tokens long")
    seqs = {}
    for r in P.pack(items, P.Limits(100, 4, 40 + 60), group_size=100).collect():
        seqs.setdefault(r.sequence_id, []).append(r)
    assert sum(map(len, seqs.values())) == 500
    for s in seqs.values():
        assert sum(r.tokens for r in s) <= 100 and len(s) <= 4 and sum(r.loss_tokens for r in s) <= 100


def test_dot_product_balances_dimensions():
    demand = np.array([[.9, .1], [.1, .9]] * 50)
    bins, _ = P.fill(demand)
    assert bins.max() + 1 == 50
    with pytest.raises(ValueError):
        P.fill(np.array([[1.5, 0.1]]))


def test_edges(docs):
    rows = P.pack_documents(docs([(None, "a"), (1, None), (1, None)])).collect()
    assert len(rows) == 3 and {r.length for r in rows if r.doc_id == 1} == {1}
    assert P.pack_documents(docs([])).count() == 0
