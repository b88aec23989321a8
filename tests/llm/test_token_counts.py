import math
import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from tradelake.llm import token_counts as T


def reference(vocab, fallback):
    tk = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=fallback))
    tk.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return lambda t: len(tk.encode(t, add_special_tokens=False).ids)


def texts(n, letters):
    rng = random.Random(5)
    return ["", " ", "  a  b ", "▁▁a", "x" * 400, " lead", "trail ", "😀😀 a"] + [
        "".join(rng.choice(letters) for _ in range(rng.randrange(25))) for _ in range(n)]


def test_public_vocabulary_against_the_library():
    vocab = T.vocabulary()
    own, ref = T.UnigramCounter(vocab), reference(vocab, True)
    assert all(own.text(t)[0] == ref(t) for t in texts(500, "ab ▁é😀\n<>0xAthe ing"))


@pytest.mark.parametrize("seed", range(5))
def test_ties_and_unknown_characters(seed):
    rng = random.Random(seed)
    vocab = [("<unk>", 0.0), ("▁", -1.0)] + list({
        "".join(rng.choice("ab▁") if i == 0 else rng.choice("ab") for i in range(rng.randrange(1, 4))):
        float(-rng.randrange(1, 4)) for _ in range(8)}.items())
    own, ref = T.UnigramCounter(vocab), reference(vocab, False)
    assert [own.text(t)[0] for t in texts(300, "abc ▁")] == [ref(t) for t in texts(300, "abc ▁")]


def test_rows(docs):
    rows = T.token_counts(docs([(1, "the cat"), (1, "the cat"), (None, "x"), (2, None), (3, "")])).collect()
    assert len(rows) == 5
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {0}
    assert T.token_counts(docs([])).count() == 0


def test_documents_against_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = [(-1 - i, t) for i, t in enumerate(texts(0, "") + ["<s> <0x41> <unk>", "a\tb\n c", "  two  blanks", "word " * 20_000])]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    vocab = T.vocabulary()
    ref = reference(vocab, True)
    expected = {r.doc_id: ref(r.text) if r.text else 0 for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in T.token_counts(docs).collect()} == expected


def test_scores_are_probabilities():
    scores = [s for _, s in T.vocabulary()]
    assert math.isclose(math.fsum(map(math.exp, scores)), 1.0) and scores == sorted(scores, reverse=True)
