import random

import pytest
import tiktoken

from cliploom.llm import tokens


@pytest.fixture(scope="module")
def ranks():
    return tokens.load_ranks("byte_bpe_50k")


@pytest.fixture(scope="module")
def peer(ranks):
    return tiktoken.Encoding("peer", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_against_a_public_encoder(ranks, peer):
    bpe, rng = tokens.Bpe(ranks), random.Random(3)
    alphabet = "abcdefghij  \n\t'ñé一二三🎬​0123.,!?-_ABC�"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200))) for _ in range(400)]
    texts += ["a" * 5000, " " * 3000, "ab" * 4000 + "!", "一" * 2000, "<|endoftext|>", "don't we'll I've", " x", "x "]
    for t in texts:
        assert bpe.encode(t) == peer.encode_ordinary(t), t[:60]


def test_null_empty_blank_and_repeated(spark, ranks, peer):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "  "), (4, "hello world"), (4, "hello world")], "id int, text string")
    got = [(r[0], r[1]) for r in df.select("id", tokens.token_ids(spark, df.text).alias("ids")).collect()]
    hello = peer.encode_ordinary("hello world")
    assert got == [(1, []), (2, []), (3, peer.encode_ordinary("  ")), (4, hello), (4, hello)]
    counts = [r[0] for r in df.select(tokens.token_counts(spark, df.text)).collect()]
    assert counts == [len(peer.encode_ordinary(t or "")) for t in (None, "", "  ", "hello world", "hello world")]
    assert df.limit(0).select(tokens.token_ids(spark, df.text)).count() == 0


def test_segment_tree_takes_leftmost_of_equal():
    tree = tokens.SegmentTree([(5 << 4) | 0, (3 << 4) | 1, (3 << 4) | 2])
    assert tree.root() & 15 == 1
    tree.update(1, tokens._NONE)
    assert tree.root() & 15 == 2
