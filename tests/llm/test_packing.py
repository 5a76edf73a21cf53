"""op5 against the tokenizers library, and the genetic algorithm at work."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from stockroom.llm import packing  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "  ", None, "a\x00b a\x00 a", "\x00", "é" * 40, "Straße İstanbul ǅ", "<|endoftext|> x < | <|", "x" * 17, "X" * 16,
       "x" * 15 + "é", "a b c d", "\U0001F642\U0001F642 ‍ " * 9, "\x1c\x85 a", "it's I'M 'tis l'eau", "×÷ a×b", "0123 a1B2-c.d",
       "W" * 30_000, "ab " * 20_000, "ÀÉÎÕÜß ÿŸ"]


def _ids(texts):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(PATH)
    return [lib.encode(t or "", add_special_tokens=False).ids for t in texts]


def _more(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("aB é\U0001F642\x00'1-\tÀ.<|") for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("size", [600_000, 40])
def test_tokens_equal_the_library(size):
    tok, texts = packing.WordTokenizer(PATH, cache_size=size), ODD + _more(1500, 1)
    for i in range(0, len(texts), 100):          # a small table forgets and learns again
        got = [np.frombuffer(x, "<u4").tolist() for x in tok.encode_batch(texts[i:i + 100])]
        assert got == _ids(texts[i:i + 100])


def test_pieces_equal_the_library(spark):
    texts = ODD + _more(50, 2)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, region string, length int")
    want = set()
    for i, ids in enumerate(_ids(texts)):
        ids = [*ids, 0]
        for p, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at:at + 2048], "<u4").tobytes()
            want.add((i, p, at, len(part) // 4, zlib.crc32(part)))
    assert {tuple(r) for r in packing.cut_pieces(docs.repartition(3), PATH).collect()} == want


def test_crossover_and_mutation_bring_the_bins_down(monkeypatch):
    rng = np.random.default_rng(5)
    lengths = -np.sort(-rng.integers(20, 1400, 3000)).astype(np.int64)
    made, real = [], packing.crossover
    monkeypatch.setattr(packing, "crossover", lambda *a: made.append(1) or real(*a))
    history: list = []
    best = packing.evolve(lengths, [], 3, 2048, history=history)[0]
    floor = -(-int(lengths.sum()) // 2048)
    assert len(made) >= 6 and history[0] > floor + 5        # chance orders are not good enough
    assert history == sorted(history, reverse=True) and best.max() + 1 <= floor + 1
    assert np.bincount(best, weights=lengths).max() <= 2048 and (best >= 0).all()


def test_rows_without_an_id_are_spread_over_regions(spark):
    pieces = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
                                      F.lit(100).cast("long").alias("length"), F.lit(7).cast("long").alias("ids_crc32"))
    out = packing.pack_pieces(pieces, 6)
    regions = out.groupBy((F.col("sequence_id") / (1 << 32)).cast("int").alias("r")).count().collect()
    assert len(regions) == 6 and max(r["count"] for r in regions) < 700
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count_distinct("offset").alias("o"), F.count("*").alias("c")).where(
        "n > 2048 or o <> c").count() == 0
