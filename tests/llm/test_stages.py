"""Stages keep a caller's columns whatever their names; packing cuts and places as a plain best fit does; empty tables."""

import zlib

import numpy as np


def test_columns_of_any_name_stay(spark, folder):
    from tidemark.llm.decontaminate import clean_documents
    from tidemark.llm.quality import kept_documents

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    named = docs.withColumnRenamed("key", "row_key").withColumnRenamed("n_words", "__key")
    labels, benchmark = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("labels", "benchmark"))
    for stage, other in ((kept_documents, labels), (clean_documents, benchmark)):
        got, want = stage(named, other), stage(docs, other)
        assert got.columns == named.columns
        assert sorted(map(repr, got.collect())) == sorted(repr(r).replace("key='x'", "row_key='x'").replace("n_words=", "__key=") for r in want.collect())


def test_pipeline_of_nothing(spark, empty):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, empty).count() == 0


def plain_sequences(lengths, capacity):
    """How many sequences best fit takes, the longest pieces first."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, left in enumerate(room) if left >= n]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= n
        else:
            room.append(capacity - n)
    return len(room)


def test_packing_of_long_texts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tidemark.llm import packing

    rng = np.random.default_rng(4)
    words = ["the", "Of,", "naïve", "漢字", "don't", "x1", "...", "<|end|>", "walking"]
    texts = [None, "", " "] + [" ".join(rng.choice(words, n)) for n in (1, 40, 900, 3000, 3000, 9000, *rng.integers(5, 3000, 40))] + ["same tie"] * 9
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = packing.packed(docs, memory=3).collect()
    real = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    places: dict = {}
    for i, t in enumerate(texts):
        ids = np.array([*real.encode(t or "", add_special_tokens=False).ids, packing.END], "<u4")
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in mine] == [(k, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
    assert max(r["piece"] for r in rows) > 1
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in places.values():  # gapless from 0, and no longer than a sequence
        assert [a for a, _ in sorted(p)] == list(np.cumsum([0] + [n for _, n in sorted(p)])[:-1]) and sum(n for _, n in p) <= 4096
    assert len(places) == plain_sequences([r["length"] for r in rows], 4096)


def test_packing_gives_the_tokenizer_only_uncommon_words(spark, monkeypatch):
    import random

    import public_tokenizers
    import tokenizers

    from tidemark.llm import packing

    whole: list = []

    class Counted:
        """The tokenizer, which notes the texts that it gets whole."""

        def __init__(self, real):
            self.real, self.model = real, real.model

        def encode(self, text, **more):
            whole.append(text)
            return self.real.encode(text, **more)

        def encode_batch_fast(self, texts, **more):
            whole.extend(texts)
            return self.real.encode_batch_fast(texts, **more)

        @classmethod
        def from_file(cls, path):
            return cls(real)

    real, rng = tokenizers.Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER)), random.Random(6)
    kinds = ["abcXYZ", "abé ÜßÀÿ×÷µª.,!'", "'sSretvmlldLD .,9", "<|endoftext|>", "e\u0301K\u212b\u0130漢ع²½ \x00\x85\xa0"]
    texts = ["".join(rng.choices(rng.choice(kinds), k=rng.randint(0, 14))) for _ in range(2000)] + ["a<|endoftext|>b <|ENDOFTEXT|>", "x" * 300, "It's THE façade, isn't it?! 2024..."]
    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    for memory in (2, 1000):
        encode = packing.encoder(None, memory)
        for t in texts:
            assert encode(t) == np.array([*real.encode(t, add_special_tokens=False).ids, packing.END], "<u4").tobytes(), t
    assert any("<|" in w for w in whole) and all("<|" in w or not set(w) <= set(map(chr, range(33, 127))) | set("éÜßÀÿ") for w in whole)
    packing.encoder.cache_clear()
