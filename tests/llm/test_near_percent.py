"""The pipeline's near-duplicate stage links at 80 per cent, the query at 85."""

import random

import brute


def test_stage_links_from_80(spark):
    import corpus_pipeline
    from tidemark.llm.minhash import near_duplicates

    rng, rows = random.Random(11), []
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    for k in range(30):
        base = [word() for _ in range(100)]
        for changed in ((), (20, 70), (10, 40, 80)):  # 96 shingles; Jaccard to the first 0.81 and 0.73
            rows.append((len(rows), " ".join(word() if p in changed else w for p, w in enumerate(base))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent, groups in ((85, 90), (80, 60)):
        want = brute.near(rows, percent)
        assert len({g for _, g in want.values()}) == groups
        assert {r[0]: (r[1], r[2]) for r in near_duplicates(docs, percent).collect()} == want
    stage = dict(corpus_pipeline.STAGES)["minhash_near_dedup"]
    assert sorted(r["doc_id"] for r in stage(spark, docs, "").collect()) == sorted(i for i, (_, g) in want.items() if i == g)
