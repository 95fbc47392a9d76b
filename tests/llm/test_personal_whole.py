"""Spans stay right in texts with very many matches, and along chains of overlaps."""

import brute


def test_more_than_a_million_matches(spark):
    from tidemark.llm.personal import with_base

    text = "12," * (16**5 + 100) + " card 4111 1111 1111 1111, end"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    want = [(s[1], s[2]) for s in brute.personal(text)]
    assert [(x["start"], x["end"]) for x in with_base(docs, "text", "s").first()["s"]] == want


def test_chain_of_overlaps(spark, monkeypatch):
    """The second span loses to the first, and so can't beat the third."""
    from pyspark.sql import functions as F

    from tidemark.llm import personal

    spans = [(0, 0, 10, 9), (8, 1, 15, 8), (14, 2, 20, 7), (19, 3, 25, 6), (30, 0, 35, 1), (40, 1, 45, 3), (40, 2, 47, 3)]
    made = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(k).alias("kind"), F.lit(b).alias("end"), F.array(F.lit(s)).alias("features")) for a, k, b, s in spans])
    monkeypatch.setattr(personal, "fitted", lambda _: ([], [0.0] * 4, []))
    monkeypatch.setattr(personal, "_score", lambda _, row: F.get(row, 0).cast("double"))
    monkeypatch.setattr(personal, "with_proposals", lambda docs, text, name: docs.withColumn(name, made))
    docs = spark.createDataFrame([(1, "no 12 base spans " * 4)], "doc_id long, text string")
    got = [tuple(x) for x in personal.with_spans(docs, "found").select("found.all").first()[0]]
    assert got == [(0, 0, 10), (14, 2, 20), (30, 0, 35), (40, 1, 45)]


def test_held_out_proposals_by_kind(spark):
    """Of the held-out proposals of each kind, most of the true ones are chosen, and hardly a wrong one."""
    from tidemark.llm import personal

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    _, _, held = personal.fitted(docs)
    for k, kind in enumerate(personal.KINDS):
        told = [said for x, true, said in held if x == k and true]
        wrong = sum(said for x, true, said in held if x == k and not true)
        assert sum(told) >= 0.9 * len(told) > 0, kind
        assert wrong <= 0.05 * sum(told), kind


def test_planted_secrets_and_numbers(spark):
    from tidemark.llm import personal

    value = "3f9a0c81d2e4b5967788a0b1c2d3e4f5a6b7c8d9"
    near = ["und die welt ", "le la que des "]
    texts = [f'{n}token = "{value}" {n}' for n in near] + [f"{n}IBAN DE89 3704 0044 0532 0130 00, {n}" for n in near] + [f"{n}ssn: 123-45-6789 {n}" for n in near]
    texts += ["see commit 3f9a0c81d2e4b5967788a0b1c2d3e4f5a6b7c8d9 of the file", "password: unbelievable things", "isbn 123-45-6789", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = personal.with_spans(docs, "x").orderBy("doc_id").select("text", "x.all").collect()
    got = [[(personal.KINDS[x["kind"]], t[x["start"] : x["end"]]) for x in spans] for t, spans in found]
    assert got == [[("secret", value)]] * 2 + [[("iban", "DE89 3704 0044 0532 0130 00")]] * 2 + [[("id", "123-45-6789")]] * 2 + [[]] * 5


def test_many_proposals_in_a_text(spark):
    """Spans are compared within clusters of overlaps only, so that a text of many takes seconds."""
    import time

    from tidemark.llm import personal

    count = 20_000
    few = "call (555) 123-4567 or 212-555-0199, mail a.b@c.de today; "
    docs = spark.createDataFrame([(1, few), (2, few * count)], "doc_id long, text string")
    began = time.time()
    found = {r["doc_id"]: r["found"] for r in personal.with_spans(docs, "found").select("doc_id", "found").collect()}
    one, many = found[1]["all"], found[2]["all"]
    assert time.time() - began < 90 and len(one) == 2
    assert [(x["start"] - len(few) * 7, x["kind"], x["end"] - len(few) * 7) for x in many[7 * len(one) : 8 * len(one)]] == [tuple(x) for x in one]
    assert len(many) == count * len(one)
