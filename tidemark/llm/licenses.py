"""License scans by a positional rare-token index [native].

Templates are short public licence notices: headers, one-line statements ("licensed under the bsd 3 clause
license"), Creative Commons names with their versions, and SPDX identifiers. The index holds, for each template, the positions of its
INDEX_WORDS rarest words, by inverse document frequency counted over all documents. A template can stand
only in a document that has all words of its key phrase; for each such template, every place of each of its
index words, less the template position of a posting, votes for an alignment of template and document.
Alignments with votes of enough different words are verified: the template's mandatory key phrase must stand
there word for word, and of the whole notice LEAST_SHARE of the words or LEAST_WORDS of them, so that a mere mention of a
licence's name is no notice. No notice keeps another from being found, whatever else the document holds. The score is the greatest share of a
template's words that stand in their aligned places, at least BASE_SCORE where a base phrase stands.

The index is a few hundred words by construction, so it is held in the plan as literals. A document is
handled within its row.

Edge cases: null and empty texts have no words and no labels; repeated rows are each reported; an empty
table gives none; further columns of the table are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import NON_WORD, let, lower_ascii, split_words, table

#: Fixed by the contract: phrases whose places are reported, with their labels. Each ends in "license".
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Label, notice, and the key phrase in it that must stand word for word.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "licensed under the apache license"),
    ("gpl", "licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0 international"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial 4 0 international"),
    ("apache", "licensed under the apache license version 2 0", "licensed under the apache license"),
    ("mit", "released under the mit license", "released under the mit license"),
    ("mit", "licensed under the mit license", "licensed under the mit license"),
    ("bsd", "licensed under the bsd license", "licensed under the bsd license"),
    ("bsd", "licensed under the bsd 2 clause license", "bsd 2 clause"),
    ("bsd", "licensed under the bsd 3 clause license", "bsd 3 clause"),
    ("isc", "licensed under the isc license", "licensed under the isc license"),
    ("lgpl", "licensed under the gnu lesser general public license version 3", "gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license version 3", "gnu affero general public license"),
    ("mpl", "licensed under the mozilla public license version 2 0", "mozilla public license"),
    ("epl", "licensed under the eclipse public license version 2 0", "eclipse public license"),
    ("unlicense", "for more information please refer to unlicense org", "refer to unlicense org"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "provided as is without any express or implied warranty in no event will the authors"),
    ("zlib", "licensed under the zlib license", "the zlib license"),
    ("bsl", "boost software license version 1 0", "boost software license version 1 0"),
    ("bsl", "distributed under the boost software license version 1 0", "distributed under the boost software license"),
    ("artistic", "licensed under the artistic license 2 0", "artistic license 2 0"),
    ("artistic", "the artistic license version 2 0", "the artistic license version 2 0"),
    ("0bsd", "licensed under the zero clause bsd license", "zero clause bsd license"),
    ("0bsd", "licensed under the bsd zero clause license", "bsd zero clause license"),
    ("odbl", "made available under the open database license", "made available under the open database license"),
    ("cddl", "subject to the terms of the common development and distribution license", "common development and distribution license"),
    ("eupl", "licensed under the european union public licence version 1 2", "european union public licence"),
    ("wtfpl", "licensed under the do what the fuck you want to public license", "you want to public license"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "without fee and without a written agreement is hereby granted"),
    ("python", "licensed under the python software foundation license version 2", "python software foundation license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright and related or neighboring rights"),
)
# Names and versions of the Creative Commons family, and SPDX identifiers with their labels.
CC_NAMES, CC_VERSIONS = ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"), ("2 0", "2 5", "3 0", "4 0")
SPDX = {
    "mit": ("mit",),
    "apache": ("apache 2 0",),
    "gpl": ("gpl 2 0", "gpl 3 0"),
    "lgpl": ("lgpl 2 1", "lgpl 3 0"),
    "agpl": ("agpl 3 0",),
    "bsd": ("bsd 2 clause", "bsd 3 clause"),
    "mpl": ("mpl 2 0",),
    "epl": ("epl 2 0",),
    "isc": ("isc",),
    "unlicense": ("unlicense",),
    "cc0": ("cc0 1 0",),
    "cc-by": ("cc by 4 0",),
    "cc-by-sa": ("cc by sa 4 0",),
    "zlib": ("zlib",),
    "bsl": ("bsl 1 0",),
    "artistic": ("artistic 2 0",),
    "0bsd": ("0bsd",),
    "odbl": ("odbl 1 0",),
    "cddl": ("cddl 1 0", "cddl 1 1"),
    "eupl": ("eupl 1 2",),
    "wtfpl": ("wtfpl",),
    "postgresql": ("postgresql",),
    "python": ("psf 2 0",),
}
TEMPLATES += tuple((f"cc-{n.replace(' ', '-')}", f"licensed under cc {n} {v}", f"cc {n} {v}") for n in CC_NAMES for v in CC_VERSIONS)
TEMPLATES += tuple((label, f"spdx license identifier {x}", f"spdx license identifier {x}") for label, names in SPDX.items() for x in names)
INDEX_WORDS, VOTES, BASE_SCORE = 8, 2, 0.5
#: Share of a notice's words, or number of them, that must stand in their places.
LEAST_SHARE, LEAST_WORDS = 0.65, 12
#: Votes are numbers, to be sorted fast: an alignment (moved, so that none is negative) and a word of the index.
_MOVED, _WORDS = 128, 1024


def index(docs: DataFrame) -> list[tuple[str, list[tuple[int, int]]]]:
    """Index words, rarest first, each with its postings (template, position); bounded by the templates."""
    spark = docs.sparkSession
    words = sorted({w for _, t, _ in TEMPLATES for w in t.split()})
    known = F.array(*map(F.lit, words))
    used = docs.select(F.explode(F.array_intersect(known, split_words(lower_ascii(F.col("text")), NON_WORD))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    places = [(t, j, w) for t, (_, text, _) in enumerate(TEMPLATES) for j, w in enumerate(text.split())]
    # a word in no document is the rarest of all
    postings = spark.createDataFrame(places, "template int, place int, word string").join(used, "word", "left").fillna(0, ["df"])
    rank = F.dense_rank().over(Window.partitionBy("template").orderBy("df", "word"))
    kept = postings.withColumn("rank", rank).filter(F.col("rank") <= INDEX_WORDS).select("word", "df", "template", "place")
    found: dict[str, list[tuple[int, int]]] = {}
    for r in kept.orderBy("df", "word", "template", "place").collect():
        found.setdefault(r["word"], []).append((r["template"], r["place"]))
    return list(found.items())


def _base(words: Column) -> Column:
    """Places of base phrases: structs of start and label."""

    def at(w: Column, i: Column) -> Column:
        hit = F.when(w != BASE[0][0].split()[-1], None)
        for phrase, label in BASE:
            before = phrase.split()[:-1]
            same = F.lit(True)
            for k, x in enumerate(reversed(before), 1):
                same = same & F.coalesce(F.get(words, i - k) == x, F.lit(False))
            hit = hit.when(same, F.struct((i - len(before)).cast("long").alias("start"), F.lit(label).alias("label")))
        return hit

    return F.filter(F.transform(words, at), lambda x: x.isNotNull())


def _aligned(words: Column, found: list) -> Column:
    """Verified alignments: structs of label and score."""
    array = lambda x: F.array(*map(F.lit, x))
    known = sorted({w for w, _ in found} | {w for _, _, key in TEMPLATES for w in key.split()})

    def template(t: int, label: str, text: str, key: str) -> Column:
        own = [(k, w, p) for k, (w, postings) in enumerate(found) for u, p in postings if u == t]
        return F.struct(
            F.lit(label).alias("label"),
            array(text.split()).alias("words"),
            F.lit(text[: text.index(key)].count(" ")).alias("first"),
            array(key.split()).alias("key"),
            array(dict.fromkeys(w for _, w, _ in own)).alias("index"),
            F.array(*[F.struct(F.lit(w).alias("w"), F.lit(_MOVED - p).alias("less"), F.lit(k).alias("k")) for k, w, p in own]).alias("postings"),
        )

    def verified(t: Column) -> Column:
        places = F.filter(F.transform(words, lambda w, i: F.when(F.array_contains(t["index"], w), F.struct(w.alias("w"), i.cast("long").alias("i")))), lambda x: x.isNotNull())
        votes = F.flatten(F.transform(places, lambda x: F.transform(F.filter(t["postings"], lambda p: p["w"] == x["w"]), lambda p: (x["i"] + p["less"]) * _WORDS + p["k"])))
        at = lambda v: F.shiftright(v, _WORDS.bit_length() - 1)

        def supported(v: Column) -> Column:
            # sorted, the votes for one alignment are neighbours
            return F.array_distinct(F.transform(F.filter(v, lambda x, j: at(F.get(v, j + VOTES - 1)) == at(x)), lambda x: (at(x) - _MOVED).cast("int")))

        def check(x: Column) -> Column:
            key = F.forall(F.transform(t["key"], lambda k, j: F.coalesce(F.get(words, x + t["first"] + j) == k, F.lit(False))), lambda y: y)
            same = F.size(F.filter(t["words"], lambda w, j: F.coalesce(F.get(words, x + j) == w, F.lit(False))))
            enough = (same >= LEAST_SHARE * F.size(t["words"])) | (same >= LEAST_WORDS)
            return F.when(key & enough, F.struct(t["label"].alias("label"), (same / F.size(t["words"])).alias("score")))

        alignments = let(F.sort_array(F.array_distinct(votes)), supported)
        return F.filter(F.transform(alignments, check), lambda x: x.isNotNull())

    def possible(present: Column) -> Column:
        templates = F.array(*[template(t, *x) for t, x in enumerate(TEMPLATES)])
        return F.filter(templates, lambda t: F.forall(t["key"], lambda k: F.array_contains(present, k)))

    return F.flatten(F.transform(let(F.array_intersect(array(known), words), possible), verified))


def scanned(docs: DataFrame) -> DataFrame:
    """docs' doc_id with its licences; see the module."""
    found = index(docs)

    def scan(words: Column) -> Column:
        nowhere = F.array().cast("array<struct<start:bigint,label:string>>")
        base = F.when(F.array_contains(words, "license"), _base(words)).otherwise(nowhere)
        return F.struct(F.size(words).cast("long").alias("n_words"), base.alias("base"), _aligned(words, found).alias("more"))

    def labels(x: Column) -> Column:
        return F.array_sort(F.array_distinct(x))

    def report(x: Column) -> Column:
        base, more = x["base"], x["more"]
        starts = F.transform(base, lambda y: y["start"])
        best = F.coalesce(F.array_max(F.transform(more, lambda y: y["score"])), F.lit(0.0))
        return F.struct(
            x["n_words"].alias("n_words"),
            F.size(base).cast("long").alias("n_base"),
            F.array_min(starts).alias("first_word"),
            F.array_max(starts).alias("last_word"),
            F.array_join(labels(F.transform(base, lambda y: y["label"])), ",").alias("base_labels"),
            F.array_join(labels(F.concat(F.transform(base, lambda y: y["label"]), F.transform(more, lambda y: y["label"]))), ",").alias("labels"),
            F.greatest(best, F.when(F.size(base) > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0))).alias("score"),
        )

    words = split_words(lower_ascii(F.col("text")), NON_WORD)
    return docs.select("doc_id", let(let(words, scan), report).alias("x")).select("doc_id", "x.*")


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
