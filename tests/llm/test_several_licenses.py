"""Every notice of a text is found, whatever other notices and words it holds."""

import random

import pytest


@pytest.fixture(scope="module")
def scan(spark):
    from tidemark.llm.licenses import scanned

    def found(texts: list[str]) -> list[tuple]:
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        return [(r["labels"], r["score"]) for r in scanned(docs).orderBy("doc_id").collect()]

    return found


def notices() -> dict:
    from tidemark.llm.licenses import TEMPLATES

    return {label: text for label, text, _ in reversed(TEMPLATES)}


def test_three_notices(scan):
    notice = notices()
    texts = ["\n\n".join(notice[x] for x in labels) for labels in (["bsd", "mpl", "epl"], ["isc", "unlicense", "cc-by"])]
    everything = " -- ".join(notice.values())
    assert scan([*texts, everything]) == [("bsd,epl,mpl", 1.0), ("cc-by,isc,unlicense", 1.0), (",".join(sorted(notice)), 1.0)]


def test_each_notice_among_decoys(scan):
    from tidemark.llm.licenses import TEMPLATES

    rng, words = random.Random(3), sorted({w for _, t, _ in TEMPLATES for w in t.split()})
    prose = lambda: " ".join(rng.choices(words, k=400)) + " ."
    texts = [f"{prose()} zz {text} zz {prose()}" for _, text, _ in TEMPLATES]
    for (label, _, _), (labels, score) in zip(TEMPLATES, scan(texts), strict=True):
        assert label in labels.split(",") and score == 1.0


LINES = {
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "Licensed under CC BY-NC-SA 3.0": "cc-by-nc-sa",
    "Licensed under the BSD 3-Clause License": "bsd",
    "SPDX-License-Identifier: Apache-2.0": "apache",
    "// SPDX-License-Identifier: MIT": "mit",
    "# SPDX-License-Identifier: GPL-3.0-or-later": "gpl",
    "Released under the MIT License": "mit",
    "Licensed under the Apache License, Version 2.0": "apache",
    "licensed under the Mozilla Public License, version 2.0": "mpl",
    "This work is licensed under the GNU General Public License, version 3": "gpl",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "cc-by-sa",
    "Boost Software License - Version 1.0 - August 17th, 2003": "bsl",
    "Made available under the Open Database License: http://opendatacommons.org": "odbl",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable": "zlib",
    "Licensed under the zlib License": "zlib",
    "Licensed under the Artistic License 2.0": "artistic",
    "SPDX-License-Identifier: 0BSD": "0bsd",
    "subject to the terms of the Common Development and Distribution License (the License)": "cddl",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files": "mit",
    "": "",
    "a licence to kill": "",
    "Unlike the GNU Lesser General Public License, our terms are ours.": "gpl",
    "We do not use the Eclipse Public License here.": "",
    "The Mozilla Public License is a licence among others.": "",
    "Nobody knows whether the BSD 3-Clause text applies.": "",
    "The artistic license of a painter": "",
    "See Creative Commons Attribution 4.0 International for more": "",
    "Boost software is not under an open database license": "",
    "the license of cc by mail 4.0": "",
}


def test_planted_lines_and_the_plain_version(spark, scan):
    """Every line has its label, and all labels and scores equal those of trying each alignment."""
    import re

    from tidemark.llm import licenses

    prose = "der the la que of to und et " * 3
    texts = [f"{prose}\n{x}\n{prose}" for x in LINES]
    found = scan(texts)
    assert [x for x, _ in found] == list(LINES.values())
    index = licenses.index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    for text, (labels, score) in zip(texts, found, strict=True):
        words = re.findall(r"[a-z0-9]+", text.lower())
        want, best = {label for phrase, label in licenses.BASE if f" {phrase} " in f" {' '.join(words)} "}, 0.0
        best = licenses.BASE_SCORE if want else best
        for t, (label, notice, key) in enumerate(licenses.TEMPLATES):
            own, phrase = notice.split(), key.split()
            first = notice[: notice.index(key)].count(" ")
            for x in range(-len(own), len(words)):
                at = lambda k: words[x + k] if 0 <= x + k < len(words) else None  # noqa: B023, E731
                votes = {w for w, postings in index for u, p in postings if u == t and at(p) == w}
                if len(votes) >= licenses.VOTES and all(at(first + j) == w for j, w in enumerate(phrase)):
                    same = sum(at(j) == w for j, w in enumerate(own))
                    if same >= licenses.LEAST_SHARE * len(own) or same >= licenses.LEAST_WORDS:
                        want, best = want | {label}, max(best, same / len(own))
        assert labels == ",".join(sorted(want)) and abs(score - best) < 1e-9
