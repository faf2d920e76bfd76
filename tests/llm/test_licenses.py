"""Notices of licences that differ in few words are told apart."""

from provgraph.llm import licenses

NOTICE = "This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
KINDS = [
    ("GPL-3.0", "program", ":", "General Public License", "3"), ("GPL-2.0-or-later", "program", ";", "General Public License", "2"), ("AGPL-3.0", "program", ":", "Affero General Public License", "3"),
    ("LGPL-3.0", "library", ":", "Lesser General Public License", "3"), ("LGPL-3.0", "program", ":", "Lesser General Public License", "3"), ("LGPL-2.1-or-later", "library", ";", "Lesser General Public License", "2.1"),
]


def test_near_variants_have_their_own_licence(spark):
    rows = [(i, "Copyright Foo\n\n" + NOTICE.format(what=w, mark=m, kind=k, version=v).replace(" as ", "\nas ")) for i, (_, w, m, k, v) in enumerate(KINDS)]
    rows.append((99, "This work is licensed under the GNU Affero General Public License, version 3."))
    got = {r["doc_id"]: (r["license"], r["dice"]) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (n, 1.0) for i, (n, *_) in enumerate(KINDS)} | {99: ("AGPL-3.0", 1.0)}


def test_whole_texts_and_sentences_are_recognised(spark):
    bsd = f"Copyright (c) 2020, Foo\nAll rights reserved.\n\n{licenses.BSD_INTRO}\n\n{licenses.BSD_1}\n\n{licenses.BSD_2}\n\n"
    rows = [
        (1, bsd + licenses.BSD_DISCLAIMER),
        (2, bsd + f"3. {licenses.BSD_3}\n\n" + licenses.BSD_DISCLAIMER),
        (3, f"MIT License\n\nCopyright (c) Foo\n\n{licenses.MIT_GRANT}\n\n{licenses.MIT_DISCLAIMER}\n"),
        (4, "This file is part of the Foo project. Released under the\nMIT License. See the documents for more."),
        (5, "Nothing here. We talk about licences in general!"),
    ]
    found = licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["license"] for r in found} == {1: "BSD-2-Clause", 2: "BSD-3-Clause", 3: "MIT", 4: "MIT", 5: None}


def test_telling_words_are_in_every_possible_match():
    words = set(licenses.telling_words())
    for _, text in licenses.TEMPLATES:
        pairs = licenses.template_bigrams(text)
        # What is left without them is too little for a match, even if nothing else stands in the segment.
        left = [p for p in pairs if not words & set(p)]
        assert 2 * len(left) / (len(left) + len(pairs)) < licenses.THRESHOLD
