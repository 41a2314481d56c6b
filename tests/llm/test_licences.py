"""Licence notices as they are published: in one line, wrapped, and inside of comments."""

import textwrap

import pytest

from martloom.llm import licences

APACHE = """Copyright 2020 J. Doe and others

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """Copyright (C) 2020  J. Doe

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
AGPL = GPL.replace("GNU General", "GNU Affero General")


def shapes(notice):
    lines = notice.split("\n")
    yield notice
    yield " ".join(x for x in lines[1:] if x)
    yield "\r\n".join(lines)
    for mark in ("//", " *", "#", ";;", "--", "dnl", "REM", "%"):
        yield "\n".join(f"{mark} {x}".rstrip() for x in ["", *lines, ""])
    yield "/*\n" + "\n".join(f" * {x}" for x in lines) + "\n */\nint main;"
    yield "\n".join(f"* {x:<75}*" for x in lines)
    yield lines[0] + "\n" + "\n".join(textwrap.wrap(" ".join(lines[1:]), 40))


@pytest.fixture(scope="module")
def found(spark):
    cases = []
    for name, notice in (("Apache-2.0", APACHE), ("GPL-3.0-or-later", GPL), ("AGPL-3.0-or-later", AGPL)):
        cases += [(name, text) for text in shapes(notice)]
    for name, rule in licences.RULES:
        whole = " ".join(licences.SENTENCES[i] for i in rule)
        for width in (30, 50, 72, 10_000):
            wrapped = textwrap.wrap(whole, width, break_long_words=False, break_on_hyphens=False)
            text = "Copyright (c) 2020 J. Doe\n" + "\n".join(wrapped)
            cases += [(name, t) for t in (text, "\n".join(f" * {x}" for x in text.split("\n")))]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licences.licences(docs).collect()}
    return [(name, text, rows.get(i)) for i, (name, text) in enumerate(cases)]


def test_each_rule_names_its_notice(found):
    wrong = [(name, text, row) for name, text, row in found if row is None or row["licences"] != name]
    assert not wrong, wrong[:3]


def test_a_known_sentence_that_is_cut_is_an_error(monkeypatch):
    monkeypatch.setitem(licences.SENTENCES, "two", "One sentence. And another.")
    with pytest.raises(ValueError, match="two"):
        licences.known_sentences()


PUBLISHED = [
    ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 J. Doe"),
    ("MIT", "// SPDX-License-Identifier: MIT\n#include <x>\n"),
    ("GPL-2.0-only", "/* SPDX-License-Identifier: GPL-2.0-only */\nint x;"),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("LGPL-3.0-or-later", GPL.replace("GNU General", "GNU Lesser General")),
    ("LGPL-3.0-or-later", GPL.replace("GNU General", "GNU Lesser General").replace("program", "library")),
    ("ISC", " ".join(licences.SENTENCES[i] for i in ("isc_grant", "isc_warranty", "isc_liability"))),
    ("BSD-2-Clause", "\n".join(licences.SENTENCES[i] for i in (
        "bsd_grant", "bsd_source", "bsd_binary", "bsd_warranty", "bsd_liability"))),
    ("EPL-2.0", licences.SENTENCES["epl2_program"] + "\n\n * SPDX-License-Identifier: EPL-2.0"),
    ("GPL-3.0-or-later", GPL), ("AGPL-3.0-or-later", AGPL), ("Apache-2.0", APACHE),
]


def test_published_notices_leave_nothing_unmatched(spark):
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(PUBLISHED)], "doc_id long, text string")
    rows = {r["doc_id"]: (r["licences"], r["unmatched"]) for r in licences.licences(docs).collect()}
    assert rows == {i: (name, 0) for i, (name, _) in enumerate(PUBLISHED)}


def test_another_warranty_is_no_part_of_the_grant(spark):
    text = " ".join(licences.SENTENCES[i] for i in ("isc_grant", "mit_warranty"))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [(r["licences"], r["unmatched"]) for r in licences.licences(docs).collect()] == [("ISC", 1)]
