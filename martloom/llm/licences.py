"""Licence scans by sentences: known sentences get identifiers, ordered rules name the licence.

A text is cut into sentences (and lines, as notices often stand alone on one), each is normalised
and looked up among known licence sentences. The identifiers found, in their order in the text,
are matched against the rules: the first rule whose sequence occurs takes its identifiers out, then
the next one looks at the rest. Identifiers that no rule took are reported as unmatched.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import whole_text

# Sentences of published licences and common notices, by identifier.
SENTENCES = {
    "mit_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit_notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit_warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit_liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mit_title": "The MIT License (MIT)",
    "mit_heading": "MIT License",
    "mit_name": "Released under the MIT License.",
    "mit_licensed": "Licensed under the MIT License.",
    "mit_project": "This project is licensed under the MIT License.",
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc_warranty": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "isc_liability": "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "apache_short": "Licensed under the Apache License 2.0.",
    "apache_name": "Licensed under the Apache License, Version 2.0.",
    "apache_grant": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache_copy": "You may obtain a copy of the License at",
    "apache_warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache_see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3_name": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2_name": "This work is licensed under the GNU General Public License, version 2.",
    "gpl_free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2_free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "lgpl_free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "agpl_free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl3_free": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl3_program": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl_hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "lgpl_details": "See the GNU Lesser General Public License for more details.",
    "lgpl_received": "You should have received a copy of the GNU Lesser General Public License along with this library.",
    "lgpl_received_program": "You should have received a copy of the GNU Lesser General Public License along with this program.",
    "agpl_details": "See the GNU Affero General Public License for more details.",
    "agpl_received": "You should have received a copy of the GNU Affero General Public License along with this program.",
    "gpl_received": "You should have received a copy of the GNU General Public License along with this program.",
    "gpl_received_write": "You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    "gnu_see": "If not, see <https://www.gnu.org/licenses/>.",
    "gnu_see_http": "If not, see <http://www.gnu.org/licenses/>.",
    "gpl_hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl_details": "See the GNU General Public License for more details.",
    "bsd_grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd_endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd_warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "bsd_liability": "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "epl2_program": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl2_which": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution, and is available at https://www.eclipse.org/legal/epl-v20.html",
    "mpl2_source": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl2_copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "ccby4": "Licensed under CC BY 4.0.",
    "ccbysa4": "Licensed under CC BY-SA 4.0.",
    "ccbync4": "Licensed under CC BY-NC 4.0.",
    "ccby4_long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "ccbysa4_long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "ccbync4_long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc0": "This work has been marked as dedicated to the public domain.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "unlicense_do": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "reserved": "All rights reserved.",
}

# Names that a tag may give; a tag with an expression of several names is not known.
TAGS = (
    "0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC0-1.0 CC-BY-4.0 "
    "CC-BY-NC-4.0 CC-BY-SA-4.0 EPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC "
    "LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MPL-2.0 Unlicense Zlib"
).split()
SENTENCES.update({f"tag_{name}": f"SPDX-License-Identifier: {name}" for name in TAGS})

# Sequences of identifiers, longest and most telling first.
RULES = (
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse", "bsd_warranty", "bsd_liability")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse", "bsd_warranty")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_warranty", "bsd_liability")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_warranty")),
    ("MIT", ("mit_grant", "mit_notice", "mit_warranty", "mit_liability")),
    ("Apache-2.0", ("apache_grant", "apache_copy", "apache_warranty", "apache_see")),
    ("ISC", ("isc_grant", "isc_warranty", "isc_liability")),
    ("ISC", ("isc_grant", "isc_warranty")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_hope", "gpl_details", "gpl_received", "gnu_see")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_hope", "gpl_details", "gpl_received", "gnu_see_http")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_hope", "gpl_details")),
    ("GPL-2.0-or-later", ("gpl2_free", "gpl_hope", "gpl_details", "gpl_received_write")),
    ("GPL-2.0-or-later", ("gpl2_free", "gpl_hope", "gpl_details", "gpl_received", "gnu_see")),
    ("GPL-2.0-or-later", ("gpl2_free", "gpl_hope", "gpl_details")),
    ("AGPL-3.0-or-later", ("agpl_free", "gpl_hope", "agpl_details", "agpl_received", "gnu_see")),
    ("AGPL-3.0-or-later", ("agpl_free", "gpl_hope", "agpl_details")),
    ("AGPL-3.0-or-later", ("agpl_free", "gpl_hope")),
    ("LGPL-3.0-or-later", ("lgpl3_free", "lgpl_hope", "lgpl_details", "lgpl_received", "gnu_see")),
    ("LGPL-3.0-or-later", ("lgpl3_free", "lgpl_hope", "lgpl_details")),
    ("LGPL-3.0-or-later", ("lgpl3_program", "gpl_hope", "lgpl_details", "lgpl_received_program", "gnu_see")),
    ("LGPL-3.0-or-later", ("lgpl3_program", "gpl_hope", "lgpl_details")),
    ("LGPL-2.1-or-later", ("lgpl_free", "lgpl_hope", "lgpl_details")),
    ("MPL-2.0", ("mpl2_source", "mpl2_copy")),
    ("Unlicense", ("unlicense", "unlicense_do")),
    ("MIT", ("mit_grant", "mit_notice")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("Apache-2.0", ("apache_grant",)),
    ("Apache-2.0", ("apache_name",)),
    ("MIT", ("mit_name",)),
    ("MIT", ("mit_licensed",)),
    ("MIT", ("mit_project",)),
    ("ISC", ("isc_grant",)),
    ("GPL-3.0-or-later", ("gpl_free",)),
    ("GPL-2.0-or-later", ("gpl2_free",)),
    ("LGPL-2.1-or-later", ("lgpl_free",)),
    ("AGPL-3.0-or-later", ("agpl_free",)),
    ("GPL-3.0-only", ("gpl3_name",)),
    ("GPL-2.0-only", ("gpl2_name",)),
    ("MPL-2.0", ("mpl2_source",)),
    ("CC-BY-4.0", ("ccby4",)),
    ("CC-BY-4.0", ("ccby4_long",)),
    ("CC-BY-SA-4.0", ("ccbysa4",)),
    ("CC-BY-SA-4.0", ("ccbysa4_long",)),
    ("CC-BY-NC-4.0", ("ccbync4",)),
    ("CC-BY-NC-4.0", ("ccbync4_long",)),
    ("CC0-1.0", ("cc0",)),
    ("Unlicense", ("unlicense",)),
    ("MIT", ("mit_title",)),
    ("MIT", ("mit_heading",)),
    ("Apache-2.0", ("apache_short",)),
    ("LGPL-3.0-or-later", ("lgpl3_free",)),
    ("LGPL-3.0-or-later", ("lgpl3_program",)),
    ("EPL-2.0", ("epl2_program",)),
    ("EPL-2.0", ("epl2_which",)),
    *((name, (f"tag_{name}",)) for name in TAGS),
)

# Rules of several identifiers come before those of one.
SEQUENCES = tuple((name, rule) for name, rule in RULES if len(rule) > 1)
SINGLES = tuple((name, rule) for name, rule in RULES if len(rule) == 1)
if SEQUENCES + SINGLES != RULES:
    raise ValueError("a rule of one identifier stands before one of several")

# Where a sentence ends; a mark that no text holds stands for the cut.
CUT = "\u0001"
# What is joined before the cut: a version number after "v.", also over line ends with comment marks;
# the colon inside of known sentences and tags; and the words that mark comments. Other comment marks
# are no letters and go when a sentence is normalised.
JOINED = (
    r"([ ,][Vv]\.)[^A-Za-z0-9]{1,8}([0-9])|([Ff]ree[^A-Za-z0-9]{1,8}[Ss]oftware|SPDX-License-Identifier):"
    r"|(?m:^)[ \t]*(?:dnl|REM|rem)(?=\s)"
)
# A copyright line ends by itself, whatever stands in it.
COPYRIGHT = r"([Cc]opyright (?:\([Cc]\)|©|[0-9]{4})[^\n]*\n)"
# A line without letters and digits is blank, as are those that hold a comment mark alone; the address
# that stands between two sentences of a notice belongs to neither.
ENDS = (
    r"([.!?:])[ \t]*\r?\n|([.!?:])[ \t]+|\n[^A-Za-z0-9\n]*\n"
    r"|https?://www\.apache\.org/licenses/LICENSE-2\.0(?:\.txt|\.html)?"
)
NOT_LETTERS = r"[^a-z0-9]+"


def normal(sentence: Column) -> Column:
    """Small ASCII letters and digits, all else between them as one blank."""
    return F.trim(F.regexp_replace(F.lower(sentence), NOT_LETTERS, " "))


def normal_text(sentence: str) -> str:
    return re.sub(NOT_LETTERS, " ", sentence.lower()).strip()


def cut_text(text: str) -> list[str]:
    """The sentences of a text, as ``cut`` gives them."""
    joined = re.sub(JOINED, r"\1\2\3", re.sub(COPYRIGHT, r"\1\n", text))
    return [part for part in re.sub(ENDS, r"\1\2" + CUT, joined).split(CUT) if normal_text(part)]


def cut(text: Column) -> Column:
    """The text's sentences; a sentence may run over several lines, commented ones too."""
    ended = F.when(
        F.contains(text, F.lit("opyright ")), F.regexp_replace(text, COPYRIGHT, "$1\n")
    ).otherwise(text)
    joined = F.regexp_replace(ended, JOINED, "$1$2$3")
    return F.split(F.regexp_replace(joined, ENDS, "$1$2" + CUT), CUT)


def known_sentences() -> dict[str, str]:
    """Identifier by normalised sentence; one that would be cut could never be found."""
    torn = [name for name, sentence in SENTENCES.items() if len(cut_text(sentence)) != 1]
    if torn:
        raise ValueError(f"known sentences that are cut: {torn}")
    return {normal_text(sentence): name for name, sentence in SENTENCES.items()}


def sentences_found(docs: DataFrame) -> DataFrame:
    """doc_id, row, at, sentence_id of each known sentence, ``at`` ordering them within the row.

    A sentence that runs over several lines is looked up whole, and each of its lines by itself.
    """
    spark = docs.sparkSession
    lines = F.transform(
        cut(F.col("_text")),
        lambda s: F.when(
            F.contains(s, F.lit("\n")), F.concat(F.array(s), F.split(s, "\n"))
        ).otherwise(F.array(s)),
    )
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        whole_text().alias("_text"),
        F.monotonically_increasing_id().alias("row"),
    )
    parts = rows.select("doc_id", "row", F.posexplode(F.flatten(lines)).alias("at", "_part"))
    # The table of sentences is part of this module: a few dozen rows.
    table = spark.createDataFrame(list(known_sentences().items()), "normal string, sentence_id string")
    keyed = parts.withColumn("normal", normal(F.col("_part")))
    met = keyed.join(F.broadcast(table), "normal")
    return met.select("doc_id", "row", "at", "sentence_id")


def licences(docs: DataFrame) -> DataFrame:
    """One row per document with a known licence sentence: doc_id, licences, sentences, unmatched.

    licences: names by the rules, in rule order, each once, comma-joined (null if no rule fits);
    sentences: identifiers in their order, comma-joined; unmatched: how many no rule took. Null and
    empty texts have no row, null ids stay, repeated rows have a row each, other columns are ignored.
    """
    ordered = F.transform(
        F.sort_array(F.collect_list(F.struct("at", "sentence_id"))), lambda s: s["sentence_id"]
    )
    # One group holds one document's licence sentences only.
    found = sentences_found(docs).groupBy("row", "doc_id").agg(ordered.alias("ids"))
    state = found.withColumn("_left", F.concat(F.lit(","), F.array_join("ids", ",,"), F.lit(",")))
    names: list[Column] = []
    for k, (name, rule) in enumerate(SEQUENCES):
        sequence = "," + ",,".join(rule) + ","
        state = state.withColumn(f"_rule{k}", F.contains("_left", F.lit(sequence)))
        state = state.withColumn("_left", F.replace("_left", F.lit(sequence), F.lit("")))
        names.append(F.when(F.col(f"_rule{k}"), F.lit(name)))
    # Rules of one identifier cannot take from one another: all are looked up at once, in rule order.
    single = F.create_map(
        *[c for k, (name, (i,)) in enumerate(SINGLES)
          for c in (F.lit(i), F.struct(F.lit(k).alias("k"), F.lit(name).alias("name")))]
    )
    left = F.array_remove(F.split("_left", ","), "")
    found_single = F.array_sort(
        F.array_compact(F.transform(left, lambda i: F.try_element_at(single, i)))
    )
    names_left = F.transform(found_single, lambda s: s["name"])
    taken = F.array_distinct(F.concat(F.array_compact(F.array(*names)), names_left))
    return state.select(
        "doc_id",
        F.when(F.size(taken) > 0, F.array_join(taken, ",")).alias("licences"),
        F.array_join("ids", ",").alias("sentences"),
        (F.size(left) - F.size(found_single)).cast("long").alias("unmatched"),
    )
