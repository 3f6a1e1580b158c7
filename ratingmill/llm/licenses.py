"""License recognition from sentences, with DataFrame operations only.

A text is cut into sentences twice: line by line, and paragraph by paragraph with wrapped lines joined. Sentences are
normalised (A-Z folded, every run of other characters than a-z and 0-9 one space) and joined with a catalogue of known licence
sentences; only known ones go on. The identifiers of a text in reading order are matched with ordered rules: a rule
holds where its identifiers follow each other, other text between them ignored. Rules are joined by their first identifier.

Defined cases: null and empty texts have no sentence; a text without a rule gives no row; a sentence or rule that occurs again
counts once per text and cut; rows that repeat a doc_id and text count once; texts that share a doc_id are one text whose
sentences are interleaved by position; a null doc_id is a document; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifiers of licence sentences and their wording.
SENTENCES = (
    ("apache-2-ref", "Licensed under the Apache License, Version 2.0."),
    ("apache-2-grant", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("apache-2-comply", "you may not use this file except in compliance with the License."),
    ("apache-2-copy", "You may obtain a copy of the License at"),
    ("bsd-redistribute", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd-name", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd-as-is", 'This software is provided by the copyright holders and contributors "as is" and any express or implied warranties are disclaimed.'),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-disclaimer", 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'),
    ("bsd-liability", "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("cc-by-4-ref", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4-ref", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4-ref", "Licensed under CC BY-SA 4.0."),
    ("cc0-ref", "Released under CC0 1.0."),
    ("gpl-2-ref", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3-ref", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-free", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-useful", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("mit-ref", "Released under the MIT License."),
    ("mit-grant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.'),
    ("mit-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit-grant-full", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("mit-as-is", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'),
    ("mit-liability", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("mpl-2-ref", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

# Licences and the identifiers that state them, in order.
RULES = (
    ("Apache-2.0", ("apache-2-ref",)),
    ("Apache-2.0", ("apache-2-grant", "apache-2-comply", "apache-2-copy")),
    ("BSD-2-Clause", ("bsd-redistribute", "bsd-as-is")),
    ("BSD-2-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-disclaimer")),
    ("BSD-3-Clause", ("bsd-redistribute", "bsd-name", "bsd-as-is")),
    ("BSD-3-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-name", "bsd-disclaimer")),
    ("CC-BY-4.0", ("cc-by-4-ref",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-ref",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-ref",)),
    ("CC0-1.0", ("cc0-ref",)),
    ("GPL-2.0", ("gpl-2-ref",)),
    ("GPL-3.0", ("gpl-3-ref",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-useful")),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-grant-full", "mit-notice")),
    ("MPL-2.0", ("mpl-2-ref",)),
)


def _normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def _parts(text: Column) -> Column:
    """Sentences of a text: a line ends one, and so does a stop before a blank."""
    return F.split(F.regexp_replace(text, r"([.!?;:])[ \t]+", "$1\n"), "\n", -1)


def _pieces(wording: str) -> list[str]:
    """A catalogue sentence, cut as texts are."""
    return re.sub(r"([.!?;:])[ \t]+", "\\1\n", wording).split("\n")


def _piece_ids(name: str, wording: str) -> list[str]:
    n = len(_pieces(wording))
    return [name] if n == 1 else [f"{name}/{k}" for k in range(n)]


def known_pieces(sentences=SENTENCES) -> list[tuple[str, str]]:
    """Identifier and normal form of each piece of the catalogue."""
    found = {}
    for name, wording in sentences:
        for piece_id, piece in zip(_piece_ids(name, wording), _pieces(wording)):
            found[_normal(piece)] = piece_id
    return sorted((i, n) for n, i in found.items())


def rule_rows(sentences=SENTENCES, rules=RULES) -> list[tuple[str, str, str]]:
    """First identifier, licence and identifier sequence of each rule."""
    ids = {name: _piece_ids(name, wording) for name, wording in sentences}
    flat = [(license_, [i for name in names for i in ids[name]]) for license_, names in rules]
    return [(seq[0], license_, "|" + "|".join(seq) + "|") for license_, seq in flat]


def known_sentences(docs: DataFrame, sentences=SENTENCES) -> DataFrame:
    """doc_id, cut (0 lines, 1 paragraphs), pos, sentence: the known sentences of each text."""
    catalogue = docs.sparkSession.createDataFrame(known_pieces(sentences), "sentence string, norm string")
    text = F.coalesce("text", F.lit(""))
    joined = F.translate(F.translate(F.regexp_replace(text, "\n[ \t\r]*\n\\s*", "\u0001"), "\n", " "), "\u0001", "\n")
    cuts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.posexplode(F.array(_parts(text), _parts(joined))).alias("cut", "parts"))
    parts = cuts.select("doc_id", "cut", F.posexplode("parts").alias("pos", "part"))
    lower = F.translate("part", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    norm = F.trim(F.regexp_replace(lower, "[^a-z0-9]+", " "))
    # The catalogue is a fixed list.
    return parts.select("doc_id", "cut", "pos", norm.alias("norm")).join(F.broadcast(catalogue), "norm").select("doc_id", "cut", "pos", "sentence")


def licenses(docs: DataFrame, sentences=SENTENCES, rules=RULES) -> DataFrame:
    """doc_id, license, n_known (known sentences of the text in the cut that shows the rule), first_pos: one row per licence."""
    table = docs.sparkSession.createDataFrame(rule_rows(sentences, rules), "sentence string, license string, ids string")
    known = known_sentences(docs, sentences).groupBy("doc_id", "cut").agg(F.sort_array(F.collect_set(F.struct("pos", "sentence"))).alias("seq"))
    known = known.withColumn("text_ids", F.concat(F.lit("|"), F.array_join("seq.sentence", "|"), F.lit("|")))
    starts = known.select("doc_id", "text_ids", F.size("seq").alias("n"), F.explode("seq").alias("s"))
    found = starts.select("doc_id", "text_ids", "n", "s.*").join(F.broadcast(table), "sentence").filter(F.contains("text_ids", "ids"))
    return found.groupBy("doc_id", "license").agg(F.max("n").cast("bigint").alias("n_known"), F.min("pos").cast("bigint").alias("first_pos"))
