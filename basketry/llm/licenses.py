"""Finds licences by their sentences.

A text is cut into sentences, these are normalised and mapped to the identifiers of known
licence sentences; a licence is a rule, an ordered run of identifiers. Rules are
tried in their order, longer texts before notices, and what a rule has matched is
not matched again. Identifiers that no rule takes are reported as such.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import steps, texts

# Sentences of well-known licences and notices, normalised (lower case, single
# blanks, no mark at the end). {version} stands for a number, {holder} for any name.
SENTENCES: dict[str, str] = {
    "mit-grant": "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"software\"), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so, subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall {holder} be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software",
    "mit-named": "released under the mit license",
    "mit-named-2": "licensed under the mit license",
    "mit-named-3": "this project is licensed under the mit license",
    "mit-named-4": "distributed under the mit license",
    "isc-grant": "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-warranty": "the software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "isc-named": "licensed under the isc license",
    "bsd-grant": "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-names": "neither the name of {holder} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-warranty": "this software is provided by {holder} \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-named": "licensed under the bsd license",
    "bsd-3-named": "licensed under the bsd 3-clause license",
    "bsd-2-named": "licensed under the bsd 2-clause license",
    "apache-named": "licensed under the apache license, version {version}",
    "apache-named-2": "licensed under the apache license, version {version} (the \"license\")",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http://www.apache.org/licenses/license-{version}",
    "apache-copy-2": "you may obtain a copy of the license at https://www.apache.org/licenses/license-{version}",
    "apache-basis": "unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an \"as is\" basis, without warranties or conditions of any kind, either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl-named": "this work is licensed under the gnu general public license, version {version}",
    "gpl-named-2": "licensed under the gnu general public license, version {version}",
    "gpl-named-3": "licensed under the gnu general public license v{version}",
    "gpl-grant": "this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation, either version {version} of the license, or (at your option) any later version",
    "gpl-grant-2": "this program is free software; you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation; either version {version} of the license, or (at your option) any later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "lgpl-named": "licensed under the gnu lesser general public license, version {version}",
    "agpl-named": "licensed under the gnu affero general public license, version {version}",
    "mpl-named": "this source code form is subject to the terms of the mozilla public license, v. {version}",
    "mpl-copy": "if a copy of the mpl was not distributed with this file, you can obtain one at http://mozilla.org/mpl/{version}/",
    "mpl-named-2": "licensed under the mozilla public license, version {version}",
    "cc-by-named": "licensed under cc by {version}",
    "cc-by-sa-named": "licensed under cc by-sa {version}",
    "cc-by-nc-named": "licensed under cc by-nc {version}",
    "cc-by-nd-named": "licensed under cc by-nd {version}",
    "cc-by-nc-sa-named": "licensed under cc by-nc-sa {version}",
    "cc-by-nc-nd-named": "licensed under cc by-nc-nd {version}",
    "cc0-named": "licensed under cc0 {version}",
    "cc-by-long": "this work is licensed under a creative commons attribution {version} international license",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "public-domain": "this work is in the public domain",
    "all-rights": "all rights reserved",
}

# The licence and its sentences in their order; {} takes the version of the first that has one.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("ISC", ("isc-grant", "isc-warranty")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-{}", ("apache-named-2", "apache-use", "apache-copy", "apache-basis", "apache-see")),
    ("Apache-{}", ("apache-named-2", "apache-use", "apache-copy-2", "apache-basis", "apache-see")),
    ("GPL-{}-or-later", ("gpl-grant", "gpl-warranty", "gpl-see", "gpl-copy")),
    ("GPL-{}-or-later", ("gpl-grant-2", "gpl-warranty", "gpl-see", "gpl-copy")),
    ("GPL-{}-or-later", ("gpl-grant", "gpl-warranty", "gpl-see")),
    ("GPL-{}-or-later", ("gpl-grant-2", "gpl-warranty", "gpl-see")),
    ("MPL-{}", ("mpl-named", "mpl-copy")),
    ("GPL-{}-or-later", ("gpl-grant",)),
    ("GPL-{}-or-later", ("gpl-grant-2",)),
    ("Apache-{}", ("apache-named-2",)),
    ("Apache-{}", ("apache-named",)),
    ("MIT", ("mit-named",)),
    ("MIT", ("mit-named-2",)),
    ("MIT", ("mit-named-3",)),
    ("MIT", ("mit-named-4",)),
    ("ISC", ("isc-named",)),
    ("BSD", ("bsd-named",)),
    ("BSD-3-Clause", ("bsd-3-named",)),
    ("BSD-2-Clause", ("bsd-2-named",)),
    ("GPL-{}", ("gpl-named",)),
    ("GPL-{}", ("gpl-named-2",)),
    ("GPL-{}", ("gpl-named-3",)),
    ("LGPL-{}", ("lgpl-named",)),
    ("AGPL-{}", ("agpl-named",)),
    ("MPL-{}", ("mpl-named",)),
    ("MPL-{}", ("mpl-named-2",)),
    ("CC-BY-{}", ("cc-by-named",)),
    ("CC-BY-SA-{}", ("cc-by-sa-named",)),
    ("CC-BY-NC-{}", ("cc-by-nc-named",)),
    ("CC-BY-ND-{}", ("cc-by-nd-named",)),
    ("CC-BY-NC-SA-{}", ("cc-by-nc-sa-named",)),
    ("CC-BY-NC-ND-{}", ("cc-by-nc-nd-named",)),
    ("CC0-{}", ("cc0-named",)),
    ("CC-BY-{}", ("cc-by-long",)),
    ("Unlicense", ("unlicense",)),
    ("Public-Domain", ("public-domain",)),
    ("All-Rights-Reserved", ("all-rights",)),
]

# Every known sentence holds one of these, so a text without them needs no cutting.
# Between two words may stand a line break and the marks of a comment.
BETWEEN = r"\W+(?:[a-z]\)\W+)?"
HINT = f"licen|permission|redistribution|software|warranty|public{BETWEEN}domain|copyright|rights{BETWEEN}reserved|mozilla|mpl"
VERSION = r"(?P<version>\d+(?:\.\d+)*)"
HOLDER = r".+?"
# Words of a holder at most.
HOLDER_WORDS = 100
# Marks before a line of a comment.
COMMENT = re.compile(r"^[ \t]*(?:/\*+|\*+/|\*|//+|#+|--+|;+|%+|<!--|\([a-z]\))?[ \t]*", re.MULTILINE)
# Where a sentence may begin or end; known ones may also go on there.
PIECE_END = re.compile(r"(?<=[.!?:])\s+|\s*\n\s*")
# Marks of a list before a sentence.
ITEM = re.compile(r"^(?:\([a-z\d]\)|\d{1,2}[.)])\s+")
QUOTES = str.maketrans({"“": '"', "”": '"', "‘": "'", "’": "'"})
# Double quotes made of single ones.
DOUBLE = re.compile(r"``|''")

MATCHES = T.ArrayType(
    T.StructType(
        [
            T.StructField("license", T.StringType()),
            T.StructField("sentences", T.ArrayType(T.StringType())),
            T.StructField("first", T.IntegerType()),
            T.StructField("last", T.IntegerType()),
        ]
    )
)


def normal(sentence: str) -> str:
    text = DOUBLE.sub('"', " ".join(sentence.translate(QUOTES).lower().split()))
    return ITEM.sub("", text).strip(" .:;!?*/#-")


def _versioned(sentence: str) -> re.Pattern:
    pattern = re.escape(normal(sentence)).replace(re.escape("{version}"), VERSION)
    return re.compile(pattern.replace(re.escape("{holder}"), HOLDER))


class Catalogue:
    """The known sentences, looked up by text; those with a variable part by pattern."""

    def __init__(self) -> None:
        self.exact = {normal(s): name for name, s in SENTENCES.items() if "{" not in s}
        self.patterns = [(name, _versioned(s)) for name, s in SENTENCES.items() if "{" in s]
        # By the first two words, the words of the longest sentence that begins with them.
        self.begins: dict[tuple[str, ...], int] = {}
        for sentence in SENTENCES.values():
            words = normal(sentence).split()
            pair = tuple(w.strip(" .:;!?*/#-") for w in words[:2])
            most = len(words) + HOLDER_WORDS * ("{holder}" in words)
            self.begins[pair] = max(self.begins.get(pair, 0), most)

    def identify(self, sentence: str) -> tuple[str, str | None] | None:
        text = normal(sentence)
        if name := self.exact.get(text):
            return name, None
        for name, pattern in self.patterns:
            if found := pattern.fullmatch(text):
                return name, found.groupdict().get("version")
        return None

    def sentences(self, text: str) -> list[tuple[str, str | None] | None]:
        """The identifiers in the order of the text, None for every piece that is in no known sentence.

        The text is cut at line breaks and at blanks after marks; a known sentence is the longest run of
        pieces, so it may go over several lines and stand after a heading or a colon.
        """
        pieces = [p for p in PIECE_END.split(COMMENT.sub("", text)) if p.strip()]
        out: list[tuple[str, str | None] | None] = []
        begin = 0
        while begin < len(pieces):
            known, end = None, begin + 1
            for stop in range(min(len(pieces), begin + self._most_pieces(pieces, begin)), begin, -1):
                if known := self.identify(" ".join(pieces[begin:stop])):
                    end = stop
                    break
            out.append(known)
            begin = end
        return out

    def _most_pieces(self, pieces: list[str], begin: int) -> int:
        """How many pieces a known sentence that begins like these may take, 0 if none does."""
        words: list[str] = []
        for stop in range(begin, len(pieces)):
            words = normal(" ".join(pieces[begin : stop + 1])).split()
            if len(words) > 1 or stop - begin >= MARKS:
                break
        # A piece has a word at least, but for marks before the sentence.
        return self.begins.get(tuple(w.strip(" .:;!?*/#-") for w in words[:2]), -MARKS) + MARKS


# Pieces without a word that may stand before or inside a sentence.
MARKS = 4


def match_rules(found: list[tuple[str, str | None] | None]) -> list[dict]:
    """The rules that match, with the sentences they take; leftovers as licence UNKNOWN.

    Identifiers stand next to each other in a rule, except for unknown sentences between.
    """
    known = [(place, *x) for place, x in enumerate(found) if x]
    free = [True] * len(known)
    out = []
    for name, wanted in RULES:
        for begin in range(len(known) - len(wanted) + 1):
            run = range(begin, begin + len(wanted))
            if all(free[i] and known[i][1] == w for i, w in zip(run, wanted, strict=True)):
                for i in run:
                    free[i] = False
                version = next((known[i][2] for i in run if known[i][2]), "")
                out.append(
                    {
                        "license": name.format(version),
                        "sentences": list(wanted),
                        "first": known[begin][0],
                        "last": known[run[-1]][0],
                    }
                )
    for i, alone in enumerate(free):
        if alone:
            place, name, _ = known[i]
            out.append({"license": "UNKNOWN", "sentences": [name], "first": place, "last": place})
    return sorted(out, key=lambda x: (x["first"], x["last"]))


def _scan() -> Callable:
    kind = pa.list_(
        pa.struct(
            [
                ("license", pa.string()),
                ("sentences", pa.list_(pa.string())),
                ("first", pa.int32()),
                ("last", pa.int32()),
            ]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        catalogue = Catalogue()
        for batch in batches:
            for part in steps(batch):
                column = texts(part.column("text"))
                hinted = pc.match_substring_regex(column, HINT, ignore_case=True).to_pylist()
                matches = [
                    match_rules(catalogue.sentences(text.as_py())) if hint else []
                    for text, hint in zip(column, hinted, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(matches, kind)], names=["doc_id", "matches"]
                )

    return run


def license_matches(docs: DataFrame) -> DataFrame:
    """doc_id and `matches` of every row: (license, sentences, first, last) in the order of the text.

    first and last count the sentences of the text. Null and empty texts match nothing; texts
    are read whole; repeated rows match alike.
    """
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("matches", MATCHES)])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan(), schema)


def with_names(rows: DataFrame) -> DataFrame:
    """doc_id, licenses (distinct, sorted, joined by commas), n_matches, sentences (joined by commas)."""
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    sentences = F.flatten(F.transform("matches", lambda m: m["sentences"]))
    return rows.select(
        "doc_id",
        F.concat_ws(",", names).alias("licenses"),
        F.size("matches").cast("long").alias("n_matches"),
        F.concat_ws(",", sentences).alias("sentences"),
    )
