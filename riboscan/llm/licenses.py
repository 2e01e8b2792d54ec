"""Licence notices by a positional rare-token index; DataFrame functions only.

Document frequencies of the licence words come from one pass over all texts.
The index holds, for the words of each template that are rarest in the corpus,
the template and the word's place in it. Each rare word of a file is looked up
and votes for the places where templates may begin; a place stays if enough
words of the template agree on it, all of a short phrase's. There the template's
key phrases must stand in full, and the share of its IDF weight that stands at
its positions tells how much of the licence is there.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riboscan.llm.core import table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    """Each phrase of ``keys`` must stand in full at its place; ``least`` is the share of IDF weight of ``text`` that must be there."""

    label: str
    text: str
    keys: tuple[str, ...]
    least: float = 0.5
    base: bool = False


def _phrase(label: str, text: str, base: bool = False) -> Template:
    return Template(label, text, (text,), 1.0, base)


_WARRANTY = """the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability
whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"""
_BSD = """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation
and or other materials provided with the distribution"""
_BSD_END = """this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the
implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable
for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services
loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including
negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"""
_GNU_END = """but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu {} for more details"""

#: Fixed texts: the base phrases, further phrases, and the licences' own texts or notices as words.
TEMPLATES = (
    _phrase("gpl", "gnu general public license", True),
    _phrase("apache", "apache license", True),
    _phrase("cc-by", "cc by", True),
    _phrase("mit", "mit license", True),
    _phrase("cc-by-nc", "cc by nc"),
    _phrase("cc-by-nd", "cc by nd"),
    _phrase("cc-by-sa", "cc by sa"),
    _phrase("lgpl", "gnu lesser general public license"),
    _phrase("agpl", "gnu affero general public license"),
    _phrase("mpl", "mozilla public license"),
    Template("cc-by", "creative commons attribution 4 0 international license", ("creative commons attribution",), 0.6),
    Template("mit", f"""permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal
        in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the
        software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission
        notice shall be included in all copies or substantial portions of the software {_WARRANTY}""", ("permission is hereby granted free of charge", "sublicense and or sell copies")),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",), 0.8),
    Template("isc", """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright
        notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software
        including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages
        or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in
        connection with the use or performance of this software""", ("distribute this software for any purpose with or without fee",)),
    Template("bsd-2-clause", f"{_BSD} {_BSD_END}", ("redistributions in binary form must reproduce", "and or other materials provided with the distribution this software is provided by")),
    Template("bsd-3-clause", f"""{_BSD} 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
        software without specific prior written permission {_BSD_END}""", ("redistributions in binary form must reproduce", "endorse or promote products")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("use in source and binary forms",), 0.8),
    Template("apache", """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the
        license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is
        distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing
        permissions and limitations under the license""", ("use this file except in compliance with the license",)),
    Template("gpl", f"""this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free
        software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful
        {_GNU_END.format("general public license")}""", ("free software you can redistribute it", "terms of the gnu general public license")),
    Template("lgpl", f"""this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free
        software foundation either version 2 1 of the license or at your option any later version this library is distributed in the hope that it will be useful
        {_GNU_END.format("lesser general public license")}""", ("free software you can redistribute it", "terms of the gnu lesser general public license")),
    Template("agpl", f"""this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the
        free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful
        {_GNU_END.format("affero general public license")}""", ("free software you can redistribute it", "terms of the gnu affero general public license")),
    Template("mpl", """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one
        at https mozilla org mpl 2 0""", ("terms of the mozilla public license",), 0.6),
    Template("unlicense", """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this
        software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means""", ("free and unencumbered software",), 0.4),
    Template("zlib", """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use
        of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely
        subject to the following restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use
        this software in a product an acknowledgment in the product documentation would be appreciated but is not required 2 altered source versions must be plainly marked
        as such and must not be misrepresented as being the original software 3 this notice may not be removed or altered from any source distribution""", ("altered source versions must be plainly marked as such",)),
    Template("boost", """permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this
        license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third
        parties to whom the software is furnished to do so""", ("free of charge to any person or organization",), 0.6),
)
#: Words of a template that vote for its places, and how many of a long text's must agree on one.
ANCHORS, AGREE = 8, 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> Column:
    """Words after lower-casing A-Z; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def licence_idf(docs: DataFrame, templates=TEMPLATES) -> dict[str, float]:
    """IDF of every template word over all documents; what is collected is a row per template word."""
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    words = docs.select(words_of("text").alias("w")).select(F.explode(F.array_append(F.array_distinct(F.filter("w", lambda x: x.isin(vocabulary))), F.lit(""))).alias("word"))
    df = {r.word: r.n for r in words.groupBy("word").agg(F.count("*").alias("n")).collect()}
    n = df.get("", 0)
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1 for w in vocabulary}


def anchors_of(t: Template, idf: dict[str, float]) -> tuple[list[int], int]:
    """Places in a template's text of its rarest words, the earlier of equals, and how many of them must agree: all of a phrase's."""
    words = t.text.split()
    size = ANCHORS if t.least < 1 else max(1, min(3, len(words) - 1))
    at = sorted(range(len(words)), key=lambda i: (-idf[words[i]], i))[:size]
    return at, len(at) if t.least == 1 else min(AGREE, len(at))


def _key_words(t: Template) -> list[tuple[int, str]]:
    """(place, word) of all that must be there."""
    words, out = t.text.split(), {}
    for key in t.keys:
        k = key.split()
        at = next(j for j in range(len(words)) if words[j : j + len(k)] == k)
        out |= {at + i: w for i, w in enumerate(k)}
    return sorted(out.items())


def _structs(rows: list[tuple], **kinds: str) -> Column:
    """An array literal of structs."""
    if not rows:
        return F.array().cast(f"array<struct<{','.join(f'{n}:{k}' for n, k in kinds.items())}>>")
    return F.array(*[F.struct(*[F.lit(v).cast(k).alias(n) for v, (n, k) in zip(r, kinds.items(), strict=True)]) for r in rows])


def scan_licences(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of ``docs``.

    Null and empty texts have no words, empty labels and score 0. score is the
    largest share of a template's weight found at a place where its key phrases
    stand. Repeated rows and null doc_ids stay; other columns aren't read.
    """
    idf = licence_idf(docs, templates)
    postings: dict[str, list[tuple[int, int]]] = {}
    agree = []
    for i, t in enumerate(templates):
        at, need = anchors_of(t, idf)
        agree.append(need)
        for o in at:
            postings.setdefault(t.text.split()[o], []).append((i, o))
    rare = sorted(postings)
    index = F.create_map(*[x for w in rare for x in (F.lit(w), _structs(postings[w], t="int", o="int"))])
    of = lambda values, t: F.get(F.array(*[F.lit(v) for v in values]), t)
    keys = F.array(*[_structs(_key_words(t), o="int", w="string") for t in templates])
    total = [sum(idf[w] for w in t.text.split()) for t in templates]
    texts = F.array(*[_structs([(o, w, idf[w] / total[i]) for o, w in enumerate(t.text.split())], o="int", w="string", v="double") for i, t in enumerate(templates)])

    df = docs.select("doc_id", words_of("text").alias("w"))
    df = df.withColumn("n", F.size("w"))
    places = F.when(F.col("n") > 0, F.sequence(F.lit(0), F.col("n") - 1)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("hits", F.filter(places, lambda i: F.get("w", i).isin(rare)))
    # a look-up of each rare word gives the templates' places that it votes for; equal votes end up side by side
    votes = F.flatten(F.transform("hits", lambda p: F.transform(F.element_at(index, F.get("w", p)), lambda x: F.struct(x["t"].alias("t"), (p - x["o"]).alias("s")))))
    df = df.withColumn("votes", F.array_sort(votes))
    agreed = lambda v, i: ~F.coalesce(F.get("votes", i - 1) == v, F.lit(False)) & F.coalesce(F.get("votes", i + of(agree, v["t"]) - 1) == v, F.lit(False))
    df = df.withColumn("places", F.filter("votes", agreed))
    stands = lambda c: F.forall(F.get(keys, c["t"]), lambda k: F.coalesce(F.get("w", c["s"] + k["o"]) == k["w"], F.lit(False)))
    df = df.withColumn("places", F.filter("places", stands))
    share = lambda c: F.round(F.aggregate(F.get(texts, c["t"]), F.lit(0.0), lambda a, x: a + F.when(F.get("w", c["s"] + x["o"]) == x["w"], x["v"]).otherwise(F.lit(0.0))), 6)
    df = df.withColumn("found", F.transform("places", lambda c: F.struct(c["t"].alias("t"), c["s"].alias("s"), share(c).alias("share"))))
    base = [i for i, t in enumerate(templates) if t.base]
    df = df.withColumn("starts", F.transform(F.filter("found", lambda x: x["t"].isin(base)), lambda x: x["s"]))

    def labels(found: Column) -> Column:
        good = F.filter(found, lambda x: x["share"] >= of([t.least for t in templates], x["t"]))
        return F.array_join(F.array_sort(F.array_distinct(F.transform(good, lambda x: of([t.label for t in templates], x["t"])))), ",")

    return df.select(
        "doc_id", F.col("n").cast("long").alias("n_words"), F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        labels(F.filter("found", lambda x: x["t"].isin(base))).alias("base_labels"), labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0)).alias("score"),
    )


def op9_license_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scan_licences`` of all documents."""
    return scan_licences(table(spark, sf_dir, "documents"))
