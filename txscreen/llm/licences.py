"""License scan by sentence rules. DataFrame functions only.

A text is cut into pieces at line ends and after a sentence mark before a blank. A piece is normalised:
lower case, every run of other characters than a-z and 0-9 one blank. A sentence is a run of pieces
whose line breaks count as blanks: it may be wrapped over lines, but not beyond a line that ends with a
sentence mark or has no letter or digit, and a list number may stand before it. Its place is that of
its first piece. Known sentences, also in the variants of canonical texts, have identifiers; the
others have none. The identifiers of a document, in order, are one line, and an ordered rule is a
sequence of identifiers in it; unknown sentences in between don't matter. Rules are tried
longest first, and what a rule has taken no later rule sees, so the one-line notice of a license
isn't reported beside its full text.

Everything happens within a row: no shuffle, no join, and work in proportion to the text.

Defined cases: a null text has no sentences; repeated rows are scanned alike; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Identifiers and texts of known license sentences, normalised.
SENTENCES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-may-not-use": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-notice": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-include": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-details": "see the gnu general public license for more details",
    "gpl2-redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl2-only-redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "lgpl2-redistribute": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl3-redistribute": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-details": "see the gnu lesser general public license for more details",
    "agpl-redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-details": "see the gnu affero general public license for more details",
    "mpl-subject": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-obtain": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "isc-liability": "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "unlicense-public": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "boost-notice": "distributed under the boost software license version 1 0",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-notice": "licensed under cc by 4 0",
}
#: Ordered rules, longest first; a rule is a license and its sentences in order.
RULES = (
    ("MIT", ("mit-grant", "mit-include", "mit-as-is", "mit-liability")),
    ("Apache-2.0", ("apache-notice", "apache-may-not-use", "apache-obtain", "apache-as-is", "apache-see")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", ("gpl-redistribute", "gpl-hope", "gpl-details")),
    ("GPL-2.0-or-later", ("gpl2-redistribute", "gpl-hope", "gpl-details")),
    ("GPL-2.0-only", ("gpl2-only-redistribute", "gpl-hope", "gpl-details")),
    ("LGPL-2.1-or-later", ("lgpl2-redistribute", "lgpl-hope", "lgpl-details")),
    ("LGPL-3.0-or-later", ("lgpl3-redistribute", "lgpl-hope", "lgpl-details")),
    ("AGPL-3.0-or-later", ("agpl-redistribute", "gpl-hope", "agpl-details")),
    ("ISC", ("isc-grant", "isc-as-is", "isc-liability")),
    ("MPL-2.0", ("mpl-subject", "mpl-obtain")),
    ("Unlicense", ("unlicense-public", "unlicense-anyone")),
    ("Zlib", ("zlib-as-is", "zlib-grant")),
    ("Apache-2.0", ("apache-notice",)),
    ("BSL-1.0", ("boost-grant",)),
    ("BSL-1.0", ("boost-notice",)),
    ("MIT", ("mit-notice",)),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
)
#: Other wordings in canonical texts, as regular expressions over normalised text, and the identifiers they stand for.
VARIANTS = (
    ("licensed under the apache license version 2 0 the license", ("apache-notice",)),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache-notice", "apache-may-not-use")),
    ("the asf licenses this file to you under the apache license version 2 0 the license", ("apache-notice",)),
    ("the asf licenses this file to you under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache-notice", "apache-may-not-use")),
    ("you may obtain a copy of the license at https? www apache org licenses license 2 0", ("apache-obtain",)),
    ("the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software", ("mit-include",)),
    ("if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0", ("mpl-obtain",)),
    ("permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ("isc-grant",)),
    (r"neither the name of (?:[a-z0-9]++ \x1f?){1,12}?nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ("bsd-endorse",)),
)
#: A sentence ends at a line end, or after a mark that doesn't repeat, before blanks.
_MARK = r"([^.!?\n][.!?])[ \t\r]+"
#: A line end after a sentence mark; the piece that follows it begins with _HARD, which no sentence goes across.
_STOP, _HARD, _HIT = r"(?<![.!?])[.!?]++[^A-Za-z0-9.!?\n]*+\n", "\x1f", "\x1e"
#: Known sentences, shorter ones first: of two that begin at one place, the rest of the longer is seen at its own place.
_KNOWN = sorted([(s, (k,)) for k, s in SENTENCES.items()] + list(VARIANTS), key=lambda x: len(x[0]))
_WORDINGS = [s.replace(" ", r"[ \n]") for s, _ in _KNOWN]
_BEFORE, _AFTER = _HARD + r"?(?:(?:[0-9]{1,2}|[a-e])[ \n])?", r"(?=\n|\z)"
#: Words, and so lines, that the longest sentence and a list number have at most.
_MOST = max(s.count(" ") for s, _ in _KNOWN) + 16


def sentence_ids(text: Column) -> Column:
    """array of (place, id): the known sentences of a text, in order."""
    cut = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _HARD + _HIT, "\x1d\x1d"), _MARK, "$1\n")
    plain = F.regexp_replace(F.lower(F.regexp_replace(cut, _STOP, ".\n" + _HARD)), rf"[^a-z0-9\n{_HARD}]+", " ")
    plain = F.trim(F.regexp_replace(plain, rf" ?([\n{_HARD}]+) ?", "$1"))
    # pieces at which a known sentence begins are marked; only of those the next lines are read
    marked = F.regexp_replace(plain, rf"(\A|\n)(?={_BEFORE}(?:{'|'.join(_WORDINGS)}){_AFTER})", "$1" + _HIT)

    def named(lines: Column) -> Column:
        found = F.lit(None).cast("array<string>")
        for words, (_, ids) in reversed(list(zip(_WORDINGS, _KNOWN, strict=True))):
            found = F.when(lines.rlike(rf"\A{_BEFORE}{words}{_AFTER}"), F.array(*map(F.lit, ids))).otherwise(found)
        return found

    pieces = F.split(marked, "\n", -1)

    def read(pieces: Column) -> Column:
        starts = F.filter(F.transform(pieces, lambda s, i: F.when(F.startswith(s, F.lit(_HIT)), i)), lambda i: i.isNotNull())
        return F.transform(starts, lambda i: F.struct(i.alias("place"), named(F.translate(F.array_join(F.slice(pieces, i + 1, _MOST), "\n"), _HIT, "")).alias("ids")))

    # a lambda's argument is computed once, where a repeated expression may not be
    hits = F.flatten(F.transform(F.array(pieces), read))
    return F.flatten(F.transform(hits, lambda h: F.transform(h["ids"], lambda k: F.struct(h["place"].alias("place"), k.alias("id")))))


def match_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, hits): known sentences, and (rule number, times) of each rule that matches."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), sentence_ids(F.col(text).cast("string")).alias("ids"))
    # each identifier stands between two bars; a rule that is found leaves a space
    line = F.concat(F.lit("|"), F.array_join(F.transform("ids", lambda x: F.concat(x["id"], F.lit("|"))), "|"))
    rows = rows.withColumn("line0", line)
    hits = []
    for k, (_, rule) in enumerate(RULES):
        mark = "".join(f"|{s}|" for s in rule)
        rows = rows.withColumn(f"line{k + 1}", F.replace(F.col(f"line{k}"), F.lit(mark), F.lit(" ")))
        hits.append(F.struct(F.lit(k).alias("rule"), ((F.length(f"line{k}") - F.length(f"line{k + 1}")) / (len(mark) - 1)).cast("int").alias("times")))
    return rows.select("doc_id", "ids", F.filter(F.array(*hits), lambda h: h["times"] > 0).alias("hits"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = match_rules(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(n) for n, _ in RULES])
    licences = F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda h: F.element_at(names, h["rule"] + 1)))), ",")
    times = F.aggregate("hits", F.lit(0), lambda a, h: a + h["times"])
    listed = F.array_join(F.transform("ids", lambda x: F.concat_ws(":", x["place"].cast("string"), x["id"])), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), listed.alias("sentences"), times.cast("long").alias("n_matches"), licences.alias("licences"))


def _sql() -> str:
    known = ", ".join(f"('{s}', '{k}')" for k, s in SENTENCES.items())
    steps, before = [], "line"
    for k, (_, rule) in enumerate(RULES):
        mark = "".join(f"|{s}|" for s in rule)
        steps.append(f"l{k + 1} AS (SELECT *, replace({before}, '{mark}', ' ') AS line{k + 1}, CAST((length({before}) - length(replace({before}, '{mark}', ' '))) / {len(mark) - 1} AS BIGINT) AS t{k} FROM l{k})")
        before = f"line{k + 1}"
    names = ", ".join(f"CASE WHEN t{k} > 0 THEN '{n}' END" for k, (n, _) in enumerate(RULES))
    return rf"""
WITH known(sentence, id) AS (VALUES {known}),
cut AS (SELECT doc_id, rowid_ AS r, unnest(range(len(s))) AS place, unnest(s) AS sentence
  FROM (SELECT doc_id, row_number() OVER () AS rowid_, string_split(regexp_replace(coalesce(text, ''), '([^.!?\n][.!?])[ \t\r]+', '\1' || chr(10), 'g'), chr(10)) AS s FROM documents)),
hits AS (SELECT c.doc_id, c.r, c.place, k.id FROM cut c LEFT JOIN known k ON length(c.sentence) >= 10 AND k.sentence = trim(regexp_replace(lower(c.sentence), '[^a-z0-9]+', ' ', 'g'))),
l0 AS (SELECT doc_id, r, count(id) AS n_sentences, coalesce(string_agg(place || ':' || id, ',' ORDER BY place) FILTER (id IS NOT NULL), '') AS sentences,
  '|' || coalesce(string_agg(id || '|', '|' ORDER BY place) FILTER (id IS NOT NULL), '') AS line FROM hits GROUP BY doc_id, r),
{", ".join(steps)}
SELECT doc_id, n_sentences, sentences, {" + ".join(f"t{k}" for k in range(len(RULES)))} AS n_matches,
  array_to_string(list_sort(list_distinct(list_filter([{names}], lambda x: x IS NOT NULL))), ',') AS licences
FROM l{len(RULES)}
"""


SQL = _sql()
