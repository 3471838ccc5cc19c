"""Chat, BPE, token files, licences: contracts, round trips and odd inputs."""

import hashlib
import random
import zlib
from array import array

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from txscreen.llm import bpe, chat, licences, registry, tokenfiles

ODD = ["", " ", "a", None, "x" * 50_000, "a  b\t\n c. d!", "é" * 3000, "\U0001f600 ok", "don't  'll've", "a|b | c", "1 2 3.5", "</s>[INST] ok [/INST]", " x y \x1c z", "a\x00b", "word, word. word!?"]


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql(name, compare):
    assert compare(registry.QUERIES[name], registry.ORACLE_SQL[name]) > 0


@given(st.text(alphabet="<s>/[]INST\\ ab\n", max_size=60), st.text(alphabet="<s>[INST]\\", max_size=20))
@settings(max_examples=300, deadline=None)
def test_any_turn_comes_back(text, role):
    rendered, begin, end = chat.format_turn(role, text)
    assert [x[:2] for x in chat.parse(rendered + rendered)] == [(role, text)] * 2
    assert next(chat.parse(rendered))[2:] == (begin, end)


def test_broken_grammar_is_an_error():
    for bad in ("<s>user[INST]x", "x<s>u[INST]t[/INST]</s>", "<s>u[INST]a[INST]b[/INST]</s>", "<s>u[INST]t[/INST]z</s>"):
        with pytest.raises(chat.GrammarError):
            list(chat.parse(bad))


def test_conversations_with_nulls_ties_and_repeats(spark):
    rows = [(1, 0, "user", None, 9), (1, 1, "assistant", "b", 9), (1, 1, "assistant", "a", 9), (1, 1, "assistant", "a", 9), (None, 0, None, "x", 9), (2, None, "assistant", "[/INST]", 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment int")
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_turns(df)).collect()}
    assert got[1].n_turns == 4 and got[1].loss_sha256 == hashlib.sha256(b"aab").hexdigest() and got[1].loss_chars == 3
    assert got[None].n_turns == 1 and got[2].loss_sha256 == hashlib.sha256(b"[/INST]").hexdigest()
    assert chat.conversation_digests(chat.format_turns(df.limit(0))).count() == 0


def test_null_and_empty_roles_tie_and_long_conversations(spark):
    rows = [(1, 0, None, "b"), (1, 0, "", "a")] + [(2, i, "assistant", "x" * 200) for i in range(20_000)] + [(3, 0, "assistant", "[INST]" * 100_000)]
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert got[1].turns_sha256 == hashlib.sha256(b"\na\n\nb\n").hexdigest()
    assert (got[2].n_turns, got[2].loss_chars) == (20_000, 4_000_000) and got[3].loss_sha256 == hashlib.sha256(b"[INST]" * 100_000).hexdigest()


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(encoder, texts):
    return [x.as_py() for x in encoder.encode(pa.array(texts, pa.string()))]


def random_texts(n, seed):
    r = random.Random(seed)
    alphabet = "ab c\n\t .,'sRé漢 \x1c\x85 12²½_-\U0001f600̀<|endoftext|>"
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(n)]


def test_ids_are_those_of_the_ranks(definition, reference):
    texts = [t or "" for t in ODD] + random_texts(1500, 3)
    encoder, decoder = bpe.Encoder(definition, True), bpe.Decoder(definition)
    for t, raw in zip(texts, ids_of(encoder, texts), strict=True):
        ids = np.frombuffer(raw, "<u4")
        assert ids.tolist() == reference.encode_ordinary(t), t
        assert decoder.decode(ids) == t.encode()
        begin, end, _ = decoder.offsets(ids, t.encode())
        assert (begin <= end).all() and (not len(end) or end[-1] == len(t))


PIECES = ["a", "Word", " ", "  ", "\n", "\n\n", ".", "...", "'s", "é", "12", "|", "<|endoftext|>", "\t", "漢", "ÿ", "\x85", "%%%", "ª", "²"]


@pytest.mark.parametrize("as_text", [True, False])
def test_chunks_encode_as_the_whole_text_does(as_text):
    text = bpe.load_json(P.path("byte_bpe_50k.json"))
    plain = Tokenizer.from_str(text)
    if as_text:
        plain.encode_special_tokens = True
    r = random.Random(9)
    texts = [t or "" for t in ODD] + random_texts(1500, 4) + ["".join(r.choice(PIECES) for _ in range(r.randrange(12))) for _ in range(3000)]
    for t, raw in zip(texts, ids_of(bpe.Encoder(text, as_text), texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t


def test_special_tokens_are_the_librarys():
    text = bpe.load_json(P.path("byte_bpe_50k.json"))
    got = [np.frombuffer(x, "<u4").tolist() for x in ids_of(bpe.Encoder(text, False), ["a <|endoftext|> b", None, "b"])]
    assert got == [[64, 220, 50256, 275], [], [65]]


def test_a_small_memo_changes_nothing(definition, monkeypatch):
    texts = [t or "" for t in ODD] + random_texts(300, 5)
    want = ids_of(bpe.Encoder(definition, True), texts)
    for size in (0, 1000, 20_000):
        monkeypatch.setattr(bpe, "MEMO_BYTES", size)
        encoder = bpe.Encoder(definition, True)
        assert ids_of(encoder, texts) == want and ids_of(encoder, texts[::-1]) == want[::-1]


def test_offsets_of_split_characters(definition):
    text = "漢"
    encoder, decoder = bpe.Encoder(definition, True), bpe.Decoder(definition)
    ids = np.frombuffer(ids_of(encoder, [text])[0], "<u4")
    begin, end, split = decoder.offsets(ids, text.encode())
    assert len(ids) > 1 and split == len(ids) and begin.tolist() == [0] * len(ids) and set(end.tolist()) == {1}


def test_encode_and_decode_columns(spark, definition):
    df = spark.createDataFrame([(1, "x 漢 y", 5), (2, None, 6), (2, None, 6)], "doc_id long, text string, ids int")
    rows = bpe.decode(bpe.encode(df, definition, offsets="offsets"), definition).orderBy("doc_id").collect()
    assert [bytes(r.decoded).decode() for r in rows] == ["x 漢 y", "", ""] and len(rows[0].offsets) == len(rows[0].ids)
    digests = bpe.encoding_digests(df, definition).collect()
    assert all(r.round_trip for r in digests) and [r.n_tokens for r in digests][1:] == [0, 0]
    assert bpe.encoding_digests(df.limit(0), definition).count() == 0


def test_pieces_of_a_chunk_are_cut_once(definition, monkeypatch):
    seen = []

    class Counted:
        findall = staticmethod(lambda text, found=bpe._PIECE.findall: seen.append(text) or found(text))

    monkeypatch.setattr(bpe, "_PIECE", Counted)
    texts = ["a one,two 3.4 caf\u00e9! x\ny one,two"]
    got = bpe.Encoder(definition, True).encode(pa.array(texts)).to_pylist()
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [Tokenizer.from_str(definition).encode(t, add_special_tokens=False).ids for t in texts]
    assert len(seen) == len(set(seen)) and not {" two", ",", "4", "!"} & set(seen)


def expected_tokens(docs):
    """(doc_id or -1, crc32) by a plain call of the library, sorted."""
    plain = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = lambda t: np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
    return sorted((-1 if d[0] is None else d[0], zlib.crc32(ids(d[1]))) for d in docs)


@pytest.fixture(scope="module")
def odd_documents(spark, tmp_path_factory):
    """The folder of a documents table with odd texts, and its rows."""
    docs = [(i, t, "en", f"s{i % 3}", 1) for i, t in enumerate([*ODD, "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>"] + random_texts(200, 8))]
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder, docs


def test_token_file_query_against_the_library(spark, odd_documents):
    folder, docs = odd_documents
    got = registry.QUERIES["op3_token_files"](spark, folder).orderBy("doc_id").collect()
    assert sorted((r.doc_id, r.ids_crc32) for r in got) == expected_tokens(docs)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


def test_bpe_query_against_the_rank_library(spark, odd_documents, reference):
    folder, docs = odd_documents
    got = {r.doc_id: r for r in registry.QUERIES["op8_byte_bpe"](spark, folder).collect()}
    assert len(got) == len(docs)
    for d, t, *_ in docs:
        ids = reference.encode_ordinary(t or "")
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == want and got[d].round_trip


def test_an_id_of_many_rows_fills_several_shards(spark, tmp_path):
    docs = [(i, f"text {i}", 0) for i in range(40)] + [(20, f"copy {i % 3}", 0) for i in range(200)] + [(None, "none", 0)] * 5
    df = spark.createDataFrame(docs, "doc_id long, text string, n int").repartition(2)
    tokenfiles.write_token_set(df, str(tmp_path / "set"), bpe.load_json(P.path("byte_bpe_50k.json")), shards=6)
    got = tokenfiles.read_token_set(spark, str(tmp_path / "set")).collect()
    assert len({r.shard for r in got if r.doc_id == 20}) >= 4
    rows = tokenfiles.token_digests(spark, str(tmp_path / "set")).orderBy("start").collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids_crc32) for r in rows) == expected_tokens(docs)
    order = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert order == sorted(order) and len({r.start for r in rows}) == len(rows)


def test_token_files_round_trip(spark, tmp_path):
    text = bpe.load_json(P.path("byte_bpe_50k.json"))
    docs = [(i * 3 % 50, t, 1) for i, t in enumerate(ODD * 3)] + [(None, "null id", 1), (7, "same id", 1), (7, "same id", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, shard int").repartition(3)
    tokenfiles.write_token_set(df, str(tmp_path / "set"), text, shards=4)
    want = expected_tokens(docs)
    got = tokenfiles.token_digests(spark, str(tmp_path / "set")).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    one = tokenfiles.read_document(spark, str(tmp_path / "set"), 7).collect()
    assert len(one) == sum(d == 7 for d, *_ in docs)
    tokenfiles.write_token_set(df.limit(0), str(tmp_path / "none"), text, shards=4)
    assert tokenfiles.token_digests(spark, str(tmp_path / "none")).count() == 0


def test_license_rules(spark):
    s = licences.SENTENCES
    full = ". ".join(s[k] for k in ("mit-grant", "mit-include", "mit-as-is", "mit-liability")) + "."
    broken = ". ".join(s[k] for k in ("mit-include", "mit-grant", "mit-as-is", "mit-liability")) + "."
    rows = [(1, full), (2, broken), (3, "Text.\nReleased under the MIT License.\nLICENSED!! UNDER!! THE!! APACHE!! LICENSE,!! VERSION!! 2.0.!!"), (4, None), (5, ""), (6, "The MIT License is nice."), (7, "x" * 200_000), (1, full)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    names = [n for n, _ in licences.RULES]
    got = [(r.doc_id, sorted({names[h.rule] for h in r.hits})) for r in licences.match_rules(df).collect()]
    assert got == [(1, ["MIT"]), (2, []), (3, ["Apache-2.0", "MIT"]), (4, []), (5, []), (6, []), (7, []), (1, ["MIT"])]
    assert licences.match_rules(df.limit(0)).count() == 0


MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
APACHE = """Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2) Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of Some One, Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_wrapped_notices(spark):
    asf = APACHE.replace('Licensed under the Apache License, Version 2.0 (the "License");\nyou may', 'The ASF licenses this file\nto you under the Apache License, Version 2.0 (the "License"); you may')
    tight = "\n".join(x for x in BSD3.splitlines() if x)
    plain = [(MIT, "MIT"), (APACHE, "Apache-2.0"), (asf, "Apache-2.0"), (GPL, "GPL-3.0-or-later"), (BSD2, "BSD-2-Clause"), (BSD3, "BSD-3-Clause"), (tight, "BSD-3-Clause")]
    marked = [("".join(f"{mark} {x}\n" for x in t.splitlines()), n) for t, n in plain for mark in ("#", " *", "//")]
    ends = [(t.replace("\n", "\r\n"), n) for t, n in plain]
    none = ["Released under\n\nthe MIT License", "Released under.\nthe MIT License", "Released under\n*\nthe MIT License", "released under the\nMIT licenses", "x\x1f\x1ereleased under the MIT License"]
    cases = plain + marked + ends + [("Released under\nthe MIT License", "MIT")] + [(t, None) for t in none]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    rows = {r.doc_id: r for r in licences.match_rules(df).collect()}
    for i, (t, n) in enumerate(cases):
        whole = len(t) > 100
        assert [(licences.RULES[h.rule][0], len(licences.RULES[h.rule][1]) > 1, h.times) for h in rows[i].hits] == ([(n, whole, 1)] if n else []), t
    assert [(x.place, x.id) for x in rows[1].ids] == [(2, "apache-notice"), (3, "apache-may-not-use"), (4, "apache-obtain"), (8, "apache-as-is"), (11, "apache-see")]


GPL_V2 = GPL.replace("either version 3", "either version 2").replace("software: you", "software; you").replace("Foundation, either", "Foundation; either")
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
ISC = """ISC License

Copyright (c) 2020, Some One

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""
BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:
"""
ZLIB = """  This software is provided 'as-is', without any express or implied
  warranty.  In no event will the authors be held liable for any damages
  arising from the use of this software.

  Permission is granted to anyone to use this software for any purpose,
  including commercial applications, and to alter it and redistribute it
  freely, subject to the following restrictions:
"""


def test_further_notices(spark):
    linux = GPL_V2.replace("License as published by", "License version 2 as published by").replace("Foundation; either version 2 of the License, or\n    (at your option) any later version.", "Foundation.")
    lgpl3 = LGPL.replace("2.1 of", "3 of")
    agpl = GPL.replace("GNU General", "GNU Affero General")
    cases = [
        (GPL_V2, "GPL-2.0-or-later"), (linux, "GPL-2.0-only"), (LGPL, "LGPL-2.1-or-later"), (lgpl3, "LGPL-3.0-or-later"), (agpl, "AGPL-3.0-or-later"), (MPL, "MPL-2.0"), (MPL.replace("https", "http"), "MPL-2.0"),
        (ISC, "ISC"), (ISC.replace("and/or", "and"), "ISC"), (UNLICENSE, "Unlicense"), (BOOST, "BSL-1.0"), ("Distributed under the Boost Software License, Version 1.0.\n(See accompanying file)", "BSL-1.0"), (ZLIB, "Zlib"),
    ]
    cases += [("".join(f" * {x}\n" for x in t.splitlines()), n) for t, n in cases] + [(MPL.split("v. 2.0")[0] + "v. 2.0.", None), (GPL_V2.split("See the")[0], None)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    rows = {r.doc_id: r for r in licences.match_rules(df).collect()}
    for i, (t, n) in enumerate(cases):
        assert [(licences.RULES[h.rule][0], h.times) for h in rows[i].hits] == ([(n, 1)] if n else []), t


def test_chat_sql_escapes_as_the_round_trip_needs(spark, tmp_path):
    import duckdb

    texts = ["a \\ b", "\\", "ends with \\", "two \\\\ in", "<s>", "\\<s>", "\\[", "[INST", "x\\[/INST]y", "", None, "\\n\nline"]
    rows = [(c, t, r, x) for c, x in enumerate(texts) for t, r in enumerate(["user", "assistant", "\\role", "r\\"])]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = sorted(db.execute(chat.SQL).fetchall())
    got = chat.op1_chat_format(spark, str(tmp_path)).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars").collect()
    assert sorted(map(tuple, got)) == want


def test_small_tables_have_a_shared_dictionary_too(spark, tmp_path):
    definition = bpe.load_json(P.path("byte_bpe_50k.json"))
    kinds = {}
    for name, texts in {"none": [], "content": ["one two three four five six"] * 3, "trained": [f"number {i} of many words and lines {i * 7}" * 20 for i in range(400)]}.items():
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        tokenfiles.write_token_set(docs, str(tmp_path / name), definition, shards=2)
        kinds[name] = spark.read.parquet(str(tmp_path / name / "dictionary")).first().kind
        back = {r.doc_id: r.ids for r in tokenfiles.read_token_set(spark, str(tmp_path / name)).collect()}
        own = Tokenizer.from_str(definition)
        assert back == {i: bytes(array("I", [*own.encode(t, add_special_tokens=False).ids, 0])) for i, t in enumerate(texts)}
    assert kinds == {"none": "none", "content": "content", "trained": "trained"}
