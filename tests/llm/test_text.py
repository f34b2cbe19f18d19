from __future__ import annotations

import hashlib
import itertools
import math
import pickle
import random
import re
import textwrap
import zlib

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from checks.compare import connect
from skylog.llm import licenses, pii_crf, toxicity
from .helpers import compare_with_sql

SF = "/root/testdata/sf0.001"

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            holds = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda d=digits: 16 <= len(d) <= 19 and pii_crf.luhn(d),
                "phone": lambda d=digits: 8 <= len(d) <= 15,
            }[kind]
            if holds():
                found.append((kind, *m.span()))
    return found


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("0123456789.@+- ()aZé_\n"), max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii_crf.base_spans(text) == plain_spans(text)


def test_base_spans_of_documents(documents):
    for r in documents.collect():
        assert pii_crf.base_spans(r.text) == plain_spans(r.text)


def test_long_runs_stay_linear():
    n = 200_000
    for text in ("1" * n, "a" * n, "1." * n, "+1" + "(" * n, "a@" * n, "@" * n, "0" * n + ".1.1.1"):
        pii_crf.base_spans(text)
        pii_crf.runs(text)


@pytest.fixture(scope="module")
def field():
    return pii_crf.train(list(pii_crf.LABELLED))


def test_field_learns_its_table(field):
    data = pii_crf.examples(list(pii_crf.LABELLED))
    paths = field.decode([field.emissions(text, run) for text, run, _ in data])
    assert all(list(p) == labels for p, (_, _, labels) in zip(paths, data))


def test_viterbi_is_the_best_of_all_paths(field):
    import itertools

    text = "call +1 (235) 555-3833 4111 now"
    run = pii_crf.runs(text)[0]
    score = field.emissions(text, run)
    n = len(pii_crf.LABELS)

    def total(path):
        steps = sum(field.move[a, b] for a, b in zip(path, path[1:]))
        return field.move[n, path[0]] + steps + sum(score[t, p] for t, p in enumerate(path))

    best = max(itertools.product(range(n), repeat=len(run)), key=total)
    assert tuple(field.decode([score, score[:1]])[0]) == best


def test_field_generalises(field):
    found = {
        "ring (812) 555-4410 at once": [("phone", "(812) 555-4410")],
        "write to jürgen@größe.example.de.": [("email", "jürgen@größe.example.de")],
        "host 2001:db8::42:7 answered": [("ip", "2001:db8::42:7")],
        "on 2023-11-05 we sold 1200 units of 4.50": [],
        "order 4111111111111112 was late": [],
        f"to {'rené.' * 30}dupont@société.example.fr now": [("email", f"{'rené.' * 30}dupont@société.example.fr")],
    }
    for text, spans in found.items():
        added = pii_crf.added_spans([text], [pii_crf.base_spans(text)], field)[0]
        assert [(k, text[s:e]) for k, s, e in added] == spans


def test_personal_data_lines(spark, edge, nothing, documents):
    rows = spark.createDataFrame(
        [(1, "ann@x.org 10.0.0.1, 4111 1111 1111 1111 +1 (235) 555-3833 and (235) 555-3833"), (2, None), (None, "🙂 a@b.c"), (1, "")],
        "doc_id long, text string",
    )
    lines = {(r.doc_id, r.n_email): r for r in pii_crf.personal_data_digest(pii_crf.find_personal_data(rows)).collect()}
    base = "email:0:9,ip:10:18,card:20:39,phone:40:57"
    full = lines[(1, 1)]
    assert (full.n_email, full.n_ip, full.n_card, full.n_phone, full.n_added) == (1, 1, 1, 1, 1)
    assert full.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert full.spans == base + ",phone:62:76"
    assert lines[(None, 1)].spans == "email:2:7"
    assert lines[(2, 0)].spans == "" and lines[(2, 0)].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii_crf.find_personal_data(edge).count() == 10 and pii_crf.find_personal_data(nothing).count() == 0
    hidden = {r.doc_id: r.text for r in pii_crf.redact(rows.where("text != ''")).collect()}
    assert hidden == {1: "<email> <ip>, <card> <phone> and <phone>", None: "🙂 <email>"}
    for r in pii_crf.personal_data_digest(pii_crf.find_personal_data(documents)).join(documents, "doc_id").collect():
        assert r.base_sha256 == hashlib.sha256(pii_crf.written(plain_spans(r.text)).encode()).hexdigest()


MIT = """The MIT License (MIT)
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""


def test_licences(spark, edge, nothing):
    texts = {
        1: MIT,
        2: "Some words.\nReleased under the MIT License.\nMore. Licensed under CC BY-NC 4.0.",
        3: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        4: MIT.replace("The above", "One.\nTwo.\nThe above"),  # within the gap
        5: MIT.replace("The above", "One.\nTwo.\nThree.\nThe above"),  # beyond it
        6: "Licensed under the Apache License, Version 2.0 only in name",
    }
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.licences for r in licenses.recognise(rows).collect()}
    assert got == {1: ["MIT"], 2: ["MIT", "CC-BY-NC-4.0"], 3: [], 4: ["MIT"], 5: [], 6: []}
    lines = licenses.recognise(edge).collect()
    assert len(lines) == 10 and all(r.licences == [] for r in lines)
    assert licenses.recognise(nothing).count() == 0


def wrapped(text, prefix="", width=72):
    """Every paragraph in lines of at most ``width`` characters, as licence texts are published."""
    paragraphs = [textwrap.wrap(p, width) for p in text.split("\n\n")]
    return "\n".join(prefix + line for i, lines in enumerate(paragraphs) for line in ([""] if i else []) + lines)


PUBLISHED = {
    "MIT": """MIT License

Copyright (c) 2020 Someone

""" + MIT.split("\n", 1)[1].replace("\n", "\n\n").replace("NONINFRINGEMENT.", """NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}
PUBLISHED["BSD-2-Clause"] = PUBLISHED["BSD-3-Clause"].split("\n\n3.")[0]


def test_published_licences_however_they_are_wrapped(spark):
    known = {"MIT": 4, "BSD-3-Clause": 5, "BSD-2-Clause": 3, "GPL-3.0-or-later": 3, "Apache-2.0": 5, "ISC": 1, "MPL-2.0": 1}
    rows = []
    for name, text in PUBLISHED.items():
        rows += [(f"{name} {prefix!r} {width}", wrapped(text, prefix, width)) for prefix in ("", "    ", "# ", " * ", "// ", "-- ", ";; ", "! ") for width in (60, 72, 79, 10_000)]
        rows += [(f"{name} in a text", f"First words.\nMore of them\n\n{wrapped(text)}\n\nLast words"), (f"{name} at once", " ".join(text.split())), (f"{name} dos", wrapped(text).replace("\n", "\r\n"))]
        rows += [(f"{name} brackets", re.sub(r"(?m)^(\d)\.", r"(\1)", wrapped(text)))]
    got = licenses.recognise(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        name = r.doc_id.split()[0]
        assert (r.doc_id, r.licences, r.n_known) == (r.doc_id, [name], known[name])


def test_a_wrapped_sentence_that_differs_is_not_known(spark):
    rows = [
        (1, "This is\nlicensed under the\nApache License, Version 2.0 only\nin name"),
        (2, wrapped(PUBLISHED["ISC"].replace("or without fee", "or without any fee"))),
        (3, "Licensed under the. Apache License, Version 2.0"),
        (4, wrapped(PUBLISHED["MIT"].split("\n\n")[3])),
        (5, wrapped(PUBLISHED["MIT"].replace("The above", "One.\n\nTwo.\n\nThree.\n\nThe above"))),
    ]
    assert all(r.licences == [] for r in licenses.recognise(spark.createDataFrame(rows, "doc_id long, text string")).collect())


SHORT = {
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.""",
    "GPL-2.0-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "AGPL-3.0-only": "GNU AFFERO GENERAL PUBLIC LICENSE\n\nVersion 3, 19 November 2007",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-SA-3.0": "Released under CC BY-SA 3.0",
    "MPL-2.0": "SPDX-License-Identifier: MPL-2.0",
    "EPL-2.0": "Distributed under the Eclipse Public License v2.0",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
}


def test_short_notices_and_what_only_looks_like_one(spark):
    rows = [(name, wrapped(text, prefix, width)) for name, text in SHORT.items() for prefix in ("", " * ", "# ") for width in (40, 79)]
    rows += [(name, f"3) {text}" if "." in text[:300] else text) for name, text in SHORT.items()]
    lines = [f"{begin} {text}" for text in ("Released under CC BY-SA 3.0", "SPDX-License-Identifier: MPL-2.0", "Version 3, 19 November 2007") for begin in ("It is not", "")]
    rows += [("", line + " for the most part") for line in lines]
    got = licenses.recognise(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert [(r.doc_id, r.licences) for r in got] == [(name, [name] if name else []) for name, _ in rows]


def test_rule_base_tells_licences_apart():
    assert len(set(licenses.SENTENCES.values())) == len(licenses.SENTENCES)
    assert all(len(s.split()) > 1 and re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", s) for s in licenses.SENTENCES.values())
    assert licenses.LINES <= set(licenses.SENTENCES) and {s for _, names in licenses.RULES for s in names} <= set(licenses.SENTENCES)
    pattern = re.compile(licenses.any_of(licenses.SENTENCES.values()))
    assert all(pattern.match(s).group() == s for s in licenses.SENTENCES.values())


def test_licences_of_wrapped_and_mixed_texts_agree_with_sql(spark):
    """The SQL looks words up one by one; here it meets notices wrapped, cut, repeated and run together."""
    import duckdb

    pick = random.Random(7)
    notices = [*PUBLISHED.values(), *SHORT.values()]
    filler = ["Some words here.", "a heading", "v. 3", "1.", "b", "Copyright (c) 2020: Someone; all of it", "", "Is it so? Yes!", "(the", "émigré. no"]
    texts = [None, "", "\n", ".", "licensed under"]
    for _ in range(400):
        parts = []
        for _ in range(pick.randint(1, 5)):
            text = pick.choice(notices)
            words = text.split(" ")
            cut = pick.choice([len(words), len(words), pick.randint(1, len(words))])
            parts.append(wrapped(" ".join(words[:cut]), pick.choice(["", " * ", "# ", "; "]), pick.choice([30, 72, 10_000])))
            parts.append(pick.choice(filler))
        texts.append(pick.choice(["\n", " ", "\n\n", "; "]).join(parts))
    rows = list(enumerate(texts))
    got = licenses.recognise(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    con = duckdb.connect()
    con.register("given", pd.DataFrame(rows, columns=["doc_id", "text"]))
    con.execute("CREATE VIEW documents AS SELECT doc_id, text::VARCHAR AS text FROM given")
    want = {d: (li, n, k) for d, li, n, k in con.execute(f"SELECT doc_id, licences, n_sentences, n_known FROM ({licenses.oracle_sql()})").fetchall()}
    assert len(got) == len(rows) and sum(bool(r.licences) for r in got) > 200
    differ = [(r.doc_id, texts[r.doc_id], (",".join(r.licences), r.n_sentences, r.n_known), want[r.doc_id]) for r in got]
    assert [d for d in differ if d[2] != d[3]] == []


def test_licences_agree_with_sql(spark):
    assert compare_with_sql(spark, connect(SF), "op6_licenses", SF) is None


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abcé", max_size=12), min_size=1, max_size=8))
def test_automaton_finds_what_edit_distance_does(words):
    terms = ["abc", "abcab", "bcaab", "abcabcab", "ccbbaacca"]
    automaton = _automaton(tuple(terms))
    found, spent = automaton.run(words)
    for word, term, e in zip(words, found, spent):
        near = [edits(word, t) for t in terms if edits(word, t) <= toxicity.allowed_edits(t)]
        assert (term >= 0) == bool(near)
        if near:
            assert e == min(near) == edits(word, terms[term])


_made: dict = {}


def _automaton(terms):
    if terms not in _made:
        _made[terms] = toxicity.Automaton(list(terms), [], set(terms))
    return _made[terms]


def test_stems_match_whatever_follows():
    automaton = toxicity.Automaton(["idiot"], ["vequ"], {"idiot"})
    found, spent = automaton.run(["vequeur", "vequ", "veq", "xvequ", "idiott", "idxot", "idxxt", "", "idiot"])
    assert found.tolist() == [1, 1, -1, -1, 0, 0, -1, -1, 0] and spent[4] == 1 and spent[8] == 0


@pytest.fixture(scope="module")
def learned(spark):
    """Toxic texts with one of three words at changing places, clean ones without; one clean text is copied."""
    plain = [f"p{i}" for i in range(400)]
    rows = []
    for i in range(600):
        words = [plain[(i * 7 + k * (1 + i % 11)) % 400] for k in range(30)]
        toxic = i % 5 == 0
        if toxic:
            words.insert(i % 29, ("grumblewort", "snarkhead", "blathering")[i % 3])
            words.insert(i % 17, ("grumblewort", "snarkhead", "blathering")[(i // 3) % 3])
        rows.append((i, " ".join(words), int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return toxicity.train(toxicity.learning_rows(frame.select("doc_id", "text"), frame.select("doc_id", "toxic")))


def test_toxic_terms_misspellings_and_quotations(learned):
    def flagged(text):
        return toxicity.score_texts([text], learned)[0] >= toxicity.THRESHOLD

    assert set(learned.words) >= {"grumblewort", "snarkhead", "blathering"}
    assert flagged("you are a snarkhead and a grumblewort")
    assert flagged("p1 p2 GRUMBLEWORT p3 p4 p5 p6 p7 blathering")
    assert flagged("you grumblewrt, you snarkheadd")  # one and two edits
    assert not flagged("p1 p2 p3 p4")
    assert not flagged('she said "what a snarkhead" and left')
    assert not flagged("")


def test_quotations_end_where_their_marks_do(learned):
    def kind(text):
        uses = toxicity._uses(text, learned.hits(toxicity.WORD.findall(text)))
        return sorted(uses.used), sorted(uses.reported), uses.quotes

    word = "snarkhead"
    assert kind(f'he wrote "p1 p2 p3 p4 p5 p6 p7 p8 p9 {word} p1 p2 p3 p4 p5 p6 p7 p8 p9" there') == ([], [], 1)
    for a, b in ("“”", "„“", "«»", "»«", "‹›", "‘’", "‚‘", "''", '""'):
        assert kind(f"p1 {a}p2 {word} p3{b} p4") == ([], [], 1), (a, b)
    assert kind(f"p1 « p2 {word} » p3") == ([], [], 1)
    # Apostrophes and inches open nothing, a mark that nothing closes quotes nothing, and an empty line ends it.
    assert kind(f"don't, it's a {word}, isn't it") == ([word], [], 0)
    assert kind(f'a 5" board, a {word} and a 6" one') == ([word], [], 0)
    assert kind(f'p1 "p2 {word} p3') == ([word], [], 0)
    assert kind(f'p1 "p2 {word}\n\np3" p4') == ([word], [], 0)
    assert kind(f'"p1" {word} "p2"') == ([word], [], 0)
    assert kind(f'"p1 ‘{word}’ p2" {word}') == ([word], [], 1)
    assert kind(f"he was called a {word} by them") == ([], [word], 0)
    assert kind(f"he called p1 p2 p3 p4 p5 p6 a {word}") == ([word], [], 0)
    assert kind(f"he was called a {word} by them, p1 p2 p3 p4, you {word}") == ([word], [], 0)


def test_reported_terms_are_no_abuse_unless_labels_say_so(learned, spark):
    flagged = lambda text, model: toxicity.score_texts([text], model)[0] >= toxicity.THRESHOLD
    assert not flagged("he was called a snarkhead by them", learned)
    assert flagged("he is a snarkhead to them", learned)
    rows = [(f"p{i} he was called a {('grumblewort', 'snarkhead', 'blathering')[i % 3]} p{i * 7 % 90} by p{i * 3 % 80}", True) for i in range(200)]
    rows += [(f"p{i * 11 % 97} p{i * 7 % 90} by p{i * 3 % 80} was called p{i}", False) for i in range(400)]
    assert flagged("he was called a snarkhead by them", toxicity.train(spark.createDataFrame(rows, "text string, toxic boolean")))


def plain_score(text, model):
    """The score from the model's tables alone: terms by edit distance, paragraphs and windows word by word."""
    p_of = {}
    words = toxicity.WORD.findall(text.lower())
    for w in set(words):
        near = [(edits(w, t), i, t) for i, t in enumerate(model.words) if edits(w, t) <= (toxicity.allowed_edits(t) if t in model.fuzzy else 0)]
        if near and min(near)[0] == 0:
            p_of[w] = model.member.get(w, model.weight[w])
        elif near and w not in model.innocent:
            p_of[w] = model.weight[min(near)[2]] * model.fuzzy.get(min(near)[2], 0.0) / min(near)[0]
    used, reported, quotes = {}, {}, 0
    for paragraph in re.split(r"\n\s*\n", text.lower()):
        inside = [m.span() for m in re.finditer(r'(?<!\S)"(?=\S)[^"]*(?<=\S)"(?!\w)', paragraph)]
        found = list(re.finditer(r"\w+", paragraph))
        for i, m in enumerate(found):
            if m.group() not in p_of:
                continue
            if any(a < m.start() < b for a, b in inside):
                quotes += 1
            elif {f.group() for f in found[max(0, i - toxicity.WINDOW) : i]} & toxicity.REPORTING:
                reported[m.group()] = p_of[m.group()]
            else:
                used[m.group()] = p_of[m.group()]
    reported = {w: p for w, p in reported.items() if w not in used}

    def odds(terms):
        return [math.log(p / (1 - p)) for p in (min(max(p, 0.01), 0.99) for p in terms.values())]

    a, b = odds(used), odds(reported)
    x = [min(sum(a), 20.0), max([*a], default=0.0), math.log1p(len(a)), min(sum(b), 20.0), math.log1p(len(b))]
    score = 1 / (1 + math.exp(-min(30.0, max(-30.0, model.bias + sum(s * f for s, f in zip(model.slopes, x))))))
    return max(score, model.quoted) if quotes and not used and not reported else score


def test_scores_are_those_of_a_plain_version(learned):
    assert not learned.stems
    deal = random.Random(5)
    kinds = ["p1", "p2", "p3", "called", "said", "snarkhead", "grumblewort", "blathering", "snarkhed", "grumblwortt", "blatherng", "snaxxxead", "You"]
    texts = [""]
    for _ in range(300):
        parts = [deal.choice(kinds) for _ in range(deal.randint(1, 24))]
        for _ in range(deal.randint(0, 2)):
            a, b = sorted(deal.sample(range(len(parts) + 1), 2))
            if not any('"' in p or "\n" in p for p in parts[a:b]):
                parts[a], parts[b - 1] = '"' + parts[a], parts[b - 1] + '"'
        if deal.random() < 0.3:
            parts.insert(0, "p5\n \n p6")
        texts.append(" ".join(parts))
    assert toxicity.score_texts(texts, learned) == pytest.approx([plain_score(t, learned) for t in texts], abs=1e-9)


def test_every_term_is_matched_with_edits(spark):
    """More terms than a few hundred, and words of a family that a stem covers."""
    letters = "bcdfghjklmnpqrstvwxz"
    terms = [f"{a}o{b}u{c}ary" for i, a in enumerate(letters) for j, b in enumerate(letters[:5]) for k, c in enumerate(letters[:3])][:300]
    family = ["vequish", "vequard", "vequness", "vequling"]
    rows = []
    for i, term in enumerate([*terms, *family * 10]):
        rows += [(f"p{i} q{i % 7} {term} p{k} {term} p{i + k}", True) for k in range(12)]
        rows += [(f"p{i + k} p{k} q{i % 7} q{k}", False) for k in range(12)]
    model = toxicity.train(spark.createDataFrame(rows, "text string, toxic boolean"))
    assert any("vequish".startswith(s) for s in model.stems)
    assert sum(any(t.startswith(w) for w in [t, *model.stems]) for t in terms) == 300
    wrong = {t: t[:-4] + "i" + t[-4:] for t in terms} | {"vequish": "vqquish", "vequness": "wequnes"}
    hits = model.hits([w for t, w in wrong.items() if t not in model.innocent])
    assert not [t for t, w in wrong.items() if w not in hits]
    assert toxicity.score_texts(["p1 p2 vqquish p3 q1"], model)[0] >= toxicity.THRESHOLD


def test_an_automaton_that_starts_anew_finds_the_same(monkeypatch):
    words = ["".join(w) for w in itertools.product("abc", repeat=5)]
    terms = ["abcab", "bcaab", "abcabcab"]
    kept = toxicity.Automaton(terms, ["cc"], set(terms)).run(words)
    monkeypatch.setattr(toxicity, "HELD", 0)
    fresh = pickle.loads(pickle.dumps(toxicity.Automaton(terms, ["cc"], set(terms))))
    for i in range(0, len(words), 50):
        assert [x.tolist() for x in fresh.run(words[i : i + 50])] == [x[i : i + 50].tolist() for x in kept]


def test_toxicity_lines(spark, learned, edge, nothing):
    lines = toxicity.score_documents(edge, learned).collect()
    assert len(lines) == 10
    for r in lines:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.3)
    assert toxicity.score_documents(nothing, learned).count() == 0
    clean = toxicity.drop_toxic(edge, learned)
    assert clean.columns == edge.columns and clean.count() == 10
    other = toxicity.drop_toxic(edge.selectExpr("*", "7 AS _toxicity"), learned)
    assert other.columns == [*edge.columns, "_toxicity"] and {r._toxicity for r in other.collect()} == {7}


def test_held_out_rows_are_not_learned_from(spark):
    rows = spark.range(200).selectExpr("id AS doc_id", "'t' || id AS text", "1 AS toxic")
    used = {int(r.text[1:]) for r in toxicity.learning_rows(rows.select("doc_id", "text"), rows.select("doc_id", "toxic")).collect()}
    assert used == {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_training_without_toxic_rows(spark, nothing):
    rows = spark.createDataFrame([("a b c", False)], "text string, toxic boolean")
    for given_rows in (rows, rows.limit(0)):
        model = toxicity.train(given_rows)
        assert model.words == [] and toxicity.score_texts(["a", ""], model)[0] < toxicity.THRESHOLD


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(toxicity.learning_rows(docs, labels))
    judged = toxicity.score_documents(docs, model).where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.toxic for r in judged)
    assert right >= 0.92 * len(judged)
