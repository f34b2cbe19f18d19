"""Licences by sentences.

A text is normalised to lower-case words with marks where lines, clauses and
sentences end. A sentence that licences are known to hold becomes its identifier,
however its lines are wrapped. The table has two kinds: a sentence of a licence's
own text (``TEXTS`` and notices) is known wherever it stands; a line that only names
a licence must be all there is between two marks, as it says something else when it
goes on. A licence is recognised where the identifiers of one of its rules follow
each other, with at most ``GAP`` other sentences in between. All of it is built-in
functions: the table and the rules have some hundred lines and travel in the plan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Other sentences that may stand between two sentences of a licence (copyright lines, headings, a stray line break).
GAP = 2

# Licences of one name and several versions, by name and version. Fixed values, as published.
VERSIONED: tuple[tuple[str, str, str], ...] = (
    ("Apache-2.0", "apache license", "2 0"),
    ("GPL-2.0-only", "gnu general public license", "2"),
    ("GPL-3.0-only", "gnu general public license", "3"),
    ("LGPL-2.1-only", "gnu lesser general public license", "2 1"),
    ("LGPL-3.0-only", "gnu lesser general public license", "3"),
    ("AGPL-3.0-only", "gnu affero general public license", "3"),
    ("MPL-2.0", "mozilla public license", "2 0"),
    ("EPL-1.0", "eclipse public license", "1 0"),
    ("EPL-2.0", "eclipse public license", "2 0"),
    ("EUPL-1.2", "european union public licence", "1 2"),
    ("CDDL-1.0", "common development and distribution license", "1 0"),
    ("Artistic-2.0", "artistic license", "2 0"),
    ("BSL-1.0", "boost software license", "1 0"),
    ("OFL-1.1", "sil open font license", "1 1"),
)

# Licences by a name without a version. Fixed values, as published.
NAMED: tuple[tuple[str, str], ...] = (
    ("MIT", "mit license"),
    ("ISC", "isc license"),
    ("Zlib", "zlib license"),
    ("Unlicense", "unlicense"),
    ("BSD-2-Clause", "bsd 2 clause license"),
    ("BSD-3-Clause", "bsd 3 clause license"),
    ("PostgreSQL", "postgresql license"),
    ("NCSA", "university of illinois ncsa open source license"),
)

# Conditions of the Creative Commons licences, and how their versions are called. Fixed values, as published.
COMMONS: tuple[tuple[str, str], ...] = (
    ("BY", "attribution"),
    ("BY-SA", "attribution sharealike"),
    ("BY-ND", "attribution noderivatives"),
    ("BY-NC", "attribution noncommercial"),
    ("BY-NC-SA", "attribution noncommercial sharealike"),
    ("BY-NC-ND", "attribution noncommercial noderivatives"),
)
COMMONS_VERSIONS: tuple[tuple[str, str], ...] = (("3.0", "unported"), ("4.0", "international"))

# Sentences that grant a licence by naming it begin so.
GRANTS: tuple[str, ...] = ("licensed under", "released under", "distributed under", "this work is licensed under", "this project is licensed under")

# The notices that the GNU licences ask for: licence, name, version. Fixed values, from the public texts.
NOTICES: tuple[tuple[str, str, str], ...] = (
    ("GPL-2.0", "general", "2"),
    ("GPL-3.0", "general", "3"),
    ("LGPL-2.1", "lesser general", "2 1"),
    ("LGPL-3.0", "lesser general", "3"),
    ("AGPL-3.0", "affero general", "3"),
)

# Normalised licence sentences by identifier. Fixed values, from the public texts of the licences.
TEXTS: dict[str, str] = {
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit_liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "mit0_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",
    "x11_names": "except as contained in this notice the name of the x consortium shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization from the x consortium",
    "ncsa_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "apache_grant": "licensed under the apache license version 2 0 the license",
    "apache_comply": "you may not use this file except in compliance with the license",
    "apache_copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache_basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "apache_title": "apache license",
    "apache_date": "version 2 0 january 2004",
    "apache_terms": "terms and conditions for use reproduction and distribution",
    "gnu_general_title": "gnu general public license",
    "gnu_lesser_title": "gnu lesser general public license",
    "gnu_affero_title": "gnu affero general public license",
    "gpl2_date": "version 2 june 1991",
    "gpl3_date": "version 3 29 june 2007",
    "lgpl21_date": "version 2 1 february 1999",
    "agpl3_date": "version 3 19 november 2007",
    "gfdl_grant": "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3 or any later version published by the free software foundation with no invariant sections no front cover texts and no back cover texts",
    "cc0_work": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "cc0_person": "to the extent possible under law the person who associated cc0 with this work has waived all copyright and related or neighboring rights to this work",
    "bsd_grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_advertising": "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "bsd_names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd_warranty": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "postgresql_grant": "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies",
    "zlib_warranty": "this software is provided as is without any express or implied warranty",
    "zlib_liability": "in no event will the authors be held liable for any damages arising from the use of this software",
    "zlib_grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "bsl_grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "mpl_subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "epl1_terms": "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",
    "epl2_terms": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "cddl_subject": "the contents of this file are subject to the terms of the common development and distribution license the license",
    "ofl_font": "this font software is licensed under the sil open font license version 1 1",
    "unlicense_free": "this is free and unencumbered software released into the public domain",
    "unlicense_anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "wtfpl_just": "you just do what the fuck you want to",
}

# Ordered rules on those texts: a licence, and the sentences that follow each other in it.
TEXT_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("X11", ("mit_grant", "mit_notice", "mit_warranty", "mit_liability", "x11_names")),
    ("MIT", ("mit_grant", "mit_notice", "mit_warranty", "mit_liability")),
    ("MIT", ("mit_grant", "mit_notice", "mit_warranty")),
    ("MIT", ("mit_grant", "mit_notice")),
    ("MIT-0", ("mit0_grant", "mit_warranty")),
    ("NCSA", ("ncsa_grant",)),
    ("Apache-2.0", ("apache_grant", "apache_comply", "apache_copy", "apache_basis", "apache_see")),
    ("Apache-2.0", ("apache_grant", "apache_comply")),
    ("Apache-2.0", ("apache_title", "apache_date", "apache_terms")),
    ("Apache-2.0", ("apache_title", "apache_date")),
    ("GPL-2.0-only", ("gnu_general_title", "gpl2_date")),
    ("GPL-3.0-only", ("gnu_general_title", "gpl3_date")),
    ("LGPL-2.1-only", ("gnu_lesser_title", "lgpl21_date")),
    ("LGPL-3.0-only", ("gnu_lesser_title", "gpl3_date")),
    ("AGPL-3.0-only", ("gnu_affero_title", "agpl3_date")),
    ("GFDL-1.3-or-later", ("gfdl_grant",)),
    ("BSD-4-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_advertising")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names", "bsd_warranty")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("CC0-1.0", ("cc0_work",)),
    ("CC0-1.0", ("cc0_person",)),
    ("ISC", ("isc_grant",)),
    ("0BSD", ("0bsd_grant",)),
    ("PostgreSQL", ("postgresql_grant",)),
    ("Zlib", ("zlib_warranty", "zlib_liability", "zlib_grant")),
    ("BSL-1.0", ("bsl_grant",)),
    ("MPL-2.0", ("mpl_subject",)),
    ("EPL-1.0", ("epl1_terms",)),
    ("EPL-2.0", ("epl2_terms",)),
    ("CDDL-1.0", ("cddl_subject",)),
    ("OFL-1.1", ("ofl_font",)),
    ("Unlicense", ("unlicense_free", "unlicense_anyone")),
    ("Unlicense", ("unlicense_free",)),
    ("WTFPL", ("wtfpl_just",)),
)


# Titles, dates and the like: known as whole lines only.
TITLES: frozenset[str] = frozenset(
    {"apache_title", "apache_date", "apache_terms", "gnu_general_title", "gnu_lesser_title", "gnu_affero_title", "gpl2_date", "gpl3_date", "lgpl21_date", "agpl3_date", "wtfpl_just"}
)


def words_of(name: str) -> str:
    """A licence's short name as normalised words."""
    return re.sub("[^a-z0-9]+", " ", name.lower()).strip()


def rule_base() -> tuple[dict[str, str], frozenset[str], tuple[tuple[str, tuple[str, ...]], ...]]:
    """All known sentences by identifier, the identifiers of those known as whole lines only,
    and the ordered rules, a longer one before its own beginning."""
    sentences, lines, rules = dict(TEXTS), set(TITLES), list(TEXT_RULES)

    def says(licence: str, sentence: str, line: bool = True) -> None:
        name = f"{licence}: {sentence}"
        sentences[name] = sentence
        rules.append((licence, (name,)))
        if line:
            lines.add(name)

    for licence, kind, version in NOTICES:
        terms = f"is free software you can redistribute it and or modify it under the terms of the gnu {kind} public license"
        for thing in ("program", "library"):
            known = [f"{licence} {part} {thing}" for part in ("later", "hope", "received")]
            sentences[known[0]] = f"this {thing} {terms} as published by the free software foundation either version {version} of the license or at your option any later version"
            known[1], known[2] = f"gnu hope {thing}", f"gnu {kind} received {thing}"
            sentences[known[1]] = f"this {thing} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"
            sentences[known[2]] = f"you should have received a copy of the gnu {kind} public license along with this {thing}"
            rules += [(f"{licence}-or-later", tuple(known[:n])) for n in (3, 2, 1)]
            says(f"{licence}-only", f"this {thing} {terms} version {version} as published by the free software foundation", line=False)
    for begin in GRANTS:
        for licence, name, version in VERSIONED:
            for form in ("version ", "v", ""):
                says(licence, f"{begin} the {name} {form}{version}")
        for licence, name in NAMED:
            says(licence, f"{begin} the {name}")
        for code, conditions in COMMONS:
            for version, port in COMMONS_VERSIONS:
                says(f"CC-{code}-{version}", f"{begin} {words_of(f'CC {code} {version}')}")
                for article in ("a", "the"):
                    says(f"CC-{code}-{version}", f"{begin} {article} creative commons {conditions} {words_of(version)} {port} license")
    for licence in sorted({licence for licence, _ in rules}):
        says(licence, f"spdx license identifier {words_of(licence)}")
    return sentences, frozenset(lines), tuple(rules)


SENTENCES, LINES, RULES = rule_base()


def numbers(sentences: dict[str, str]) -> dict[str, int]:
    return {name: i for i, name in enumerate(sentences, start=1)}


def rule_pattern(sentences: dict[str, str], rules: tuple, gap: int = GAP, other: str = "<0>") -> str:
    """One pattern over ``<id>`` sequences; group k is rule k. Of rules that begin at one sentence the first listed wins."""
    known = numbers(sentences)
    between = f"(?:{other}){{0,{gap}}}"
    return "|".join("(" + between.join(f"<{known[s]}>" for s in names) + ")" for _, names in rules)


# Pieces of one unknown sentence are ``~`` until a full stop or an empty line ends it.
OTHER = "~*+(?:<0>|(?=<[1-9]))"


def marked(text: Column) -> Column:
    """Lower-case words, with a mark for what stands between them: ``S`` for a full
    stop, exclamation or question mark before white space, ``N`` for a line break,
    ``C`` for a semicolon or colon.

    Only letters a-z, digits and the words they make count, so that comment signs
    before a line go; ``!`` or ``.`` as such a sign ends no sentence, nor does the
    stop of ``v. 2.0``.
    """
    lines = F.regexp_replace(F.lower(text), r"\n[ \t]*[.!?]+(?=\s)", "\n")
    ended = F.translate(F.regexp_replace(lines, r"(?:(?<!(?:^|[^a-z0-9])v)\.|[!?])\s+", "S"), "\n;:", "NCC")
    return F.regexp_replace(ended, "[^a-z0-9SNC]+", " ")


def any_of(sentences: Iterable[str]) -> str:
    """One of the sentences in a ``marked`` text, the longest that fits; lines and clauses may end within it.

    The pattern is a tree of words, so that sentences which begin alike are told apart once.
    """
    tree: dict = {}
    for sentence in sorted(sentences):
        node = tree
        for word in sentence.split():
            node = node.setdefault(word, {})
        node[""] = {}

    def following(node: dict) -> str:
        found = [word + following(after) for word, after in node.items() if word]
        if not found:
            return ""
        onward = f"[ NC]++(?:{'|'.join(found)})" if len(found) > 1 else "[ NC]++" + found[0]
        return f"(?:{onward})?" if "" in node else onward

    return f"(?:{'|'.join(word + following(after) for word, after in tree.items() if word) or '(?!)'})"


# The number of a list may go before a line.
NUMBER = "(?:(?:[0-9]{1,2}|[a-z]) )?"


def sentence_ids(text: Column, sentences: dict[str, str], lines: frozenset[str]) -> Column:
    """Of a ``marked`` text, ``<id>`` of every known sentence, and of what stands between
    them ``~`` per piece that goes on and ``<0>`` per piece that ends a sentence.
    """
    anywhere = any_of(x for name, x in sentences.items() if name not in lines)
    apart = F.regexp_replace(text, f"(?<![a-z0-9]){anywhere}(?![a-z0-9])", "C$0C")
    # A piece begins after a mark, because the one before it takes in the marks that follow.
    pieces = F.regexp_extract_all(apart, F.lit(f"(?:{NUMBER}{any_of(sentences.values())}(?! ?[a-z0-9])|[a-z0-9][a-z0-9 ]*)[ SNC]*"), F.lit(0))
    table = F.create_map(*[F.lit(x) for name, i in numbers(sentences).items() for x in (sentences[name], f"<{i}>")])

    def identifier(piece: Column) -> Column:
        words = F.trim(F.regexp_replace(piece, "[ SNC]+", " "))
        found = F.coalesce(F.try_element_at(table, words), F.try_element_at(table, F.regexp_replace(words, "^(?:[0-9]{1,2}|[a-z]) ", "")))
        return F.coalesce(found, F.when(piece.rlike("S|N ?[C ]*N"), F.lit("<0>")).otherwise(F.lit("~")))

    return F.array_join(F.transform(pieces, identifier), "")


def recognise(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    sentences: dict[str, str] = SENTENCES, lines: frozenset[str] = LINES, rules: tuple = RULES, gap: int = GAP,
) -> DataFrame:
    """One line per row: ``doc_id, licences, n_sentences, n_known``.

    ``licences`` names the licences in the order of the text, one for every
    place a rule matches from left to right without overlap. ``n_sentences``
    counts pieces that a line break or the end of a sentence closes, ``n_known``
    known sentences, wrapped or not. A null text has no sentences; an empty array
    says that there is no licence. Ids, null or repeated, are passed through;
    other columns are not read.
    """
    text = marked(F.coalesce(F.col(text_column).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))
    # Most texts hold no known sentence; the rules look at the others alone.
    anywhere = any_of(x for name, x in sentences.items() if name not in lines)
    whole = any_of(x for name, x in sentences.items() if name in lines)
    holds_any = F.col("text").rlike(f"(?:^|[SNC ])(?:{anywhere}(?![a-z0-9])|(?<=^|^ |[SNC]|[SNC] ){NUMBER}{whole}(?! ?[a-z0-9]))")
    sequence = F.when(holds_any, sentence_ids(F.col("text"), sentences, lines)).otherwise(F.lit(""))
    rows = rows.select("doc_id", F.regexp_count("text", F.lit("[a-z0-9][a-z0-9 C]*")).cast("long").alias("n_sentences"), sequence.alias("ids"))
    found = F.regexp_extract_all("ids", F.lit(rule_pattern(sentences, rules, gap, OTHER)), F.lit(0))
    known = numbers(sentences)
    named = F.create_map(*[F.lit(x) for name, names in rules for x in ("".join(f"<{known[s]}>" for s in names), name)])
    licences = F.transform(found, lambda m: F.try_element_at(named, F.regexp_replace(m, "~|<0>", "")))
    return rows.select(
        "doc_id",
        F.when(F.col("ids") != "", licences).otherwise(F.array().cast("array<string>")).alias("licences"),
        "n_sentences",
        F.regexp_count("ids", F.lit("<[1-9]")).cast("long").alias("n_known"),
    )


def oracle_sql(sentences: dict[str, str] = SENTENCES, lines: frozenset[str] = LINES, rules: tuple = RULES, gap: int = GAP) -> str:
    """The same question on ``documents`` for DuckDB, licences joined by a comma.

    Here every word has a place, and a known sentence is looked up where its first two
    words stand: it must equal the words from there on, without a full stop among them.
    """
    known = numbers(sentences)
    values = ", ".join(f"('{sentences[n]}', {i}, {n not in lines})" for n, i in known.items())
    names = ", ".join("('" + "".join(f"<{known[s]}>" for s in n) + f"', '{licence}')" for licence, n in dict((r[1], r) for r in reversed(rules)).values())
    pattern = re.sub(r"\((?!\?)", "(?:", rule_pattern(sentences, rules, gap))
    return rf"""
        WITH known(sentence, id, anywhere) AS (VALUES {values}), named(ids, licence) AS (VALUES {names}),
        k AS (SELECT *, split_part(sentence, ' ', 1) AS w, split_part(sentence, ' ', 2) AS w2 FROM known),
        a AS (SELECT row_number() OVER () AS r, doc_id, regexp_replace(lower(coalesce(text, '')), '\n[ \t]*[.!?]+(\s)', chr(10) || '\1', 'g') AS x FROM documents),
        b AS (SELECT r, doc_id, regexp_replace(regexp_replace(x, '(^|[^a-z0-9])v\.(\s)', '\1v\2', 'g'), '[.!?]\s+', 'S', 'g') AS x FROM a),
        d AS (SELECT r, doc_id, regexp_replace(translate(x, chr(10) || ';:', 'NCC'), '[^a-z0-9SNC]+', ' ', 'g') AS x FROM b),
        p AS (SELECT r, generate_subscripts(l, 1) AS place, unnest(l) AS x FROM (SELECT r, regexp_extract_all(x, '[a-z0-9]+[ SNC]*') AS l FROM d)),
        t AS (SELECT r, place, regexp_extract(x, '^[a-z0-9]+') AS w, regexp_extract(x, '[ SNC]*$') AS after FROM p),
        g AS (SELECT *, sum(length(w) + 1) OVER o - length(w) - 1 AS pos, lead(w) OVER o AS w2, lead(w) OVER o IS NULL OR after ~ '.*[SNC].*' AS ends,
                     coalesce(lag(after) OVER o ~ '.*[SNC].*', true) AS starts, sum((after LIKE '%S%')::INT) OVER o - (after LIKE '%S%')::INT AS stops
              FROM t WINDOW o AS (PARTITION BY r ORDER BY place)),
        f AS (SELECT r, string_agg(w, ' ' ORDER BY place) AS words FROM t GROUP BY r),
        c AS (SELECT g.*, pos + length(sentence) AS until, sentence, id, anywhere
              FROM g JOIN k USING (w, w2) JOIN f ON f.r = g.r WHERE substr(words, (pos + 1)::BIGINT, length(sentence)) = sentence),
        e AS (SELECT c.r, c.place AS a, g.place AS z, sentence, id, anywhere FROM c JOIN g ON g.r = c.r AND g.pos + length(g.w) = until AND g.stops = c.stops),
        e1 AS (SELECT * FROM e WHERE anywhere QUALIFY row_number() OVER (PARTITION BY r, a ORDER BY length(sentence) DESC) = 1),
        s1 AS (SELECT r, a, z, id FROM e1 QUALIFY a > coalesce(max(z) OVER (PARTITION BY r ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)),
        h AS (SELECT g.r, place, starts OR b.r IS NOT NULL AS starts, ends OR n.r IS NOT NULL AS ends, regexp_matches(w, '^([0-9]{{1,2}}|[a-z])$') AND after = ' ' AS numbers
              FROM g LEFT JOIN s1 b ON b.r = g.r AND b.z = place - 1 LEFT JOIN s1 n ON n.r = g.r AND n.a = place + 1),
        e2 AS (SELECT e.r, e.a - (NOT b.starts)::INT AS a, z, id, sentence FROM e JOIN h b ON b.r = e.r AND b.place = e.a JOIN h y ON y.r = e.r AND y.place = z
               LEFT JOIN h n ON n.r = e.r AND n.place = e.a - 1 WHERE NOT anywhere AND y.ends AND (b.starts OR (n.starts AND n.numbers))
               AND NOT EXISTS (SELECT 1 FROM s1 x WHERE x.r = e.r AND x.a <= e.z AND x.z >= e.a)),
        e3 AS (SELECT * FROM e2 QUALIFY row_number() OVER (PARTITION BY r, a ORDER BY length(sentence) DESC) = 1),
        s AS (SELECT * FROM s1 UNION ALL
              SELECT r, a, z, id FROM e3 QUALIFY a > coalesce(max(z) OVER (PARTITION BY r ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)),
        u AS (SELECT t.*, s.id IS NOT NULL AS held FROM t LEFT JOIN s ON s.r = t.r AND t.place BETWEEN s.a AND s.z WHERE t.r IN (SELECT r FROM s)),
        v AS (SELECT *, coalesce(lag(after ~ '.*[SNC].*' OR held) OVER (PARTITION BY r ORDER BY place), true)::INT AS fresh FROM u),
        y AS (SELECT *, sum(fresh) OVER (PARTITION BY r ORDER BY place) AS piece FROM v),
        i AS (SELECT r, a AS place, '<' || id || '>' AS item FROM s UNION ALL
              SELECT r, min(place), CASE WHEN regexp_matches(arg_max(after, place), 'S|N ?[C ]*N') THEN '<0>' ELSE '~' END FROM y WHERE NOT held GROUP BY r, piece),
        q AS (SELECT r, regexp_replace(regexp_replace(string_agg(item, '' ORDER BY place), '~+<0>', '<0>', 'g'), '~+', '<0>', 'g') AS ids FROM i GROUP BY r),
        m AS (SELECT r, generate_subscripts(l, 1) AS place, replace(unnest(l), '<0>', '') AS ids FROM (SELECT r, regexp_extract_all(ids, '{pattern}') AS l FROM q)),
        l AS (SELECT r, string_agg(licence, ',' ORDER BY place) AS licences FROM m JOIN named USING (ids) GROUP BY r),
        n AS (SELECT r, count(*) AS n_known FROM s GROUP BY r)
        SELECT doc_id, coalesce(licences, '') AS licences, len(regexp_extract_all(x, '[a-z0-9][a-z0-9 C]*')) AS n_sentences, coalesce(n_known, 0) AS n_known
        FROM d LEFT JOIN n USING (r) LEFT JOIN l USING (r)
    """
