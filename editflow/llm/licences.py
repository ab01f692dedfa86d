"""Licences in texts, by rules over known sentences.

A text is cut into sentences; each is normalised and looked up in a table of known licence
sentences, which gives its identifier. A newline may end a sentence or be a blank in a known
one that is wrapped: the longest run of lines that is a known sentence counts as one. List
numbers and lead-ins are left out. A licence rule is an ordered list of identifiers, with at
most GAP other sentences between two of them; bare list numbers are no others. Another
licence adds rows to the tables, no work per text. Only built-in expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ends of sentences; a single newline may be one, or a blank.
SENTENCE_END = r"[.!?][ \t\n\r\f]+|\n{2,}"
GAP = 2
# What may stand before a known sentence, or after it, once both are normalised.
LEAD = (
    "^(?:[0-9]{1,2} )?(?:(?:this|the|all) (?:file|files|software|work|project|program|code|source code|library|package"
    "|document|documentation|material|data|repository|module|content) (?:is|are) )?(?:hereby )?"
)
NOTICE = "^(?:released|licensed|distributed|available|published|provided) under (?:the terms of )?(?:the )?"
TAIL = " (?:see|as described in|as found in|refer to) (?:the )?(?:accompanying )?(?:file|license|copying|notice|readme|root)( .*)?$"

# A notice may or may not end so.
END = " license$"

# Sentences of published licences and notices, normalised to lower-case
# letters and digits between single spaces. A sentence's identifier is its place, from 1.
SENTENCES = (
    "released under the mit license",
    "licensed under the mit license",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the software",
    "licensed under the apache license version 2 0",
    "licensed under the apache license version 2 0 the license",
    "you may not use this file except in compliance with the license",
    "you may obtain a copy of the license at",
    "this work is licensed under the gnu general public license version 3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation either version 3 of the license or at your option "
    "any later version",
    "this program is distributed in the hope that it will be useful but without any warranty",
    "without even the implied warranty of merchantability or fitness for a particular purpose",
    "licensed under cc by nc 4 0",
    "licensed under cc by 4 0",
    "licensed under cc by sa 4 0",
    "this work is licensed under a creative commons attribution 4 0 international license",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission",
    "this source code form is subject to the terms of the mozilla public license v 2 0",
    "all rights reserved",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
    "public license as published by the free software foundation either version 2 1 of the license or at your option "
    "any later version",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
    "public license as published by the free software foundation either version 3 of the license or at your option "
    "any later version",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation either version 2 of the license or at your option "
    "any later version",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general "
    "public license as published by the free software foundation either version 3 of the license or at your option "
    "any later version",
    "this is free and unencumbered software released into the public domain",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
    "accompanying documentation covered by this license the software to use reproduce display distribute execute and "
    "transmit the software and to prepare derivative works of the software and to permit third parties to whom the "
    "software is furnished to do so all subject to the following",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to "
    "alter it and redistribute it freely subject to the following restrictions",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
    "warranty of merchantability or fitness for a particular purpose",
)
# Names under which notices speak of a licence, as in 'released under the MIT license'.
NAMES = {
    "MIT": ("mit",),
    "Apache-2.0": ("apache 2 0", "apache license version 2 0", "apache license 2 0"),
    "GPL-3.0": ("gnu general public license version 3", "gnu general public license v3", "gnu gpl v3", "gpl v3", "gplv3"),
    "GPL-2.0": ("gnu general public license version 2", "gnu general public license v2", "gnu gpl v2", "gpl v2", "gplv2"),
    "LGPL-3.0": ("gnu lesser general public license version 3", "gnu lgpl v3", "lgpl v3", "lgplv3"),
    "LGPL-2.1": ("gnu lesser general public license version 2 1", "gnu lgpl v2 1", "lgpl v2 1"),
    "AGPL-3.0": ("gnu affero general public license version 3", "gnu agpl v3", "agpl v3", "agplv3"),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license v 2 0", "mpl 2 0"),
    "BSD-3-Clause": ("bsd 3 clause", "3 clause bsd", "new bsd"),
    "BSD-2-Clause": ("bsd 2 clause", "2 clause bsd", "simplified bsd"),
    "ISC": ("isc",),
    "CC0-1.0": ("cc0 1 0", "cc0"),
    "CC-BY-4.0": ("cc by 4 0",),
    "CC-BY-SA-4.0": ("cc by sa 4 0",),
    "CC-BY-NC-4.0": ("cc by nc 4 0",),
}

# Licences (SPDX identifiers) and the sentences that show them, in order.
RULES = (
    ("MIT", (1,)),
    ("MIT", (2,)),
    ("MIT", (3, 4)),
    ("Apache-2.0", (5,)),
    ("Apache-2.0", (6, 7)),
    ("Apache-2.0", (7, 8)),
    ("GPL-3.0", (9,)),
    ("GPL-3.0", (10, 11)),
    ("GPL-3.0", (10, 32)),
    ("CC-BY-NC-4.0", (13,)),
    ("CC-BY-4.0", (14,)),
    ("CC-BY-4.0", (16,)),
    ("CC-BY-SA-4.0", (15,)),
    ("BSD-3-Clause", (17, 18, 22, 19)),
    ("BSD-3-Clause", (17, 18, 19)),
    ("BSD-2-Clause", (17, 18)),
    ("MPL-2.0", (20,)),
    ("ISC", (23,)),
    ("ISC", (24,)),
    ("LGPL-2.1", (25,)),
    ("LGPL-3.0", (26,)),
    ("GPL-2.0", (27, 11)),
    ("GPL-2.0", (27, 32)),
    ("AGPL-3.0", (28, 11)),
    ("AGPL-3.0", (28, 32)),
    ("Unlicense", (29,)),
    ("BSL-1.0", (30,)),
    ("Zlib", (31,)),
)


def trimmed(sentence: str) -> str:
    """A normalised sentence without list number, lead-in and reference to a file; notices begin with 'under'."""
    plain = re.sub(TAIL, "", re.sub(LEAD, "", sentence.replace("licence", "license")))
    return re.sub(END, "", re.sub(NOTICE, "under ", plain))


def table() -> tuple[dict[str, int], list[tuple[str, tuple[int, ...]]]]:
    """Identifiers of all known sentences, and all rules; notices by name come after the others."""
    known: dict[str, int] = {}
    place = [known.setdefault(trimmed(s), len(known) + 1) for s in SENTENCES]
    rules = list(dict.fromkeys((name, tuple(place[i - 1] for i in rule)) for name, rule in RULES))
    for licence, names in NAMES.items():
        for name in names:
            at = known.setdefault(trimmed(f"licensed under the {name} license"), len(known) + 1)
            if (licence, (at,)) not in rules:
                rules.append((licence, (at,)))
    return known, rules


KNOWN, ALL_RULES = table()
# No known sentence has more words, so a wrapped one no more lines.
MOST_LINES = max(len(s.split()) for s in KNOWN) + 8
# Every known sentence has one of these; other texts are not searched.
HINT = "(?i)licen[sc]|permission|redistribution|warranty|rights|encumbered|released|available|distributed|published|provided"


def normal(text: Column) -> Column:
    """Lower-case letters and digits between single spaces."""
    return F.trim(F.lower(F.regexp_replace(text, "[^a-zA-Z0-9]+", " ")))


def marks(text: Column) -> Column:
    """'<' identifier '>' for each known sentence, '#' for a bare list number, '.' for other lines."""
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])

    def identifier(sentence: Column) -> Column:
        plain = F.replace(sentence, F.lit("licence"), F.lit("license"))
        plain = F.regexp_replace(F.regexp_replace(plain, LEAD, ""), TAIL, "")
        return F.try_element_at(known, F.regexp_replace(F.regexp_replace(plain, NOTICE, "under "), END, ""))

    def other(line: Column) -> Column:
        return F.when(line.rlike("^[0-9]{1,2}$"), "#").otherwise(".")

    def of(lines: Column) -> Column:
        """Marks of a sentence's lines, from the first one on: the longest known run, or one line."""
        size = F.size(lines)

        def runs(i: Column) -> Column:
            upto = F.sequence(i, F.least(size - 1, i + MOST_LINES))
            runs = F.transform(
                upto,
                lambda j: F.struct(j.alias("j"), identifier(F.array_join(F.slice(lines, i + 1, j - i + 1), " ")).alias("id")),
            )
            return F.array_max(F.filter(runs, lambda r: r["id"].isNotNull()))

        def step(done: Column, i: Column) -> Column:
            line = F.struct((i + 1).alias("next"), F.concat(done["marks"], other(F.get(lines, i))).alias("marks"))

            def whole(run: Column) -> Column:
                mark = F.concat(done["marks"], F.lit("<"), run["id"].cast("string"), F.lit(">"))
                return F.struct((run["j"] + 1).alias("next"), mark.alias("marks"))

            new = F.transform(F.array(runs(i)), lambda run: F.when(run.isNull(), line).otherwise(whole(run)))
            return F.when(i < done["next"], done).otherwise(F.get(new, F.lit(0)))

        start = F.struct(F.lit(0).alias("next"), F.lit("").alias("marks"))
        return F.aggregate(F.sequence(F.lit(0), size - 1), start, step, lambda done: done["marks"])

    sentences = F.split(F.regexp_replace(F.translate(text, "\x1f", " "), SENTENCE_END, "\x1f"), "\x1f")
    lines = F.transform(sentences, lambda s: F.filter(F.transform(F.split(s, "\n"), normal), lambda x: x != ""))
    lines = F.filter(lines, lambda x: F.size(x) > 0)
    plain = F.transform(F.flatten(lines), other)
    found = F.transform(lines, lambda x: F.when(F.array_join(x, " ").rlike(HINT), of(x)).otherwise(F.array_join(F.transform(x, other), "")))
    return F.when(text.rlike(HINT), F.array_join(found, "")).otherwise(F.array_join(plain, ""))


def pattern(rule: tuple[int, ...], gap: int = GAP) -> str:
    """A rule over marks: identifiers in order, with any bare list numbers and at most `gap` others between."""
    return rf"#*(?:[.]#*){{0,{gap}}}".join(f"<{i}>" for i in rule)


def licences(docs: DataFrame, gap: int = GAP) -> DataFrame:
    """docs (doc_id, text) with n_sentences, n_known, licences; one row per row of docs.

    licences holds the licences whose rules match, each once, in the order of the rules,
    joined by commas; it is empty if none does, and for null and empty texts. n_sentences
    counts lines, a wrapped known sentence once. Columns of docs with these names are
    replaced, all others stay.
    """
    rows = docs.drop("n_sentences", "n_known", "licences")
    rows = rows.select("*", F.inline(F.array(F.struct(marks(F.coalesce("text", F.lit(""))).alias("_marks")))))
    singles = F.create_map(*[F.lit(x) for name, rule in ALL_RULES if len(rule) == 1 for x in (rule[0], name)])
    alone = F.transform(
        F.regexp_extract_all("_marks", F.lit("<([0-9]+)>")), lambda i: F.try_element_at(singles, i.cast("int"))
    )
    chains = [F.when(F.col("_marks").rlike(pattern(rule, gap)), F.lit(name)) for name, rule in ALL_RULES if len(rule) > 1]
    found = F.array_distinct(F.array_compact(F.concat(F.array(*chains), alone)))
    order = F.array(*[F.lit(name) for name in dict.fromkeys(name for name, _ in ALL_RULES)])
    listed = F.filter(order, lambda name: F.array_contains(found, name))
    known = F.col("_marks").contains("<")
    return rows.select(
        *[c for c in rows.columns if c != "_marks"],
        F.regexp_count("_marks", F.lit("[<.#]")).cast("long").alias("n_sentences"),
        F.regexp_count("_marks", F.lit("<")).cast("long").alias("n_known"),
        F.when(known, F.array_join(listed, ",")).otherwise("").alias("licences"),
    )


def licences_sql(gap: int = GAP) -> str:
    """The same in SQL: runs of lines, looked up in the list of known sentences."""
    known = ", ".join(f"'{s}'" for s in KNOWN)
    singles = ", ".join(f"({rule[0]}, '{name}')" for name, rule in ALL_RULES if len(rule) == 1)
    chains = ", ".join(
        f"case when regexp_matches(marks, '{pattern(rule, gap)}') then '{name}' end" for name, rule in ALL_RULES if len(rule) > 1
    )
    order = ", ".join(f"'{name}'" for name in dict.fromkeys(name for name, _ in ALL_RULES))
    return f"""
with s as (
  select row_number() over () as r, doc_id, regexp_split_to_array(replace(coalesce(text, ''), chr(31), ' '), '{SENTENCE_END}') as sentences
  from documents
), u as (
  select r, doc_id, unnest(sentences) as sentence, generate_subscripts(sentences, 1) as place from s
), l as (
  select r, doc_id, place, list_filter(list_transform(string_split(sentence, chr(10)),
    lambda x: trim(lower(regexp_replace(x, '[^a-zA-Z0-9]+', ' ', 'g')))), lambda x: x <> '') as lines from u
), m as (
  select r, doc_id, place, lines, case
    when len(lines) = 0 then ''
    when not regexp_matches(array_to_string(lines, ' '), '{HINT}') then array_to_string(list_transform(lines,
      lambda x: case when regexp_matches(x, '^[0-9]{{1,2}}$') then '#' else '.' end), '')
    else list_reduce(list_prepend({{'next': 0::bigint, 'marks': ''}}, list_transform(range(len(lines)), lambda i: {{'next': i, 'marks': ''}})),
      lambda done, i: case when i.next < done.next then done else
        list_transform([list_max(list_filter(list_transform(range(i.next, least(len(lines), i.next + {MOST_LINES + 1})),
            lambda j: {{'j': j, 'id': list_position([{known}], regexp_replace(regexp_replace(regexp_replace(regexp_replace(
              replace(array_to_string(lines[i.next + 1 : j + 1], ' '), 'licence', 'license'), '{LEAD}', ''), '{TAIL}', ''),
              '{NOTICE}', 'under '), '{END}', ''))}}),
            lambda run: coalesce(run.id, 0) > 0))],
          lambda run: case when run is null
            then {{'next': i.next + 1, 'marks': done.marks || case when regexp_matches(lines[i.next + 1], '^[0-9]{{1,2}}$') then '#' else '.' end}}
            else {{'next': run.j + 1, 'marks': done.marks || '<' || run.id || '>'}} end)[1] end).marks end as marks
  from l
), d as (
  select r, any_value(doc_id) as doc_id, string_agg(marks, '' order by place) as marks from m group by r
), found as (
  select doc_id, marks, list_concat(list_filter([{chains}], lambda x: x is not null),
    list_transform(regexp_extract_all(marks, '<([0-9]+)>', 1), lambda i: map_from_entries([{singles}])[i::int])) as names
  from d
)
select doc_id,
       (length(regexp_replace(marks, '[^<.#]', '', 'g')))::bigint as n_sentences,
       (length(regexp_replace(marks, '[^<]', '', 'g')))::bigint as n_known,
       array_to_string(list_filter([{order}], lambda x: list_contains(names, x)), ',') as licences
from found
"""
