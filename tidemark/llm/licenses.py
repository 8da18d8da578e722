"""Licence scans by sentences and rules.

A text is cut into sentences, which are normalised and mapped to the identifiers of
known licence sentences; the rest become 0. A rule is an ordered sequence of identifiers; a
licence is found where its rule's identifiers follow each other. Only DataFrame
functions are used, within the row: nothing is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick

# Sentences of public licences and notices, by identifier.
SENTENCES = {
    1: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    2: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    3: "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    4: "Released under the MIT License.",
    5: "Licensed under the MIT License.",
    6: "Licensed under the Apache License, Version 2.0.",
    7: "Licensed under the Apache License, Version 2.0 (the \"License\");",
    8: "you may not use this file except in compliance with the License.",
    9: "You may obtain a copy of the License at",
    10: "This work is licensed under the GNU General Public License, version 3.",
    11: "This work is licensed under the GNU General Public License, version 2.",
    12: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    13: "Licensed under CC BY-NC 4.0.",
    14: "Licensed under CC BY 4.0.",
    15: "Licensed under CC BY-SA 4.0.",
    16: "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    17: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    18: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    19: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    20: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    21: "All rights reserved.",
    22: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    23: "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

# Rules in order of preference, each a licence and its sentences in order.
RULES = (
    ("MIT", (1, 2, 3)),
    ("MIT", (4,)),
    ("MIT", (5,)),
    ("Apache-2.0", (7, 8, 9)),
    ("Apache-2.0", (6,)),
    ("GPL-3.0", (12,)),
    ("GPL-3.0", (10,)),
    ("GPL-2.0", (11,)),
    ("CC-BY-NC-4.0", (13,)),
    ("CC-BY-4.0", (14,)),
    ("CC-BY-4.0", (16,)),
    ("CC-BY-SA-4.0", (15,)),
    ("BSD-3-Clause", (17, 18, 19, 20)),
    ("BSD-2-Clause", (17, 18, 19)),
    ("ISC", (22,)),
    ("MPL-2.0", (23,)),
    ("all-rights-reserved", (21,)),
)

#: Licences that do not allow any use.
CLOSED = ("all-rights-reserved", "CC-BY-NC-4.0")

# A sentence ends at a line's end, or at a mark before white space.
_BREAK = r"\n+|(?<=[.:;!?])\s+"
_ODD = "[^a-z0-9]+"
_MARK = r"(?<=[.:;!?])\s+"
# Words that comment out a line; other comment marks have no letters.
_COMMENT = "(?:dnl|rem|c)"
_NUMBER = "(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})"
_NUMBERED = rf"([\x01\n][^a-z0-9\n\x01]*)({_NUMBER})(?:\)[ \t]*|\.(?=[a-z]))"


def normalised(sentence: Column) -> Column:
    """Lower case, with everything but a-z and 0-9 as single spaces."""
    return F.trim(F.regexp_replace(F.lower(sentence), _ODD, " "))


def _plain(sentence: str) -> str:
    return re.sub(_ODD, " ", sentence.lower()).strip()


def known_parts(sentences: dict[int, str]) -> dict[str, str]:
    """Identifier, as text, of each normalised part of the known sentences, which may break up.

    The parts of a sentence that holds a break itself get the identifier in turn; all but the
    last are ``n.k``, and a rule asks for all of them.
    """
    known: dict[str, str] = {}
    for n, sentence in sentences.items():
        parts = [p for p in map(_plain, re.split(_BREAK, sentence)) if p]
        for k, part in enumerate(parts):
            known.setdefault(part, f"{n}" if len(parts) == 1 else f"{n}.{k}")
    return known


def chains_of(rules: tuple, sentences: dict[int, str]) -> list[tuple[str, str]]:
    """For each rule the line of its identifiers, comma-bounded, and its licence."""
    of: dict[int, list[str]] = {}
    for part in known_parts(sentences).values():
        of.setdefault(int(part.split(".")[0]), []).append(part)
    return [("," + ",".join(x for n in ids for x in of[n]) + ",", name) for name, ids in rules]


def sentence_ids(text: Column, sentences: dict[int, str]) -> Column:
    """Identifiers of a text's sentences in order, ``0`` for those unknown; empty ones are left out.

    A known sentence is found also where it is wrapped: single line ends, with comment marks, are
    white space within it, empty lines are not. A list number before it is no part of it;
    one cut off as a sentence of its own is ``-``. What is not known is cut at line ends.
    """
    known = known_parts(sentences)
    pairs = [F.lit(x) for item in sorted(known.items()) for x in item]
    table = F.create_map(*pairs)
    # 1 ends a sentence, 2 follows a list number; what stands in their place in a text is no word.
    cut = F.regexp_replace(F.translate(F.lower(text), "\x01\x02", "--"), _MARK, "\x01")
    cut = F.concat(F.lit("\x01"), cut, F.lit("\x01"))
    cut = F.regexp_replace(cut, _NUMBERED, "$1$2\x02")
    cut = F.regexp_replace(cut, r"[^a-z0-9\n\x01\x02]+", " ")
    cut = F.regexp_replace(cut, r"[ \n]*\x01[ \n\x01]*| ?\n ?\n[ \n]*", "\x01")
    cut = F.regexp_replace(cut, r" ?\n ?", "\n")
    wrapped = "|".join(k.replace(" ", rf"(?: |\n(?:{_COMMENT} )?)") for k in sorted(known))
    lead = rf"(?:{_COMMENT} )?(?:{_NUMBER} ?\x02 ?)?"
    either = rf"(?<=[\x01\n]){lead}(?:{wrapped})(?=[\x01\n])|[^\x01\n]+"
    parts = F.regexp_extract_all(cut, F.lit(either), F.lit(0))
    bare = F.transform(
        parts, lambda s: F.regexp_replace(F.regexp_replace(s, rf"\n(?:{_COMMENT} )?", " "), rf"^{lead}", "")
    )
    bare = F.filter(F.transform(bare, normalised), lambda s: s != "")
    return F.transform(
        bare,
        lambda s: F.when(s.isin(sorted(known)), F.element_at(table, s))
        .when(s.rlike(rf"^(?:{_NUMBER}|{_COMMENT})$"), F.lit("-"))
        .otherwise(F.lit("0")),
    )


def scan(
    docs: DataFrame,
    sentences: dict[int, str] | None = None,
    rules: tuple[tuple[str, tuple[int, ...]], ...] = RULES,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_sentences``, ``n_known``, ``licences``, ``n_licences``, ``permissive``.

    ``licences`` has the licences found, without repeats, sorted and comma-joined; a rule
    whose sentences lie within those of an earlier rule of more sentences still counts only if
    its licence differs and the longer one is absent. A known sentence counts once, however it
    is wrapped; list numbers between known sentences do not part them. Null, empty and wordless texts have no
    sentences. Repeated rows come back as often as given; other columns are ignored; an
    empty table gives no rows. The whole text is read.
    """
    sentences = SENTENCES if sentences is None else sentences
    chains = chains_of(rules, sentences)
    ids = sentence_ids(F.coalesce("text", F.lit("")), sentences)
    line = F.concat(F.lit(","), F.array_join(F.filter("ids", lambda x: x != "-"), ","), F.lit(","))
    found = []
    for chain, name in chains:
        longer = [c for c, other in chains if chain in c and c != chain and other != name]
        hit = F.col("line").contains(chain)
        for c in longer:
            hit = hit & ~F.col("line").contains(c)
        found.append(F.when(hit, F.lit(name)))
    named = F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))
    return (
        pick(docs, "doc_id", "text")
        .select("doc_id", ids.alias("ids"))
        .withColumn("line", line)
        .withColumn("named", named)
        .select(
            "doc_id",
            F.size("ids").cast("long").alias("n_sentences"),
            F.size(F.filter("ids", lambda x: ~x.isin("0", "-"))).cast("long").alias("n_known"),
            F.array_join("named", ",").alias("licences"),
            F.size("named").cast("long").alias("n_licences"),
            (
                (F.size("named") > 0)
                & ~F.arrays_overlap("named", F.array(*map(F.lit, CLOSED)))
            ).alias("permissive"),
        )
    )
