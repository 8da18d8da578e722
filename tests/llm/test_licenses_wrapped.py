"""Licence texts as they stand in files: wrapped, numbered, commented out."""

import textwrap

import pytest

from tidemark.llm import licenses

MIT = """MIT License

Copyright (c) 2020 A. Holder

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
LIABILITY.
"""
BSD_2 = """Copyright (c) 2020, A. Holder

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
GPL_3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
TEXTS = {
    "MIT": (MIT, 3), "BSD-2-Clause": (BSD_2, 3), "BSD-3-Clause": (BSD_3, 4), "ISC": (ISC, 1),
    "GPL-3.0": (GPL_3, 2), "Apache-2.0": (APACHE, 3),
}
STYLES = {
    "plain": lambda t: t,
    "narrow": lambda t: "\n\n".join(textwrap.fill(" ".join(p.split()), 30) for p in t.split("\n\n")),
    "windows": lambda t: t.replace("\n", "\r\n"),
    "slashes": lambda t: "".join(f"// {x}\n" for x in t.split("\n")),
    "stars": lambda t: "/*\n" + "".join(f" * {x}\n" for x in t.split("\n")) + " */\nint main() {}",
    "dnl": lambda t: "".join(f"dnl {x}\n" for x in t.split("\n")),
    "brackets": lambda t: t.replace("1. ", "(1) ").replace("2. ", "b) ").replace("3. ", "iii) "),
    "letters": lambda t: t.replace("1. ", "a. ").replace("2. ", "b.\n").replace("3. ", "* "),
    "titled": lambda t: "Some title\n" + t + "more text",
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(f"{n} {s}", style(t)) for n, (t, _) in TEXTS.items() for s, style in STYLES.items()]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    return {r.doc_id: r for r in licenses.scan(df).collect()}


@pytest.mark.parametrize("style", STYLES)
@pytest.mark.parametrize("name", TEXTS)
def test_texts_as_they_stand_in_files(found, name, style):
    row = found[f"{name} {style}"]
    assert (row.licences, row.n_known, row.permissive) == (name, TEXTS[name][1], True)


def test_what_parts_a_sentence(spark):
    texts = [
        "Released under the\n\nMIT License.", "Released under the\n *\n * MIT License.",
        "Not released under\nthe MIT License.", "Released under the MIT\nLicense, or not.",
        "Released under. The\nMIT License.", "\n" * 100_000 + "Released\nunder the MIT License.",
        "(1) First\n2. Second\ne.g. third\nx\x01y\x02z",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(licenses.scan(df).collect())
    assert [r.licences for r in rows] == ["", "", "", "", "", "MIT", ""]
    assert [r.n_sentences for r in rows] == [2, 2, 2, 2, 3, 1, 6]
