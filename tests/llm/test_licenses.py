import random
import re

import pytest
from pyspark.sql import functions as F

from aerometer.llm import licenses as lc
from tests.llm.helpers import documents


def rows():
    rnd = random.Random(3)
    filler = lambda n: " ".join(rnd.choice("the of and rain house under river general walk public".split()) for _ in range(n))
    out, want = [], {}
    every = [(f, t) for f, ts in lc.TEMPLATES.items() for t in ts]
    for i in range(300):
        lines = [filler(rnd.randint(3, 30)) for _ in range(rnd.randint(1, 4))]
        if i < len(every):
            at = rnd.randint(0, len(lines))
            lines.insert(at, every[i][1] if i % 2 else every[i][1].upper())
            want[i, at] = every[i][0]
        out.append((i, "\n".join(lines)))
    out += [(400, None), (401, ""), (402, "\n\n"), (403, "She was licensed to drive under the general rules."), (None, "Released under the MIT License."),
            (404, "x " * 40000 + "Released under the GPL."), (405, "Released under the MIT License."), (405, "Released under the MIT License.")]
    return out, want


@pytest.fixture(scope="module")
def scanned(spark):
    data, want = rows()
    docs = documents(spark, data)
    model = lc.fit(spark, docs)
    return lc.scan(docs, model).collect(), want, model


def test_templates_are_found_and_nothing_else(scanned):
    got, want, _ = scanned
    found = {(r.doc_id, r.line): r.family for r in got if r.family != lc.UNKNOWN and r.doc_id is not None and r.doc_id < 400}
    assert set(found) <= set(want)
    right = sum(found.get(k) == f for k, f in want.items())
    assert right >= 0.9 * len(want)


def test_hard_rows(scanned):
    got, _, _ = scanned
    of = lambda i: [r.family for r in got if r.doc_id == i]
    assert of(None) == ["MIT"] and of(405) == ["MIT", "MIT"] and of(403) == [lc.UNKNOWN]
    assert not of(400) and not of(401) and not of(402) and of(404) == ["GPL"]


def test_rows_keep_their_reasons(scanned):
    got, _, _ = scanned
    for r in got:
        assert 0 <= r.confidence <= 1
        if r.family != lc.UNKNOWN:
            assert r.family == r.guess and r.likeness >= lc.FOUND and r.confidence >= 0.5 and r.template.startswith(r.family)


def test_anchors_miss_nothing_a_template_could_confirm():
    held = re.compile(r"(?<![^\W_])(?:" + "|".join(map(re.escape, lc.anchors())) + r")(?![^\W_])")
    rnd = random.Random(1)
    for t in (t for ts in lc.TEMPLATES.values() for t in ts):
        words = lc.plain_words(t)
        pairs = lc.word_pairs(words)
        for _ in range(200):
            kept = [w for w in words if rnd.random() < rnd.random()]
            if len(lc.word_pairs(kept) & pairs) >= lc.FOUND * len(pairs):
                assert held.search(" ".join(kept))


def test_empty_table(spark, scanned):
    assert lc.scan(documents(spark, []), scanned[2]).collect() == []
    assert lc.scan(documents(spark, [])).collect() == []


def test_short_lines_are_found(spark, scanned):
    lines = {"All rights reserved.": "Proprietary", "Copyright 2020 Acme. All rights reserved.": "Proprietary",
             "SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "// SPDX-License-Identifier: GPL-2.0-only": "GPL",
             "# SPDX-License-Identifier: MIT": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Released under the MIT License.": "MIT",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL",
             "All rights of the people shall be law in the land.": lc.UNKNOWN}
    got = lc.scan(documents(spark, list(enumerate(lines))), scanned[2]).collect()
    found = {r.doc_id: r.family for r in got}
    assert [found.get(i, lc.UNKNOWN) for i in range(len(lines))] == list(lines.values())


# Public notices as they stand in files, wrapped.
MIT = '''Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.'''
APACHE = '''# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'''
GPL = ''' * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.'''
BSD = '''Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.'''
NARROW = "This work is licensed\nunder the GNU General\nPublic License, version 3."
# Families that no training row knows.
UNSEEN = ['''Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:''',
          '''Everyone is permitted to copy and distribute verbatim or modified
copies of this license document, and changing it is allowed as long
as the name is changed.''',
          "Licensed under the EUPL, Version 1.2 or later.", "This font is released under the SIL Open Font License."]


def test_wrapped_notices_are_found(spark, scanned):
    lead = "The house stands by the river.\nIt rained in the city and under the bridge.\n"
    texts = [MIT, APACHE, GPL, BSD, NARROW, *(lead + t + "\nThe end of the walk." for t in (MIT, APACHE, GPL, BSD, NARROW))]
    got = lc.scan(documents(spark, list(enumerate(texts))), scanned[2]).collect()
    for i in range(len(texts)):
        want = ["MIT", "Apache-2.0", "GPL", "BSD", "GPL"][i % 5]
        mine = {r.line: r for r in got if r.doc_id == i and r.family != lc.UNKNOWN}
        assert {r.family for r in mine.values()} == {want}, texts[i]
        assert max(r.n_lines for r in mine.values()) > 1
        # the lines before and behind the notice are not part of it
        above = lead.count("\n") if i > 4 else 0
        assert min(mine) >= above and max(mine) <= above + texts[i % 5].count("\n")


def test_a_blank_line_ends_a_paragraph(spark, scanned):
    apart = NARROW.replace("\n", "\n \n")
    got = lc.scan(documents(spark, [(1, apart), (2, NARROW + "\n\n" + NARROW)]), scanned[2]).collect()
    assert {r.family for r in got if r.doc_id == 1} <= {lc.UNKNOWN}
    # its last two lines hold six of the nine pairs, so the paragraph that needs its first line begins there
    assert [(r.line, r.n_lines, r.family) for r in got if r.doc_id == 2 and r.n_lines > 1] == [(1, 2, "GPL"), (5, 2, "GPL")]


def test_families_never_seen_are_unknown(spark, scanned):
    got = lc.scan(documents(spark, list(enumerate(UNSEEN))), scanned[2]).collect()
    assert {r.family for r in got} <= {lc.UNKNOWN}


def test_clashing_names_and_null_lines(spark, scanned):
    docs = documents(spark, [(1, "Released under the MIT License."), (2, None), (3, "\n\n\n")])
    for name in ("line", "wrapped", "told", "features", "n_lines", "all"):
        docs = docs.withColumn(name, F.lit("x"))
    assert [(r.doc_id, r.family) for r in lc.scan(docs, scanned[2]).collect()] == [(1, "MIT")]
