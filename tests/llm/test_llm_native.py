"""Chat formatting, licence scans and url filters."""

import hashlib
import random
import time
from itertools import groupby

import duckdb
import numpy as np
import pandas as pd
import pytest
from llm_data import documents
from pyspark.sql import functions as F

from monthtide.llm.chat_format import chat_windows, escape, read_back, unescape, words
from monthtide.llm import sql
from monthtide.llm.license_scan import SENTENCES, scan_licenses
from monthtide.llm.url_filter import RULES, Rule, host_links, judged_urls


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


NASTY = [
    "", "plain", "a\\b", "\\", "<|turn|>", "<<|end|>|", "</s>[INST] ok [/INST]", "<s><<SYS>>x<</SYS>>",
    "<\\|turn|>", "tail\\", "[INST", "<|", "<", "line\nbreak", "😀<|text|>é", "<start_of_turn><bos>", "$1 \\1",
]


def test_escape_round_trip(spark):
    df = spark.createDataFrame([(t,) for t in NASTY], "t string")
    rows = df.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect()
    for r in rows:
        assert r.t == r.u
        for control in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<bos>"):
            assert control not in r.e


def test_words(spark):
    texts = ["", " ", "a", " a  b\n", "\x0b\x0ca\tb c\r", "é\xa0x y", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.orderBy("i").select(words(F.coalesce("t", F.lit("")))).collect()
    assert [r[0] for r in got] == [0, 0, 1, 2, 3, 2, 0]


CONVERSATIONS = (
    [(1, i, ("user", "assistant")[i % 2], f"{NASTY[i]} " + "word " * (i * 13 % 60)) for i in range(17)]
    + [(2, 0, "system", "be kind <|end|>")]
    + [(2, 1 + i, ("user", "assistant")[i % 2], f"t{i} " * 70) for i in range(9)]
    + [(3, 0, "system", "alone"), (4, 5, "assistant", None), (4, 5, "assistant", None), (4, 2, None, "x")]
    + [(5, 0, "user", "long " * 3000), (5, 1, "assistant", "yes"), (None, 0, "assistant", "no id")]
    + [(6, 1, "system", "late"), (6, 0, "user", "first"), (6, None, "assistant", "before all")]
)


def conversations(spark):
    rows = [(*r, "w", 1) for r in CONVERSATIONS]
    return spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, window string, tokens int"
    )


@pytest.mark.parametrize("sizes", [{}, {"budget": 60, "history": 20, "system": 10}])
def test_read_back(spark, sizes):
    windows = chat_windows(conversations(spark), **sizes)
    got = {r.conv_id: r for r in read_back(windows).collect()}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    by_conv = lambda r: (r[0] is None, r[0] or 0)
    for conv, turns in groupby(sorted(CONVERSATIONS, key=by_conv), key=lambda r: r[0]):
        turns = [(r or "", t or "") for _, _, r, t in sorted(turns, key=key)]
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        one = got.pop(conv)
        assert one.n_turns == len(turns)
        assert one.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert one.loss_chars == len(loss)
        assert one.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert not got


def test_windows(spark):
    windows = chat_windows(conversations(spark), budget=200, history=80, system=20).collect()
    two = sorted((w for w in windows if w.conv_id == 2), key=lambda w: w.window)
    assert len(two) > 3
    for i, w in enumerate(two):
        assert w.formatted.startswith("<|turn|>system<|text|>be kind <\\|end|><|end|>")
        assert w.formatted.endswith("<|end|>")
        # within the budget but for less than a turn, and repeated turns come first
        assert w.tokens < 200 + 74 and (w.repeated > 0) == (i > 0)
        for s in w.spans:
            assert w.formatted[s.start - 8 : s.start] == "<|text|>"
            assert w.formatted[s.start + s.length :].startswith("<|end|>")
    assert sum(len(w.spans) for w in two) == 4
    no_python(chat_windows(conversations(spark)))
    with pytest.raises(ValueError):
        chat_windows(conversations(spark), budget=100, history=90)


@pytest.mark.parametrize("system_words", [10, 200, 252, 253, 1000])
def test_no_window_exceeds_its_budget_by_a_whole_turn(spark, system_words):
    rng = random.Random(system_words)
    turns = [(1, 0, "system", "s " * system_words, "w", 1)]
    turns += [(1, 1 + i, ("user", "assistant")[i % 2], "t " * rng.randrange(90), "w", 1) for i in range(60)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, window string, tokens int")
    windows = sorted(chat_windows(df).collect(), key=lambda w: w.window)
    retained = system_words <= 252
    for w in windows:
        parts = w.formatted.split("<|turn|>")[1:]
        last = len(parts[-1].split("<|text|>")[1].removesuffix("<|end|>").split()) + 4
        assert w.tokens < 512 + last
        assert parts[0].startswith("system") == (retained or w.window == 0)
    one = read_back(chat_windows(df)).first()
    assert one.n_turns == 61


FREE = """{0} is free software; you can redistribute it and/or
modify it under the terms of the GNU {1} as published by the Free Software
Foundation{2}.

{0} is distributed in the hope that it will be useful,
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
LATER = "; either version {} of the License, or (at your option)\nany later version"


@pytest.mark.parametrize("text, want", [
    (BSD, "BSD-2-Clause"), (BSD + ENDORSE, "BSD-3-Clause"), (BSD + ENDORSE + "\n" + BSD, "BSD-3-Clause,BSD-2-Clause"),
    (FREE.format("This program", "General Public License", LATER.format(2)), "GPL-2.0-or-later"),
    (FREE.format("This program", "General Public License", LATER.format(3)), "GPL-3.0-or-later"),
    (FREE.format("This program", "General Public License version 2", ""), "GPL-2.0-only"),
    (FREE.format("This library", "Lesser General Public License", LATER.format("2.1")), "LGPL-2.1-or-later"),
    (FREE.format("This program", "Lesser General Public License", LATER.format(3)), "LGPL-3.0-or-later"),
    (FREE.format("This program", "Affero General Public License", LATER.format(3)), "AGPL-3.0-or-later"),
    ("// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy", "MPL-2.0"),
    ("Distributed under the Boost Software License, Version 1.0.\n(See", "BSL-1.0"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("# SPDX-License-Identifier: BSD-3-Clause\nimport os", "BSD-3-Clause"),
    ("/* SPDX-License-Identifier: GPL-2.0-only */", "GPL-2.0-only"), ("SPDX-License-Identifier: MIT OR ISC", ""),
])
def test_licences_apart(spark, text, want):
    commented = "\n".join(f" * {line}" for line in text.split("\n"))
    rows = scan_licenses(documents(spark, [(1, text), (2, commented)])).collect()
    assert [r.licenses for r in rows] == [want, want]


def test_licence_sql_states_the_same(spark):
    """Wrapped, commented and hostile texts by the query and by its SQL."""
    rng = random.Random(3)
    known = list(SENTENCES.values())
    texts = [BSD, BSD + ENDORSE, MIT_WRAPPED, "", None, "# SPDX-License-Identifier: MIT\r\nx", "...", "All rights reserved"]
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            words = rng.choice([*known, "some other text", "x", ""]).split(" ")
            parts.append("".join(w + rng.choice([" "] * 6 + ["\n", ": ", "\n * ", ", ", "; ", ". ", "\r\n"]) for w in words))
        texts.append("".join(p + rng.choice(["", ".", "\n", "\n\n", ".\n", "! ", "\r\n\r\n", "\r\n//\r\n"]) for p in parts))
    rows = list(enumerate(texts))
    got = scan_licenses(documents(spark, rows)).collect()
    connection = duckdb.connect()
    connection.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    want = connection.sql(sql.OP6).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
    assert sum(r.matches for r in got) > 40


def test_empty_conversations(spark):
    assert read_back(chat_windows(conversations(spark).where("false"))).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software.""".replace("\n", " ")


def test_licenses(spark):
    apache = (
        "Licensed under the Apache License, Version 2.0 (the \"License\");\n"
        "you may not use this file except in compliance with the License.\n"
    )
    docs = documents(spark, [
        (1, "Some text. Licensed under the Apache License, Version 2.0. More."),
        (2, apache), (3, "Released under the MIT License.\nlicensed under  CC BY-NC 4.0.\nRELEASED UNDER THE MIT LICENSE"),
        (4, "This is not licensed under the apache license version 2 0"), (5, None), (6, ""), (None, "All rights reserved"),
        (7, "you may not use this file except in compliance with the License."), (1, "...\n!"),
        (8, "x " * 100_000 + "\nThis work is licensed under the GNU General Public License, version 3."),
    ])
    got = scan_licenses(docs)
    no_python(got)
    rows = {(r.doc_id, r.n_sentences): (r.licenses, r.matches) for r in got.collect()}
    assert rows == {
        (1, 3): ("Apache-2.0", 1), (2, 2): ("Apache-2.0", 1), (3, 3): ("MIT,CC-BY-NC-4.0", 3),
        (4, 1): ("", 0), (5, 0): ("", 0), (6, 0): ("", 0), (None, 1): ("proprietary", 1),
        (7, 1): ("", 0), (1, 0): ("", 0), (8, 2): ("GPL-3.0-only", 1),
    }
    assert scan_licenses(docs.where("false")).count() == 0


MIT_WRAPPED = """MIT License

Copyright (c) 2020 Somebody

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
BSD_WRAPPED = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
APACHE_WRAPPED = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL_WRAPPED = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "! ", "\t;; "])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_published_texts_as_wrapped(spark, mark, end):
    def commented(text):
        return end.join(f"{mark}{line}".rstrip() for line in text.splitlines())

    def in_one_line(text):
        return " ".join(text.split())

    whole = {
        MIT_WRAPPED: ("<mit-grant><mit-condition><as-is><no-liability>", "MIT", 1),
        BSD_WRAPPED: ("<bsd-redistribution><bsd-source><bsd-binary>", "BSD-2-Clause", 1),
        APACHE_WRAPPED: (
            "<apache-notice-the><apache-compliance><apache-copy><apache-as-is><apache-see>", "Apache-2.0", 1,
        ),
        GPL_WRAPPED: ("<gpl-free><gpl-hope><gpl-details>", "GPL-3.0-or-later", 1),
    }
    docs = documents(spark, [
        *[(i, commented(t)) for i, t in enumerate(whole)], (10, in_one_line(GPL_WRAPPED)),
        (11, GPL_WRAPPED.replace(";", ":").replace("software:", "software;")),
        # a sentence doesn't go on after its end or a blank line
        (12, f"{mark}This is released under{end}{mark.strip()}{end}{mark}the MIT License."),
        (13, "Released. Under the MIT License."), (14, "Released\x01under\x02the MIT License"),
    ])
    found = scan_licenses(docs)
    no_python(found)
    got = {r.doc_id: (r.recognised, r.licenses, r.matches) for r in found.collect()}
    gpl = whole[GPL_WRAPPED]
    assert got == {
        **dict(enumerate(whole.values())), 10: gpl, 11: gpl, 12: ("", "", 0), 13: ("", "", 0),
        14: ("<mit-notice>", "MIT", 1),
    }


def test_long_gaps_are_read_once(spark):
    """Of a text without words but one, no gap is read again from each of its places."""
    docs = documents(spark, [(1, " -\n" * 300_000 + "x"), (2, "-" * 900_000), (3, "x" + " " * 900_000 + ":\ty")])
    assert [r.licenses for r in scan_licenses(docs).collect()] == [""] * 3


def test_licence_rules_are_ordered(spark):
    known = {"a": "one", "b": "two", "c": "three"}
    rules = [("AB", ("a", "b")), ("A", ("a",)), ("C", ("c",))]
    docs = documents(spark, [(1, "One.\nnothing\nTwo.\nOne! Three"), (2, "two\none")])
    got = {r.doc_id: (r.recognised, r.licenses, r.matches) for r in scan_licenses(docs, known=known, rules=rules).collect()}
    assert got == {1: ("<a><b><a><c>", "AB,A,C", 3), 2: ("<b><a>", "A", 1)}
    with pytest.raises(ValueError):
        scan_licenses(docs, known=known, rules=[("X", ("z",))])
    with pytest.raises(ValueError):
        scan_licenses(docs, known={"a<": "one"}, rules=[])


def pages(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, RULE string"
    )


def test_rules(spark):
    urls = {
        "http://a.example.com/en/1": ("block", "example.com/en/"),
        "https://WWW.example.com/en/1?x": ("allow", "www.example.com/en/"),
        "https://x.www.example.com/en/": ("allow", "www.example.com/en/"),
        "http://notexample.com/en/": ("allow", "com/"),
        "http://a.net/es/#x": ("block", "net/es/"),
        "http://a.net/ES/": ("allow", None),
        "http://b.com": ("allow", None),
        "http://b.com?/en/": ("allow", None),
        "mailto:me": ("allow", None),
        "x://y://example.com/en/": ("allow", None),
        "http://ÀB.Com/\n/en/": ("allow", "com/"),
    }
    rows = [(i, u, None) for i, u in enumerate(urls)] + [(50, None, None), (None, "", "<a href=//b.org>")]
    got = judged_urls(pages(spark, rows), threshold=2.0)
    no_python(got)
    found = {r.page_id: r for r in got.collect()}
    assert len(found) == len(rows)
    for i, (url, want) in enumerate(urls.items()):
        assert (found[i].verdict, found[i].rule) == want, url
    assert (found[50].host, found[50].path, found[50].verdict) == ("", "", "allow")
    assert found[10].host == "Àb.com" and found[10].path == "/\n/en/"
    assert judged_urls(pages(spark, rows).where("false")).count() == 0
    assert RULES[1].text == "example.com/en/"


def test_links(spark):
    html = """<A class=x HREF='http://B.org/x'>1</A><a href="//c.org?y">2</a><a href=/own>3</a>
    <a href=https://a.org/>self</a><a name=x>4</a><link href="http://no.org/"><a href=//b.org>5</a>"""
    got = host_links(pages(spark, [(1, "http://a.org/", html), (2, None, html), (3, "http://a.org/", None)]))
    assert sorted(map(tuple, got.collect())) == [("a.org", "b.org", 2), ("a.org", "c.org", 1)]


def test_propagation(spark):
    """good links to near; farm links to bad, and hub to farm; lone is linked with nobody."""
    link = lambda *hosts: "".join(f'<a href="http://{h}/">x</a>' for h in hosts)
    rows = [
        (1, "http://good.org/", link("near.org")), (2, "http://bad.org/", None),
        (3, "http://farm.org/", link("bad.org")), (4, "http://hub.org/", link("farm.org", "farm.org", "near.org")),
        (5, "http://near.org/", link("good.org", "bad.org")), (6, "http://lone.org/", ""),
    ]
    rules = [Rule("allow", "good.org"), Rule("block", "bad.org")]
    got = {r.host: r for r in judged_urls(pages(spark, rows), rules, rounds=200).collect()}
    links = {("good", "near"): 1, ("farm", "bad"): 1, ("hub", "farm"): 2, ("hub", "near"): 1,
             ("near", "good"): 1, ("near", "bad"): 1}
    hosts = ["good", "bad", "farm", "hub", "near", "lone"]
    trust, distrust = dict.fromkeys(hosts, 0.0), dict.fromkeys(hosts, 0.0)
    for _ in range(300):
        out = {h: sum(n for (a, _), n in links.items() if a == h) for h in hosts}
        into = {h: sum(n for (_, b), n in links.items() if b == h) for h in hosts}
        trust = {h: 0.15 * (h == "good") + 0.85 * sum(trust[a] * n / out[a] for (a, b), n in links.items() if b == h) for h in hosts}
        distrust = {h: 0.15 * (h == "bad") + 0.85 * sum(distrust[b] * n / into[b] for (a, b), n in links.items() if a == h) for h in hosts}
    for h in hosts:
        assert got[f"{h}.org"].trust == pytest.approx(trust[h], abs=1e-7)
        assert got[f"{h}.org"].distrust == pytest.approx(distrust[h], abs=1e-7)
    assert {h for h in hosts if got[f"{h}.org"].verdict == "block"} == {"bad", "farm", "hub"}


def test_propagation_on_a_large_graph(spark):
    """Five hundred hosts, hubs and hosts without links among them, against the fixed point."""
    rng = random.Random(5)
    n = 500
    counts = {}
    for a in range(n):
        if a % 7 == 3:
            continue
        for _ in range(60 if a % 50 == 0 else rng.randrange(1, 6)):
            b = rng.choice([rng.randrange(n), 10 * rng.randrange(n // 10)])
            if a != b:
                counts[a, b] = counts.get((a, b), 0) + 1
    pages_of = {a: [] for a in range(n)}
    for (a, b), k in counts.items():
        pages_of[a] += [f'<a href="//h{b}.org/{i}">x</a>' for i in range(k)]
    # a page or two for each host; some hosts are only linked to
    rows = [(2 * a, f"http://h{a}.org/{'bad' if a % 9 == 0 else ''}", "".join(x)) for a, x in pages_of.items() if a % 11 or x]
    rows += [(2 * a + 1, f"http://h{a}.org/bad", None) for a in range(0, n, 18) if a % 11 or pages_of[a]]
    good = {a for a in range(1, n, 13)}
    rules = [Rule("allow", f"h{a}.org") for a in sorted(good)] + [Rule("block", "org", "/bad")]
    got = {r.host: r for r in judged_urls(pages(spark, rows), rules).collect()}

    flow = np.zeros((n, n))
    for (a, b), k in counts.items():
        flow[a, b] = k
    onward = flow / np.maximum(flow.sum(1, keepdims=True), 1)
    back = flow / np.maximum(flow.sum(0, keepdims=True), 1)
    seeds = np.zeros((2, n))
    for a in range(n):
        own = [u for _, u, _ in rows if u.startswith(f"http://h{a}.org/")]
        longer = a in good and len(f"h{a}.org/") > len("org/bad")
        allowed = [a in good and (longer or not u.endswith("bad")) for u in own]
        blocked = [u.endswith("bad") and not longer for u in own]
        if own:
            seeds[:, a] = np.mean(allowed), np.mean(blocked)
    trust = np.linalg.solve(np.eye(n) - 0.85 * onward.T, 0.15 * seeds[0])
    distrust = np.linalg.solve(np.eye(n) - 0.85 * back, 0.15 * seeds[1])
    hosts = {int(h[1:-4]): r for h, r in got.items()}
    assert len(hosts) > 400 and seeds[0].any() and seeds[1].any()
    for a, r in hosts.items():
        assert r.trust == pytest.approx(trust[a], abs=1e-7)
        assert r.distrust == pytest.approx(distrust[a], abs=1e-7)
        wanted = distrust[a] >= 0.05 and distrust[a] > trust[a]
        assert abs(distrust[a] - 0.05) < 1e-6 or r.rule or (r.verdict == "block") == wanted


def test_links_of_a_page_of_nothing_but_open_tags(spark):
    rows = [(1, "http://a.org/", "<a " * 350_000), (2, "http://a.org/", "<a href=//b.org>")]
    start = time.perf_counter()
    assert [tuple(r) for r in host_links(pages(spark, rows)).collect()] == [("a.org", "b.org", 1)]
    assert time.perf_counter() - start < 20
