import random

import numpy as np

from tessera.llm import licenses
from tessera.llm.license_texts import license_of
from tests.llm.cases import documents


def test_whole_changed_and_missing_notices(spark):
    apache = licenses.TEMPLATES["Apache-2.0"]
    changed = apache.replace("you may not use", "you can not ever use").replace("a copy of", "one copy of")
    rows = [None, "", "Größer. Released under the MIT License. End", "see " + apache, changed, "the license is under discussion", "Licensed under CC BY-NC 4.0. " * 2000, "LICENSED UNDER CC BY-NC 4.0"]
    docs = documents(spark, rows)
    got = {}
    for r in licenses.license_spans(docs).distinct().collect():
        got.setdefault(r.doc_id, []).append((r.license, r.coverage, rows[r.doc_id][r.start : r.end]))
    assert got[2] == [("MIT", 1.0, "Released under the MIT License")]
    assert got[3][0][0] == "Apache-2.0" and got[3][0][1] == 1.0
    assert got[4][0][0] == "Apache-2.0" and 0.8 <= got[4][0][1] < 1.0
    assert len(got[6]) == 2000 and got[7][0][0] == "CC-BY-NC-4.0"
    assert set(got) == {2, 3, 4, 6, 7}
    assert licenses.license_spans(docs.limit(0)).count() == 0


def test_alignment_is_the_longest_common_subsequence():
    rng = np.random.default_rng(1)

    def lcs(a, b):
        best = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
        return best[-1, -1]

    for _ in range(50):
        template = rng.integers(0, 50, 12)
        text = np.concatenate((template[:5], rng.integers(50, 60, rng.integers(0, 3)), template[5 + rng.integers(0, 3) :]))
        score, first, last = licenses.align(text, template, 0)
        assert score == lcs(template, text)
        assert 0 <= first < last <= len(text)


def test_every_whole_template_is_found(spark):
    rows = [f"before {t} after" for t in licenses.TEMPLATES.values()]
    got = {(r.doc_id, r.template, r.license) for r in licenses.license_spans(documents(spark, rows)).collect()}
    assert {(k, n, license_of(n)) for k, n in enumerate(licenses.TEMPLATES)} <= got


def names_in(spark, rows):
    got = {}
    for r in licenses.license_spans(documents(spark, rows)).distinct().collect():
        got.setdefault(r.doc_id, []).append((r.start, r.license))
    return [[n for _, n in sorted(got.get(k, []))] for k in range(len(rows))]


def test_copies_side_by_side_are_all_found(spark):
    notice, changed = licenses.TEMPLATES["MIT-notice"], "Issued under the MIT License."
    rows = [f"{notice} " * n for n in (2, 3, 6, 50)] + [f"{changed} " * 6, f"{changed} {notice} {changed} {changed} {notice}", f"Released under the MIT MIT License. {notice}"]
    assert [len(x) for x in names_in(spark, rows)] == [2, 3, 6, 50, 6, 5, 2]


def test_kinds_and_versions_are_told_apart(spark):
    t = licenses.TEMPLATES
    rows = {
        t["GPL-3.0"].replace("version 3", "version 2"): "GPL-2.0",
        t["GPL-3.0"].replace("General", "Lesser General").replace("This program", "This library"): "LGPL-3.0",
        t["GPL-3.0"].replace("General", "Affero General"): "AGPL-3.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution 3.0 Unported License.": "CC-BY-3.0",
        "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
        "Released under the ISC License.": "ISC",
        t["BSD-2-Clause-text"]: "BSD-2-Clause",
        t["BSD-3-Clause-text"].replace("copyright holder nor", "Example Project nor"): "BSD-3-Clause",
        "SPDX-License-Identifier: LGPL-2.1": "LGPL-2.1",
    }
    rows |= {
        "This file may be copied under the terms of the GNU General Public License version 2 as published by the Free Software Foundation": "GPL-2.0",
        t["GPL-2.0-only-notice"].replace("version 2", "version 3"): "GPL-3.0",
        "It is distributed under the BSD license, see the file": "BSD",
        "distributed under the BSD 2-Clause license": "BSD-2-Clause",
        "released under the BSD 5-Clause License": "BSD",  # of the family, whichever it is
        "Licensed under the GPLv3, as is": "GPL-3.0",
        "released under the GNU LGPL v2.1": "LGPL-2.1",
        "Distributed under the MIT License.": "MIT",
        "distributed under the terms of the Apache License, version 2.0": "Apache-2.0",
    }
    assert names_in(spark, list(rows)) == [[n] for n in rows.values()]
    unknown = ["Released under the Foo License.", "This work is licensed under the GNU General Public License, version 9.", "Licensed under CC XY-NC 4.0.", t["GPL-3.0"].replace("version 3", "version 7"), "Licensed under the GPLv7.", t["GPL-2.0-only-notice"].replace("version 2", "version 8")]
    assert names_in(spark, unknown) == [[]] * len(unknown)


def test_planted_notices_match_brute_force(spark):
    """Whole, changed and broken copies between other words or side by side: every span where it was put."""
    rng = random.Random(5)
    names = ["MIT-notice", "Apache-2.0-notice", "CC-BY-NC-4.0", "GPL-3.0-notice", "MPL-2.0", "MIT"]
    rows, want = [], []
    for _ in range(60):
        text, spans = "", []
        for _ in range(rng.randint(1, 6)):
            for _ in range(rng.choice((0, 0, 1, 5))):
                text += f"w{rng.randrange(99)} "
            name = rng.choice(names)
            w = licenses.TEMPLATES[name].rstrip(".").split()
            if len(w) > 12 and rng.random() < 0.5:
                for k in rng.sample(range(2, len(w) - 2), len(w) // 12):
                    w[k] = w[k] if any(c.isdigit() or c == "/" for c in w[k]) or w[k] in ("Mozilla", "Public") else "zzz"
            copy = " ".join(w)
            spans.append((name, len(text), len(text) + len(copy.rstrip("/"))))
            text += copy + ". "
        rows.append(text)
        want.append(spans)
    got = [[] for _ in rows]
    for r in licenses.license_spans(documents(spark, rows)).distinct().collect():
        got[r.doc_id].append((r.template, r.start, r.end))
    assert [sorted(g, key=lambda m: m[1]) for g in got] == want


def test_templates_of_a_table(spark):
    body = " ".join(f"clause{k}" for k in range(3000))
    table = spark.createDataFrame([("X-1.0", body), ("X-1.0", body + " z"), (None, "a b c d"), ("Y", None)], "name string, text string")
    held = licenses.templates_from(table)
    assert held == {"X-1.0": body}
    rows = licenses.license_spans(documents(spark, ["q " + body, "q"]), templates=held).collect()
    assert [(r.license, r.coverage, r.start) for r in rows] == [("X-1.0", 1.0, 2)]
