from tessera.llm import licenses as Lc

SCHEMA = "doc_id long, text string"
SENTENCES = [  # written without a look at the templates
    ("All rights reserved.", "All rights reserved"), ("ALL RIGHTS RESERVED", "All rights reserved"),
    ("Licensed under the MIT License.", "MIT"), ("* Licensed under the MIT license */", "MIT"),
    ("This project is licensed under the MIT License", "MIT"), ("Distributed under the MIT license.", "MIT"),
    ("Licensed under the Apache License 2.0", "Apache-2.0"), ("Released under the Apache License, version 2.0", "Apache-2.0"),
    ("Licensed under the BSD 3-clause license", "BSD-3-Clause"), ("Licensed under the BSD 2-Clause license.", "BSD-2-Clause"),
    ("Released under the GNU General Public License version 3", "GPL-3.0"), ("licensed under the GNU GPL v3", "GPL-3.0"),
    ("Released under the GNU Lesser General Public License version 3.", "LGPL-3.0"),
    ("Licensed under the Mozilla Public License, v. 2.0", "MPL-2.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
]


def test_customary_lines_are_found(spark):
    rows = [(i, f"some words before\n{x}\nand after it") for i, (x, _) in enumerate(SENTENCES)]
    rows += [(900, "he reserved all the rights to speak"), (901, "under the stars she was released")]
    found = {}
    for r in Lc.scan(spark.createDataFrame(rows, SCHEMA)).collect():
        found.setdefault(r.doc_id, set()).add(r.license)
    for i, (x, name) in enumerate(SENTENCES):
        assert any(f.startswith(name) for f in found.get(i, ())), x
    assert not {900, 901} & set(found)


PROSE = "\n\n".join(" ".join(f"p{i}w{(k * k) % 37}" for k in range(60)) for i in range(40))


def _mit():
    body = Lc.TEMPLATES["MIT"]
    a, b = body.index("The above copyright"), body.index("THE SOFTWARE IS")
    return [body[:a], body[a:b], body[b:]]


def test_licences_of_several_paragraphs_in_longer_texts(spark):
    text = lambda name: (Lc.Path(Lc.__file__).parent / "license_texts" / f"{name}.txt").read_text()
    three = "\n\n".join(x.strip() for x in _mit())
    bsd = Lc.TEMPLATES["BSD-3-Clause"].replace(" 2. Redis", "\n\n2. Redis").replace(" 3. Neither", "\n\n3. Neither").replace("THIS SOFTWARE", "\n\nTHIS SOFTWARE")
    long = PROSE.replace("\n\n", "\n")
    rows = [(1, f"{PROSE}\n\n{three}\n\n{PROSE}"), (2, f"{PROSE}\n\n{bsd}\n\n{PROSE}"),
            (3, f"{long}\n{three.replace(chr(10) * 2, chr(10))}\n{long}"), (4, f"{PROSE}\n\n{three}\n\n{PROSE}\n\n{three}\n\n{PROSE}"),
            (5, "\n\n".join([PROSE] * 3 + [text("Apache-2.0")] + [PROSE.replace("p", "q").replace("w", "x")] * 3)), (6, PROSE),
            (7, text("GPL-3.0")), (8, f"{PROSE}\n\n{three}\n\n{PROSE}\n\n{' '.join(_mit()[:2])}{_mit()[2]}")]
    got = {}
    for r in Lc.scan(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.doc_id, []).append((r.license, r.unit, r.place, r.dice))
    first = rows[0][1].split("\n").index(three.split("\n")[0])
    assert got[1] == [("MIT", "lines", first, 1.0)]
    assert max(got[2], key=lambda x: x[3])[0] == "BSD-3-Clause"
    assert [x[:2] for x in got[3]] == [("MIT", "lines")] and got[3][0][3] == 1.0
    assert [x[:2] + x[3:] for x in got[4]] == [("MIT", "lines", 1.0)] * 2
    assert any(x[0] == "Apache-2.0" and x[3] > 0.99 for x in got[5])
    assert 6 not in got and any(x[0] == "GPL-3.0" and x[1] == "text" for x in got[7])
    assert sorted(x[:2] + x[3:] for x in got[8]) == [("MIT", "lines", 1.0), ("MIT", "paragraph", 1.0)]


def test_long_texts_take_time_in_proportion(spark):
    """Eight times the text around a licence in three paragraphs, well within
    ten times the time (before, the time grew with the square)."""
    import time
    three = "\n\n".join(x.strip() for x in _mit())

    def took(n):
        half = "\n".join(" ".join(f"the w{(k * 7 + r) % 997} of" for k in range(15)) for r in range(n // 90))
        docs = spark.createDataFrame([(1, f"{half}\n\n{three}\n\n{half}")], SCHEMA)
        began = time.perf_counter()
        got = [(r.license, r.unit, r.place, r.dice) for r in Lc.scan(docs).collect()]
        assert got == [("MIT", "lines", n // 90 + 1, 1.0)]
        return time.perf_counter() - began
    took(20_000)
    assert took(160_000) < 10 * took(20_000)
