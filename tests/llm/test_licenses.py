import random
import re

from propweave.llm import licenses


def test_wording():
    name = lambda t: [x[0] for x in licenses.findings(t)]
    assert name("abc\nLicensed under the Apache License, Version 2.0.\nmore") == ["Apache-2.0"]
    assert name("Licensed under the Apache License, Version 1.1.") == []
    assert name("x " * 4000 + "Released under the MIT License. " + "y " * 4000) == ["MIT"]
    assert name("This work is licensed under the GNU General Public License, version 3.") == ["GPL-3.0"]
    assert name("This work is licensed under the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert name("Licensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0"]
    assert name("he lost his driving license at the public fair") == [] and name("") == [] and name(None) == []
    for licence, text, _ in licenses.TEMPLATES:
        assert name(f"foo bar\n{text}\nbaz") == [licence], text


def test_query_against_plain_search(spark):
    d = "/root/testdata/sf0.01"
    known = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    want = {(r.doc_id, v) for r in spark.read.parquet(f"{d}/documents.parquet").collect() for k, v in known.items() if k in r.text}
    got = {(r.doc_id, r.licence) for r in licenses.op10_licenses(spark, d).collect()}
    assert want and got == want  # the table holds no other notices


def test_edges(spark):
    t = "Released under the MIT License."
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, t, "c"), (3, t, "c"), (None, t, None)], "doc_id long, text string, licence string")
    assert sorted((r.doc_id or 0, r.licence) for r in licenses.scan(df).collect()) == [(0, "MIT"), (3, "MIT"), (3, "MIT")]
    assert licenses.scan(df.limit(0)).count() == 0


def test_notices_within_real_prose(spark):
    """Each notice in the middle of one long line, whatever the line's length, and with a word changed at its end."""
    r = random.Random(2)
    prose = [x.text.replace("\n", " ") for x in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect() if x.text and not re.search(licenses.TRIGGER, x.text)]
    prose = [x for x in prose if len(x) > 3000]
    for licence, text, must in licenses.TEMPLATES:
        for size in (200, 500, 1450, 3000):
            for _ in range(5):
                x = r.choice(prose)[:size].split(" ")
                at = len(x) // 2
                assert licence in [f[0] for f in licenses.findings(" ".join([*x[:at], text, *x[at:]]))], (text, size)
        assert licences_of(" ".join(x)) == []
    long = next(text for name, text, _ in licenses.TEMPLATES if name == "MPL-2.0").replace("terms of", "conditions of")
    assert licences_of(f"{r.choice(prose)[:700]} {long} {r.choice(prose)[:700]}") == ["MPL-2.0"]


def licences_of(text):
    return [f[0] for f in licenses.findings(text)]


def test_near_licences_and_denials():
    assert licences_of("This work is licensed under the GNU Affero General Public License, version 3.") == ["AGPL-3.0"]
    assert licences_of("This work is licensed under the GNU Lesser General Public License, version 2.") == []
    assert licences_of("Licensed under the GNU Lesser General Public License, version 2.1.") == ["LGPL-2.1"]
    assert licences_of("This file is not licensed under the MIT License.") == []
    assert licences_of("It was never released under the MIT License.") == []
    assert licences_of("Do not panic. Released under the MIT License.") == ["MIT"]
    assert licences_of("Distributed under the terms of the Mozilla Public License version 2.0") == ["MPL-2.0"]
    assert licences_of("Licensed under CC BY-SA 4.0.") == ["CC-BY-SA-4.0"]
    assert licences_of("Released under the MIT License.\nLicensed under the Apache License, Version 2.0.") == ["Apache-2.0", "MIT"]
    assert licences_of("the license plate of the car was lost; general public 3 gnu") == []


def test_brute_force_on_prose():
    """Each licence's sentences among words: found where the plain words stand in a row, and nowhere else."""
    r = random.Random(7)
    vocabulary = [f"w{k}" for k in range(50)] + ["license", "version", "the", "under", "public"]
    for _ in range(150):
        licence, text, _ = r.choice(licenses.TEMPLATES)
        filler = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
        with_it, without = f"{filler(30)}\n{text}\n{filler(30)}", f"{filler(30)}\n{filler(60)} license"
        assert licences_of(with_it) == [licence] and licences_of(without) == []


def test_ties_and_very_long_lines():
    t = "Released under the MIT License."
    line = "x y " * 200_000
    found = licenses.findings(f"{line}{t} {line}\n{t}")
    assert [f[0] for f in found] == ["MIT"] and licenses.findings(f"{t}\n\n\n\n{t}")[0][1] == 0
