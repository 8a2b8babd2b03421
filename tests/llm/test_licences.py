import random
import re
from collections import Counter
from math import log, sqrt

import pytest

from tallyscope.llm import licences


def tree(spark):
    rng = random.Random(8)
    words = "the of in is this work under a version use file terms source code and by x y z q".split()
    prose = lambda n: "\n".join(" ".join(rng.choice(words) for _ in range(12)) for _ in range(n))
    given = list(licences.TEMPLATES.values())
    rows = [
        ("LICENSE", given[5]),
        ("a/readme.txt", prose(4)),
        ("a/b/c/d.txt", prose(30)),
        ("a/b/COPYING.md", f"{prose(2)}\n{given[4].upper()}\n{prose(2)}"),
        ("a/b/notice-2", given[0]),
        ("a/b/own.py", f"# {given[3]}\n{prose(3)}"),
        ("z/License/file.txt", prose(2)),
        ("z/LICENSE", prose(5)),
        ("z/y/LICENCE", given[1] + " " + given[1]),
        ("z/y/x/w/v.txt", "under the terms of the"),
        ("abroad/LICENSE-1", given[2]),
        ("abroad/n.txt", None),
        ("ab/n.txt", ""),
        (None, prose(1)),
        ("a/b/c/d.txt", prose(1)),
        ("big", "filler " * 200_000),
    ]
    rows += [(f"many/f{i}.txt", rng.choice([prose(3), prose(3) + "\n" + rng.choice(given)])) for i in range(150)]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "path string, text string, dir string, score int")


def by_hand(rows, least=0.8):
    split = lambda t: re.findall("[a-z0-9]+", t.lower())
    vocabulary = {t for x in licences.TEMPLATES.values() for t in split(x)}
    df = Counter(t for r in rows for t in set(split(r["text"] or "")) & vocabulary)
    idf = {t: log((1 + len(rows)) / (1 + df[t])) + 1 for t in vocabulary}

    def unit(text):
        v = {t: n * idf[t] for t, n in Counter(split(text)).items() if t in idf}
        norm = sqrt(sum(w * w for w in v.values()))
        return {t: w / norm for t, w in v.items()} if norm else {}

    known = {n: unit(t) for n, t in licences.TEMPLATES.items()}
    own = {}
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            v = unit(line)
            for name, t in known.items():
                s = round(sum(w * t.get(k, 0) for k, w in v.items()), 9)
                if s >= least:
                    own[r["path"] or ""] = min(own.get(r["path"] or "", (0, "~")), (-s, name))
    speaks = {}
    for path, (s, name) in own.items():
        d, _, leaf = path.rpartition("/")
        if re.match(r"(?i)(licen[cs]e|copying|notice)", leaf):
            speaks[d] = min(speaks.get(d, (0, "~", "")), (s, path, name))
    out = {}
    for r in rows:
        path = r["path"] or ""
        if path in own:
            out[path] = (own[path][1], pytest.approx(-own[path][0], abs=2e-9), "header")
            continue
        d, out[path] = path.rpartition("/")[0], (None, None, None)
        while True:
            if d in speaks:
                out[path] = (speaks[d][2], None, d)
                break
            if not d:
                break
            d = d.rpartition("/")[0]
    return out


def test_headers_and_inheritance(spark):
    table = tree(spark)
    want = by_hand(table.collect())
    got = licences.scan(table).collect()
    assert len(got) == table.count()
    for r in got:
        assert (r["licence"], r["score"], r["origin"]) == want[r["path"]]
    found = {r["path"]: r["origin"] for r in got}
    assert found["a/b/c/d.txt"] == "a/b" and found["a/readme.txt"] == "" and found["z/y/x/w/v.txt"] == "z/y" and found["a/b/own.py"] == "header"


def test_telling_terms_miss_no_match(spark):
    rows = tree(spark).collect()
    idf, unit = licences.weigh(licences.TEMPLATES, {"the": 140, "of": 100, "license": 50}, len(rows))
    keys = set(licences.telling(unit, 0.8))
    for vector in unit.values():
        light = [w for t, w in vector.items() if t not in keys]
        assert sqrt(sum(w * w for w in light)) < 0.8


def test_no_files(spark):
    assert licences.scan(tree(spark).limit(0)).count() == 0


def test_wrapped_notices_and_whole_licences(spark):
    given, texts = licences.TEMPLATES, licences.full_texts()
    half = lambda t, k: "\n# ".join([" ".join(t.split()[:k]), " ".join(t.split()[k:])])
    rows = [(f"w/{n}.py", f"# Some words of the work\n# {half(t, len(t.split()) // 2)}\nand code\n") for n, t in given.items()]
    rows += [(f"l/{n}.py", f"{'lorem version license of the work ' * 30}{t} {'ipsum code terms ' * 30}") for n, t in given.items()]
    rows += [("mine/COPYING", "Copyright (c) 2020 Someone\n\n" + " ".join(texts["GPL-2.0"].split())), ("mine/sub/x.py", "x = 1")]
    rows += [("theirs/LICENSE", "The MIT License (MIT)\n\nCopyright (c) 2020 Someone\n\n" + texts["MIT"]), ("theirs/y.py", None)]
    rows += [("no/LICENSE", "All rights reserved."), ("no/y.py", "the software is provided as is")]
    rows += [(f"filler/{k}.txt", "nothing to see") for k in range(60)]
    got = {r["path"]: r for r in licences.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    for n in given:
        assert (got[f"w/{n}.py"]["licence"], got[f"w/{n}.py"]["score"]) == (n, pytest.approx(1.0)), n
        assert (got[f"l/{n}.py"]["licence"], got[f"l/{n}.py"]["score"]) == (n, pytest.approx(1.0)), n
    assert got["mine/COPYING"]["licence"] == "GPL-2.0" and (got["mine/sub/x.py"]["licence"], got["mine/sub/x.py"]["origin"]) == ("GPL-2.0", "mine")
    assert (got["theirs/y.py"]["licence"], got["theirs/y.py"]["origin"]) == ("MIT", "theirs")
    assert got["no/LICENSE"]["licence"] is None and got["no/y.py"]["licence"] is None


def test_query_with_odd_numbers(spark, tmp_path):
    """Rows without doc_id, with negative and with repeated ones keep them."""
    from tallyscope.llm.queries import QUERIES

    notice = next(iter(licences.TEMPLATES.values()))
    rows = [(None, "no key", "en", "web"), (None, notice, None, None), (-7, notice, "en", "web"), (-10, "x", None, "a b"), (5, "a", "en", "web"), (5, notice, "en", "web")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op2_licence_scan"](spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    assert all(r["licence"] for r in got if r["doc_id"] in (-7, 5))
