"""Licence scan: notices against plain word matching, expressions against Python's own evaluation."""

import itertools
import random
import re
import warnings

import pytest

from starmart.llm import licences
from starmart.llm.licences import BASE, evaluate, grade, scan, tokens, valid_part

SCHEMA = "doc_id long, text string, labels int, score string, id string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    """The base columns by comparing word lists at every place."""
    words = WORD.findall((text or "").translate(LOWER))
    places = [(i, label) for phrase, label in BASE.items() for p in [phrase.split()]
              for i in range(len(words)) if words[i:i + len(p)] == p]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


def texts_of():
    rng = random.Random(12)
    pool = ["cc", "by", "CC-BY", "general", "public", "License", "all", "rights", "reserved", "GNU", "lesser", "nc",
            "4.0", "v3", "version 2", "é", "ccé", "x1", "\n", ".", "SPDX-License-Identifier: MIT\n", "ſ", "MIT license"]
    texts = [rng.choice([" ", "-", "\n", "  "]).join(rng.choice(pool) for _ in range(rng.randint(0, 40)))
             for _ in range(400)]
    return texts + ["", None, "cc by" * 3, "cc by " * 50_000, "All Rights Reserved", "\x00", "cc\x00by",
                    "all rights reserved all rights reserved", "license: (" + "mit or " * 40_000]


def test_base_columns_match_a_plain_version():
    for t in texts_of():
        r = scan((t or "").encode())
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(t)
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def python_value(toks):
    """The grade by Python's own operators: ``*`` binds closer than ``+``."""
    class V:
        def __init__(self, g): self.g = g
        def __mul__(self, o): return V(max(self.g, o.g))
        def __add__(self, o): return V(min(self.g, o.g))
        def __matmul__(self, o): raise AssertionError
    names, out = {}, []
    for i, t in enumerate(toks):
        if t in ("and", "or", "(", ")"):
            out.append({"and": "*", "or": "+"}.get(t, t))
        elif t == "with" or i and toks[i - 1] == "with":
            continue
        else:
            g = grade(t)
            if i + 1 < len(toks) and toks[i + 1] == "with" and g < licences.UNKNOWN:
                g = min(g, licences.WEAK)
            names[f"n{i}"] = V(g)
            out.append(f"n{i}")
    return eval(" ".join(out), names).g


def random_expression(rng, depth=0):
    if depth > 3 or rng.random() < 0.4:
        one = rng.choice(["mit", "gpl-3.0-only", "apache-2.0", "mpl-2.0", "licenseref-x", "cc0-1.0", "cc-by-nc-4.0"])
        return [one] + (["with", "classpath-exception-2.0"] if rng.random() < 0.2 else [])
    inner = random_expression(rng, depth + 1) + [rng.choice(["and", "or"])] + random_expression(rng, depth + 1)
    return ["(", *inner, ")"] if rng.random() < 0.4 else inner


def test_shunting_yard_against_python_operators():
    rng = random.Random(5)
    for _ in range(500):
        toks = random_expression(rng)
        assert valid_part(toks) == toks
        ids, g = evaluate(toks)
        assert g == python_value(toks)
        assert sum(len(i.split(" with ")) for i in ids) == sum(t not in ("and", "or", "with", "(", ")") for t in toks)


def test_longest_valid_part_is_the_longest_of_all_prefixes():
    def valid(toks):
        text = " ".join({"and": "+", "or": "+", "with": "@"}.get(t, t if t in "()" else "a") for t in toks)
        if re.search(r"\) @|a @ a @|@ \(", text):
            return False
        try:
            with warnings.catch_warnings(action="ignore"):
                compile(text, "x", "eval")
        except SyntaxError:
            return False
        return bool(toks) and not re.search(r"a \(|\) \(|\( \)|\) a|[+@] [+]|^[+]|\( [+]", text)
    for n in range(1, 7):
        for toks in itertools.product(["mit", "and", "with", "(", ")"], repeat=n):
            toks = list(toks)
            want = max((k for k in range(n + 1) if valid(toks[:k])), default=0)
            assert valid_part(toks) == toks[:want], toks


@pytest.mark.parametrize("line, ids, score", [
    ("SPDX-License-Identifier: MIT OR GPL-2.0-or-later", "gpl-2.0-or-later,mit", 0.25),
    ("SPDX-License-Identifier: MIT AND GPL-2.0-or-later", "gpl-2.0-or-later,mit", 0.75),
    ("// SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note */", "gpl-2.0 with linux-syscall-note", 0.5),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND LicenseRef-house", "apache-2.0,licenseref-house,mit", 0.9),
    ("SPDX-License-Identifier: MIT OR\nGPL-2.0", "mit", 0.25),
    ("license: perhaps MIT", "", 0.0),
    ("\"license\": \"BSD-3-Clause\",", "bsd-3-clause", 0.25),
    ("SPDX-License-Identifier: ", "", 0.0),
    ("Licensed under the GNU Lesser General Public License, version 2.1.", "gpl,lgpl-2.1", 0.5),
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0", 0.9),
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0", 0.25),
    ("Released under the MIT License.", "mit", 0.25),
    ("Alle Rechte vorbehalten", "reserved", 1.0)])
def test_labels_and_score(line, ids, score):
    r = scan(line.encode())
    assert (r["labels"], r["score"]) == (ids, score)
    assert scan(("x " * 50 + "\n" + line).encode())["labels"] == ids


def test_dataframe(spark):
    texts = texts_of()
    rows = [(i, t, 1, None, "x") for i, t in enumerate(texts)] + [(None, "cc by", None, None, None)] * 2
    got = licences.scan_licences(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:6] == brute("cc by" if r.doc_id is None else texts[r.doc_id])
    assert licences.scan_licences(spark.createDataFrame([], SCHEMA)).count() == 0
    assert tokens("mit.") == ["mit"]
