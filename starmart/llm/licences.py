"""Licence scan: Aho-Corasick finds identifier tags and notice phrases, a shunting-yard parser
evaluates the licence expressions behind the tags.

Notices are phrases of words: a text is folded (A-Z), cut in words (runs of ASCII letters, digits and
anything beyond ASCII) and joined by single blanks; one automaton over all phrases then finds every place
of every phrase in one pass, whatever their number.  A version number that follows is part of the
label (``gpl-3``, ``cc-by-nc-4.0``).

Tags (``SPDX-License-Identifier:`` and the like) are found by a second automaton in the folded raw text.
What follows on the tag's line is read as an expression of licence ids, ``and``, ``or``, ``with`` and
parentheses; ``with`` binds closest, then ``and``, then ``or``.  The longest part that is a valid
expression counts; behind the looser tags (``license:``) it must hold known licences only.

Every licence has a grade, how much it restricts use (0 nothing, 1 everything): of alternatives (``or``)
the user may take the least strict, of joint terms (``and``) the strictest holds, and an exception (``with``)
softens a copyleft licence to a weak one.  A document's score is the strictest of its notices and
evaluated expressions, 0 without any.

Per document, no shuffle; whole texts.  Defined results: a null or empty text has no words, no label (empty
text) and score 0; an unfinished or ill-formed expression counts up to its longest valid part, an empty one
not at all; equal labels are given once; repeated rows are scanned alike; an empty table gives an empty
result; columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, quoted

# fixed values: the base phrases and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: notice phrases of this scan and their labels
NOTICES = {
    "mit license": "mit", "permission is hereby granted free of charge": "mit",
    "apache license": "apache", "apache software license": "apache",
    "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc", "boost software license": "bsl", "zlib license": "zlib",
    "the unlicense": "unlicense", "public domain": "public-domain", "cc0": "cc0",
    "domaine public": "public-domain", "dominio público": "public-domain", "gemeinfrei": "public-domain",
    "mozilla public license": "mpl", "eclipse public license": "epl",
    "common development and distribution license": "cddl",
    "gnu general public license": "gpl", "licence publique générale": "gpl",
    "licencia pública general": "gpl",
    "lesser general public license": "lgpl", "library general public license": "lgpl",
    "affero general public license": "agpl", "european union public licence": "eupl",
    "free documentation license": "gfdl",
    "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "creative commons attribution noderivatives": "cc-by-nd",
    "proprietary and confidential": "proprietary",
    "alle rechte vorbehalten": "reserved", "tous droits réservés": "reserved",
    "todos los derechos reservados": "reserved",
}

#: how much a licence family restricts the use of a text
GRADES = {
    "public-domain": 0.1, "cc0": 0.1, "unlicense": 0.1, "0bsd": 0.1, "wtfpl": 0.1,
    "mit": 0.25, "mit-0": 0.1, "apache": 0.25, "bsd": 0.25, "isc": 0.25, "bsl": 0.25, "zlib": 0.25,
    "x11": 0.25, "python": 0.25, "psf": 0.25, "postgresql": 0.25, "artistic": 0.25, "ncsa": 0.25,
    "cc-by": 0.25, "odc-by": 0.25,
    "mpl": 0.5, "epl": 0.5, "lgpl": 0.5, "cddl": 0.5, "eupl": 0.5, "cc-by-sa": 0.5, "odbl": 0.5,
    "gfdl": 0.5, "ofl": 0.5, "ms-pl": 0.25, "ms-rl": 0.5,
    "gpl": 0.75, "agpl": 0.75, "osl": 0.75, "sspl": 0.75,
    "cc-by-nd": 0.9, "cc-by-nc": 0.9, "cc-by-nc-sa": 0.9, "cc-by-nc-nd": 0.9, "busl": 0.9,
    "reserved": 1.0, "proprietary": 1.0,
}
UNKNOWN, WEAK = 0.9, 0.5

#: tags in folded text; True: any identifier may follow, not known licences only
TAGS = {"spdx-license-identifier:": True, "license-expression:": True, "license:": False,
        "licence:": False, "\"license\":": False, "@license": False}

PRECEDENCE = {"or": 1, "and": 2, "with": 3}
SKIP = re.compile(r"[ \t\"']*")
TOKEN = re.compile(r"[ \t]*(?:([()])|([a-z0-9](?:[a-z0-9.+:-]*[a-z0-9+])?))")
#: families whose version number may follow a notice
NUMBERED = {"apache", "gpl", "lgpl", "agpl", "mpl", "epl", "cddl", "eupl", "gfdl", "cc0"}
VERSION = re.compile(r"(?:version |v)?v?(\d)(?: (\d)(?= ))?(?= )")
VERSIONED = re.compile(r"-?v?\d+(?:\.\d+)*(?:-(?:only|or-later|clause(?:-[a-z]+)?))?\+?$|\+$")

UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
FOLD = bytes.maketrans(UPPER, LOWER)
#: what is no word character becomes a blank
BLANK = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in (FOLD[k] for k in range(256)))


def family(licence: str) -> str:
    """The family of a licence id: without version, ``-only``, ``-or-later`` and the like."""
    return VERSIONED.sub("", licence)


def grade(licence: str) -> float:
    return GRADES.get(licence, GRADES.get(family(licence), UNKNOWN))


def known(licence: str) -> bool:
    return licence in GRADES or family(licence) in GRADES


def tokens(text: str, at: int = 0) -> list[str]:
    """The tokens an expression may be made of, from ``at`` to the first character that is none."""
    out = []
    while m := TOKEN.match(text, at):
        out.append(m.group(1) or m.group(2))
        at = m.end()
    return out


def valid_part(toks: list[str]) -> list[str]:
    """The longest valid expression that ``toks`` starts with (empty: none).  ``with`` stands between
    one licence and an exception's name."""
    operand, depth, end = True, 0, 0
    for i, tok in enumerate(toks):
        after_with = i > 0 and toks[i - 1] == "with"
        if operand and tok == "(" and not after_with:
            depth += 1
        elif operand and tok not in PRECEDENCE and tok not in ("(", ")"):
            operand = False
        elif not operand and tok in PRECEDENCE:
            if tok == "with" and (toks[i - 1] == ")" or i > 1 and toks[i - 2] == "with"):
                break
            operand = True
        elif not operand and tok == ")" and depth:
            depth -= 1
        else:
            break
        if not operand and not depth:
            end = i + 1
    return toks[:end]


def evaluate(toks: list[str]) -> tuple[list[str], float]:
    """Shunting-yard over a valid expression: the licence ids in it and its grade."""
    values: list[tuple[list[str], float]] = []
    ops: list[str] = []

    def apply() -> None:
        op, (right, second), (left, first) = ops.pop(), values.pop(), values.pop()
        if op == "with":
            left = [f"{left[0]} with {right[0]}"]
            first = min(first, WEAK) if first < UNKNOWN else first
        else:
            left.extend(right)
            first = max(first, second) if op == "and" else min(first, second)
        values.append((left, first))

    for tok in toks:
        if tok == "(":
            ops.append(tok)
        elif tok == ")":
            while ops[-1] != "(":
                apply()
            ops.pop()
        elif tok in PRECEDENCE:
            while ops and ops[-1] != "(" and PRECEDENCE[ops[-1]] >= PRECEDENCE[tok]:
                apply()
            ops.append(tok)
        else:
            values.append(([tok], grade(tok)))
    while ops:
        apply()
    return values[0]


@lru_cache(maxsize=1)
def automata():
    """The phrase automaton (blank-joined words) and the tag automaton, once a worker; bytes are
    spelled as Latin-1 characters, so a position is a byte."""
    import ahocorasick

    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase in {**NOTICES, **BASE}:
        key = f" {phrase} ".encode().decode("latin-1")
        phrases.add_word(key, (len(key), BASE.get(phrase), NOTICES.get(phrase)))
    for tag, free in TAGS.items():
        tags.add_word(tag, free)
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def versioned(label: str, spaced: str, end: int) -> str:
    """The label with the version number that stands behind the phrase, if one does."""
    m = VERSION.match(spaced, end) if label in NUMBERED or label.startswith("cc-by") else None
    return label if not m else f"{label}-{m.group(1)}" + (f".{m.group(2)}" if m.group(2) else "")


def notices(spaced: str) -> list[tuple[int, int, str | None, str | None, bool]]:
    """All places of all phrases in blank-joined words: (first word, end, base label, this scan's
    label, inside a longer notice?)."""
    phrases, _ = automata()
    found, word, at, reach = [], 0, 0, -1
    for start, back, base, label in sorted((end + 1 - n, -end - 1, base or "", label or "")
                                           for end, (n, base, label) in phrases.iter(spaced)):
        word, at = word + spaced.count(" ", at, start), start
        found.append((word, -back, base or None, label or None, -back <= reach))
        reach = max(reach, -back)
    return found


def scan(data: bytes) -> dict:
    """All notices and evaluated expressions of one text.  A notice inside a longer one (``general
    public license`` in ``lesser general public license``) gives its base label, not its grade."""
    words = data.translate(BLANK).split()
    spaced = (b" " + b" ".join(words) + b" ").decode("latin-1")
    base, labels, places, strictest = [], set(), [], 0.0
    for word, end, base_label, label, inside in notices(spaced) if words else ():
        if base_label:
            base.append((word, base_label))
            labels.add(base_label)
        if not inside:
            full = versioned(label or base_label, spaced, end)
            labels.add(full)
            places.append({"label": full, "word": word})
            strictest = max(strictest, grade(full))
    expressions = []
    folded = data.translate(FOLD).decode("latin-1")
    for end, free in automata()[1].iter(folded):
        toks = valid_part(tokens(folded, SKIP.match(folded, end + 1).end()))
        if not toks:
            continue
        ids, g = evaluate(toks)
        if free or all(known(x.split(" with ")[0]) for x in ids):
            expressions.append(" ".join(toks).replace("( ", "(").replace(" )", ")"))
            labels.update(ids)
            strictest = max(strictest, g)
    return {"n_words": len(words), "n_base": len(base), "first_word": min(base)[0] if base else None,
            "last_word": max(base)[0] if base else None,
            "base_labels": ",".join(sorted({label for _, label in base})),
            "labels": ",".join(sorted(labels)), "score": strictest,
            "notices": places, "expressions": expressions}


SCHEMA = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long",
          "base_labels": "string", "labels": "string", "score": "double",
          "notices": "array<struct<label:string,word:long>>", "expressions": "array<string>"}


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, number of words, places of the base phrases (number, first and last word),
    base and all labels, the score, every notice with its word, and the expressions read."""
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).cast("binary")
    slim = docs.select(F.col(quoted(id_col)).alias("id"), text.alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        found = [scan(t) for t in batch.column("text").to_pylist()]
        return {"id": batch.column("id")} | {k: [x[k] for x in found] for k in SCHEMA}

    ddl = ", ".join(f"{k} {v}" for k, v in ({"id": id_type} | SCHEMA).items())
    return map_batches(slim, run, ddl).withColumnRenamed("id", id_col)
