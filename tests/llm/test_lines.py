"""Line-first cleaning: rules, base counts against a plain version, odd rows."""

import random
import re
from collections import Counter

import pytest

from starmart.llm import lines

SCHEMA = "doc_id long, text string, id string, kept int"


def fails(line):
    words = line.encode().split()
    return lines.line_fails(line, words, sum(len(w.decode()) for w in words))


@pytest.mark.parametrize("line, rule", [
    ("A plain sentence that says what it says.", None),
    ("No closing mark, but enough words here", None),
    ("Yes.", None),
    ("Read the full story", "punctuation"),
    ("*** --- ***", "punctuation"),
    ("WIN!! BIG!! NOW!! TODAY!! HERE!!", "punctuation"),
    ("word*** other### more%%% and&&& so$$$ on.", "punctuation"),
    ("Home | About | Contact | Shop | Help", "navigation"),
    ("Start » Shop » Shoes » Boots", "navigation"),
    ("This work is licensed under the Apache License, Version 2.0.", "boilerplate"),
    ("Please sign in to go on reading this page.", "boilerplate"),
    ("spam spam spam spam spam spam and eggs too.", "boilerplate"),
    ("The price was $5, which is 3% more than last year, he said.", None),
    ("这是一个句子。", None),
])
def test_rules(line, rule):
    assert fails(line) == rule


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


def brute(text):
    text = text or ""
    words = words_of(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(5)}
    own = [x for x in text.split("\n") if words_of(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(own) - len(set(own)),
            len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words))


def texts_of():
    rng = random.Random(2)
    pool = ["a", "b", "é#", "\x85c", "d|", "日本", "\n", "\t", "x."]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    return texts + ["", None, "\n\n", "one", "1 2 3 4 5 6 7 8 9 10", "ab " * 50, "line one here\n" * 3,
                    "\r\nx\r\n", "w " * 30_000]


def test_counts_match_a_plain_version():
    for t in texts_of():
        r = lines.judge(t or "")
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["base_failed"]) == brute(t)
        assert not (r["base_failed"] and r["kept"])


def test_failing_lines_go_and_texts_that_lose_too_much_are_rejected():
    prose = "\n".join(("The ferry left the old harbour before the fog had lifted.",
                       "Nobody aboard could see how far the northern lights reached.",
                       "A baker from the valley sold warm bread near both stairs.",
                       "Two children counted gulls until their mother called them in.",
                       "By noon every passenger had found a dry seat below deck.",
                       "Rain came late, which pleased farmers along that dusty coast."))
    nav = "Home | About | Contact | Shop | Help"
    r = lines.judge(f"{nav}\n{prose}\n\nAll rights reserved")
    assert r["kept"] and r["cleaned"] == prose
    assert not lines.judge("\n".join(nav.replace("Shop", f"Shop{i}") for i in range(30)) + "\n" + prose[:60])["kept"]


def test_dataframe(spark):
    texts = texts_of()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "a b", None, None)], SCHEMA)
    got = lines.clean_lines(df).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        if r.doc_id is not None:
            assert tuple(r)[1:7] == brute(texts[r.doc_id])
    assert lines.clean_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_boilerplate_in_four_languages():
    for line in ("All rights reserved by the owner of this page.", "Alle Rechte vorbehalten, siehe unten auf der Seite.",
                 "Tous droits réservés, voir les conditions d'utilisation.", "Todos los derechos reservados en esta página.",
                 "Hier klicken und weiterlesen auf der nächsten Seite.", "Cliquez ici pour lire la suite du texte.",
                 "Haga clic para leer más en otra página."):
        assert lines.line_fails(line, line.encode().split(), len(line)) == "boilerplate", line
    for line in ("Er las das Buch und legte es auf den Tisch.", "Elle a lu le livre et l'a posé sur la table.",
                 "El libro está sobre la mesa de la cocina."):
        assert lines.line_fails(line, line.encode().split(), len(line)) is None, line
