"""Line-first cleaning: judge every line, drop the failing ones, reject texts that lose too much.

A line with a word fails if one of these rules says so:

* navigation: at least ``nav_marks`` separator marks (``|`` and the like), and one for at most
  ``words_per_mark`` words;
* boilerplate: it is short and holds a phrase of licence, cookie, log-in or footer lines, or over
  ``stutter_share`` of its words repeat the word before;
* punctuation: it is a fragment (fewer than ``min_words`` words without closing punctuation), or the
  marks ``# * $ % & < > { } \\ ^ ~ = _`` and repeated ``!!``/``??`` make up over ``mark_share`` of its
  word characters, or it has no letter or digit.

Blank lines are neither kept nor lost.  A text is rejected if the kept lines hold less than
``min_kept`` of its word characters, or fewer than ``min_words`` words.

Base counts per text: words, their characters, symbols, lines equal to an earlier one, and words in
5-word windows that occur twice or more.  Defined results: a null or empty text has no words and is
rejected.  Texts of any length are processed whole; repeated rows are judged each, alike; a share that
just meets a limit passes; an empty table gives an empty result; columns other than the id and the text
are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, quoted, texts_of

SYMBOLS = b"#*$%&|<>"
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
WINDOW = 5

NAVIGATION = re.compile(r"[|»«•·›‹→]|::|>>|<<")
MARKS = re.compile(r"[#*$%&<>{}\\^~=_|]|!{2,}|\?{2,}")
CLOSED = re.compile(r"[.!?…:;。！？][\"'”’»)\]]*[\x20\x09-\x0D]*$")
WORD_CHAR = re.compile(r"[^\W_]")
BOILERPLATE = re.compile("|".join((
    r"licen[sc]ed under", r"all rights reserved", r"terms of (use|service)", r"privacy policy",
    r"accept (all )?cookies", r"we use cookies", r"enable javascript", r"javascript is (disabled|required)",
    r"(log|sign) (in|up|out)\b", r"subscribe to", r"click here", r"read more", r"share (this|on)\b",
    r"powered by", r"lorem ipsum", r"copyright (©|\(c\)|\d)", r"© ?\d{4}",
    # German, French, Spanish
    r"alle rechte vorbehalten", r"lizenziert unter", r"nutzungsbedingungen", r"datenschutzerkl", r"cookies? akzeptieren",
    r"jetzt anmelden", r"hier klicken", r"weiterlesen", r"newsletter abonnieren",
    r"tous droits r", r"sous licence", r"conditions d'utilisation", r"politique de confidentialit", r"accepter les cookies",
    r"cliquez ici", r"lire la suite", r"se connecter", r"abonnez-vous",
    r"todos los derechos reservados", r"bajo licencia", r"condiciones de uso", r"de privacidad", r"aceptar (las )?cookies",
    r"haga clic", r"leer m.s", r"iniciar sesi", r"suscr.bete")), re.IGNORECASE | re.ASCII)


@dataclass(frozen=True)
class Rules:
    """Limits of the line rules; the defaults are the production setting."""
    min_words: int = 5
    nav_marks: int = 3
    words_per_mark: float = 6.0
    mark_share: float = 0.12
    boilerplate_words: int = 40
    stutter_share: float = 0.3
    min_kept: float = 0.5


def line_fails(line: str, words: list[bytes], chars: int, rules: Rules = Rules()) -> str | None:
    """The rule that a line with these words (of ``chars`` characters) fails, or None."""
    n = len(words)
    if MARKS.search(line) or NAVIGATION.search(line):
        nav = len(NAVIGATION.findall(line))
        if nav >= rules.nav_marks and n <= rules.words_per_mark * nav:
            return "navigation"
        if len(line) - len(MARKS.sub("", line)) > rules.mark_share * chars:
            return "punctuation"
    if n <= rules.boilerplate_words and BOILERPLATE.search(line):
        return "boilerplate"
    if sum(map(bytes.__eq__, words, words[1:])) > rules.stutter_share * n:
        return "boilerplate"
    if n < rules.min_words and not CLOSED.search(line) or not WORD_CHAR.search(line):
        return "punctuation"
    return None


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words covered by ``width``-word windows that occur twice or more (each occurrence counts)."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    if len(set(zip(*(words[i:] for i in range(width))))) == n:
        return 0
    seen = Counter(zip(*(words[i:] for i in range(width))))
    starts = np.fromiter(map(seen.__getitem__, zip(*(words[i:] for i in range(width)))), np.int64, n) > 1
    change = np.zeros(len(words) + 1, np.int64)
    change[:n] += starts
    change[width:] -= starts
    return int((np.cumsum(change[:-1]) > 0).sum())


def judge(text: str, rules: Rules = Rules()) -> dict:
    """Base counts, the cleaned text and the verdict for one text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len(text) - sum(map(data.count, BLANKS))
    seen, copies, kept, kept_chars, kept_words = set(), 0, [], 0, 0
    for line in text.split("\n"):
        raw = line.encode("utf-8", "surrogatepass")
        inside = raw.split()
        if not inside:
            continue
        copies += raw in seen
        seen.add(raw)
        line_chars = len(line) - sum(map(raw.count, BLANKS))
        if line_fails(line, inside, line_chars, rules) is None:
            kept.append(line)
            kept_words += len(inside)
            kept_chars += line_chars
    repeats = repeated_words(words)
    base_failed = len(words) < 10 or 100 * repeats > 20 * len(words)
    return {"n_words": len(words), "word_chars": chars,
            "n_symbols": sum(map(data.count, SYMBOLS)), "n_dup_lines": copies,
            "n_repeat_words": repeats, "base_failed": base_failed,
            "kept": not base_failed and kept_words >= rules.min_words
            and kept_chars >= rules.min_kept * chars,
            "kept_words": kept_words, "cleaned": "\n".join(kept)}


SCHEMA = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
          "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean",
          "kept_words": "long", "cleaned": "string"}


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                rules: Rules = Rules(), with_text: bool = True) -> DataFrame:
    """Per document: id, the base counts, ``kept``, ``kept_words`` and the ``cleaned`` text."""
    outs = {k: v for k, v in SCHEMA.items() if with_text or k != "cleaned"}
    slim = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        found = [judge(t, rules) for t in texts_of(batch)]
        return {"id": batch.column("id")} | {k: [x[k] for x in found] for k in outs}

    ddl = ", ".join(f"{k} {v}" for k, v in ({"id": id_type} | outs).items())
    return map_batches(slim, run, ddl).withColumnRenamed("id", id_col)
