"""Licence scans: an Aho-Corasick automaton finds notice phrases and identifier tags in
one pass over a text's words; a shunting-yard parser reads the licence expressions behind
identifier tags and evaluates them over and / or / with."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import text_slices, utf8

#: Phrases (words in sequence) and the label each stands for.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Phrases the method adds: well-known notices.
NOTICE_PHRASES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license": "apache",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "redistributions of source code must retain": "bsd",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "dedicated to the public domain": "public-domain",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
}
TAG_PHRASE = "spdx license identifier"
#: How free use is under a licence, by the beginning of its identifier: 1 free, 0 none.
FREEDOM = {
    "cc0": 1.0, "public-domain": 1.0, "unlicense": 1.0, "mit": 1.0, "bsd": 1.0, "apache": 1.0, "isc": 1.0,
    "cc-by-nc": 0.2, "cc-by-nd": 0.3, "cc-by-sa": 0.6, "cc-by": 0.9, "mpl": 0.7, "epl": 0.7, "lgpl": 0.6,
    "gpl": 0.5, "agpl": 0.4, "reserved": 0.0,
}
UNKNOWN_FREEDOM = 0.1
NO_NOTICE = 0.5

# Every ASCII byte that is no digit or letter becomes a blank, A-Z become a-z.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
_TAG = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+-]+")
_RANK = {"or": 1, "and": 2, "with": 3}


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def parse_expression(text: str) -> list[str] | None:
    """Shunting-yard: the longest well-formed expression at the start of ``text`` in
    postfix order; None if there is none. ``with`` binds closest, then ``and``, ``or``;
    operators are read in any case. Reading stops where the grammar no longer fits
    (a closing comment, prose)."""
    good: list[str] | None = None
    out: list[str] = []
    ops: list[str] = []
    depth, operand = 0, True
    at = 0
    while True:
        gap = re.compile(r"[ \t]*").match(text, at).end()
        m = _TOKEN.match(text, gap)
        if not m:
            break
        tok, low = m.group(), m.group().lower()
        if operand:
            if tok == "(":
                ops.append(tok)
                depth += 1
            elif tok == ")" or low in _RANK:
                break
            else:
                out.append(low)
                operand = False
        elif tok == ")":
            if not depth:
                break
            while ops[-1] != "(":
                out.append(ops.pop())
            ops.pop()
            depth -= 1
        elif low in _RANK:
            while ops and ops[-1] != "(" and _RANK[ops[-1]] >= _RANK[low]:
                out.append(ops.pop())
            ops.append(low)
            operand = True
        else:
            break
        at = m.end()
        if not operand and not depth:
            good = out + [o for o in reversed(ops)]
    return good


def freedom(licence: str) -> float:
    name = max((k for k in FREEDOM if licence.startswith(k)), key=len, default=None)
    return UNKNOWN_FREEDOM if name is None else FREEDOM[name]


def evaluate(postfix: list[str]) -> tuple[float, set[str]]:
    """``(freedom, licences named)``: ``or`` lets the user choose the freer side, ``and``
    binds to the stricter, ``with`` grants an exception to the licence on its left."""
    stack: list[tuple[float, set[str]]] = []
    for tok in postfix:
        if tok in _RANK:
            right, left = stack.pop(), stack.pop()
            if tok == "with":
                stack.append((min(1.0, left[0] + 0.1), left[1]))
            else:
                stack.append(((max if tok == "or" else min)(left[0], right[0]), left[1] | right[1]))
        else:
            stack.append((freedom(tok), {tok}))
    return stack[0]


class LicenceScanner:
    """One automaton over ``phrases`` (words → label) and the identifier tag."""

    def __init__(self, base: dict[str, str], notices: dict[str, str]):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for phrase in {**base, **notices, TAG_PHRASE: ""}:
            # Blanks on both sides: whole words only.
            self.automaton.add_word(f" {phrase} ", (phrase.count(" ") + 2, base.get(phrase), notices.get(phrase), phrase))
        self.automaton.make_automaton()

    def scan(self, raw: bytes) -> tuple:
        """``(n_words, n_base, first_word, last_word, base labels, labels, score)``."""
        words = words_of(raw)
        text = (b" " + b" ".join(words) + b" ").decode(errors="replace")
        places, base, labels, free = [], set(), set(), []
        tagged = False
        at = passed = 0         # blanks before ``at``: hits come by their ends, so each is counted once
        for end, (blanks, base_label, label, phrase) in self.automaton.iter(text):
            if base_label is not None:
                passed, at = passed + text.count(" ", at, end + 1), end + 1
                places.append(passed - blanks)
                base.add(base_label)
                labels.add(base_label)
                free.append(freedom(base_label))
            elif label is not None:
                labels.add(label)
                free.append(freedom(label))
            tagged |= phrase == TAG_PHRASE
        if tagged:
            for m in _TAG.finditer(raw.decode(errors="replace")):
                postfix = parse_expression(m.group(1))
                if postfix:
                    value, named = evaluate(postfix)
                    labels |= named
                    free.append(value)
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), min(free, default=NO_NOTICE))


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double")
_SCANNERS: dict[tuple, LicenceScanner] = {}


def scan(docs: DataFrame, base: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """``docs(doc_id, text, …)`` → one row per input row (``SCHEMA``); narrow, no shuffle.

    Null text is empty text: no words, null first and last word, empty labels. ``score``
    is the freedom the strictest notice or expression leaves (``NO_NOTICE`` without any).
    Repeated rows give repeated results. Licence names in ``labels`` are lower-case."""
    base, notices = base or BASE_PHRASES, NOTICE_PHRASES if notices is None else notices

    def run(batches):
        key = (tuple(base.items()), tuple(notices.items()))
        if key not in _SCANNERS:
            _SCANNERS[key] = LicenceScanner(base, notices)
        own = _SCANNERS[key]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in text_slices(batches):
            columns = zip(*map(own.scan, utf8(batch)), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, k) for v, k in zip(columns, kinds, strict=True))], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, SCHEMA)
