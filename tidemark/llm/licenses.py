"""Licence scans: an Aho-Corasick automaton finds tags and notices, licence expressions are evaluated."""

from __future__ import annotations

import re
from collections.abc import Mapping

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ALNUM, sliced

# Base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Further notices, as words, and their labels.
NOTICES = {
    "licensed under cc by nc": "cc-by-nc", "licensed under cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by", "licensed under the apache license": "apache",
    "apache license version 2 0": "apache-2.0", "mit license": "mit", "permission is hereby granted free of charge": "mit",
    "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd",
    "lesser general public license": "lgpl", "affero general public license": "agpl",
    "mozilla public license": "mpl", "public domain": "public-domain", "unlicense": "unlicense",
    "spdx license identifier": "spdx",
}

# How freely text under a licence may be used, 1 for free use. Prefix of an identifier.
FREEDOM = {
    "cc0": 1.0, "public-domain": 1.0, "unlicense": 1.0, "0bsd": 1.0, "mit": 0.9, "bsd": 0.9, "isc": 0.9, "zlib": 0.9,
    "apache": 0.9, "cc-by-nc": 0.2, "cc-by-nd": 0.2, "cc-by-sa": 0.5, "cc-by": 0.8, "mpl": 0.5, "epl": 0.5,
    "lgpl": 0.4, "agpl": 0.2, "gpl": 0.3, "reserved": 0.0, "proprietary": 0.0,
}
#: Freedom of an identifier that is not listed.
UNLISTED = 0.1
#: What an exception granted by WITH adds, up to 1.
EXCEPTION = 0.1

TAG = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)")
TOKEN = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+:-]*")
BINDING = {"or": 1, "and": 2, "with": 3}


def freedom(name: str) -> float:
    """Of the listed prefixes that fit an identifier, the longest one's value."""
    fits = [p for p in FREEDOM if name == p or name.startswith((p + "-", p + "+", p + "."))]
    return FREEDOM[max(fits, key=len)] if fits else UNLISTED


def parse_expression(text: str) -> tuple[list[str], int]:
    """Shunting-yard: postfix form of the longest valid expression at the start of the text, and the
    number of tokens it takes; an empty list if there is none."""
    out, held, best, used = [], [], ([], 0), 0
    wants_name, depth = True, 0
    for m in TOKEN.finditer(text):
        word = m[0]
        if word == "(" and wants_name:
            held.append(word)
            depth += 1
        elif word == ")" and not wants_name and depth:
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
            depth -= 1
        elif word in BINDING and not wants_name:
            while held and held[-1] != "(" and BINDING[held[-1]] >= BINDING[word]:
                out.append(held.pop())
            held.append(word)
            wants_name = True
        elif word not in BINDING and word not in "()" and wants_name:
            out.append(word)
            wants_name = False
        else:
            break
        used += 1
        if not wants_name and not depth:
            best = (out + held[::-1], used)
    return best


def evaluate(postfix: list[str]) -> tuple[float, list[str]]:
    """Freedom of an expression and the licences it names: OR takes the freest choice, AND the least
    free part, WITH adds an exception to a licence."""
    stack: list[tuple[float, list[str]]] = []
    for word in postfix:
        if word not in BINDING:
            stack.append((freedom(word), [word]))
            continue
        (b, right), (a, left) = stack.pop(), stack.pop()
        if word == "with":
            stack.append((min(1.0, a + EXCEPTION), [f"{left[-1]}-with-{right[0]}", *left]))
        else:
            stack.append((max(a, b) if word == "or" else min(a, b), left + right))
    return stack[0] if stack else (1.0, [])


def automaton(phrases: Mapping[str, tuple[str, bool]]) -> ahocorasick.Automaton:
    """Finds phrases as whole words in words joined, led and followed by single spaces."""
    found = ahocorasick.Automaton()
    for phrase, (label, base) in phrases.items():
        found.add_word(f" {phrase} ", (label, base, phrase.count(" ") + 1))
    found.make_automaton()
    return found


def scan_text(text: str | None, machine: ahocorasick.Automaton) -> dict:
    """All results for one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.translate(ALNUM).split()
    line = " " + b" ".join(words).decode("utf-8", "surrogatepass") + " "
    base, labels, starts, notices, seen, word = set(), set(), [], 0, 0, 0
    tagged = False
    for end, (label, is_base, size) in machine.iter(line):
        word += line.count(" ", seen, end)  # spaces before the last one matched: words up to the end
        seen = end
        if label == "spdx":
            tagged = True
        elif is_base:
            base.add(label)
            starts.append(word - size)
        else:
            notices += 1
        if label != "spdx":
            labels.add(label)
    values, expressions = [freedom(x) for x in labels], []
    if tagged:
        for m in TAG.finditer(text.lower()):
            postfix, _ = parse_expression(m[1])
            if postfix:
                value, names = evaluate(postfix)
                values.append(value)
                labels.update(names)
                expressions.append(" ".join(postfix))
    both = ",".join(sorted(labels)) if labels else ""
    return {
        "n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)), "labels": both, "score": min(values, default=1.0),
        "n_notices": notices, "expressions": expressions,
    }


RESULT = (
    "struct<n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, base_labels: string, labels: string, "
    "score: double, n_notices: bigint, expressions: array<string>>"
)


def scan(text: Column, notices: Mapping[str, str] | None = None) -> Column:
    """A struct per text; see ``scan_documents``."""
    extra = NOTICES if notices is None else notices
    phrases = {**{p: (l, False) for p, l in extra.items()}, **{p: (l, True) for p, l in BASE_PHRASES.items()}}
    kinds = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("n_notices", pa.int64()), ("expressions", pa.list_(pa.string()))]

    @F.arrow_udf(RESULT)
    def found(texts: pa.Array) -> pa.Array:
        machine, rows = automaton(phrases), []
        for part in sliced(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            rows += [scan_text(t, machine) for t in part.column("text").to_pylist()]
        return pa.array(rows, pa.struct(kinds))

    # Not repeated below filters on its result, as the optimiser may do with a pure function.
    return found.asNondeterministic()(text.cast("string"))


def scan_documents(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs`` with what a scan of the whole text finds.

    Words are runs of ASCII letters (A-Z in lower case), digits and non-ASCII characters; a phrase is
    found where its words stand in a row, overlaps included. ``n_base`` counts the places of base
    phrases, ``first_word`` and ``last_word`` are their smallest and largest start (null if none).
    ``labels`` has the labels of all notices and the licences that ``SPDX-License-Identifier:``
    expressions name. ``score`` is the freedom of use of the strictest licence found, 1 if none is.
    Null and empty texts find nothing; rows are independent, so ties and repeats need no rule. Columns
    of the same names are replaced.
    """
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_notices", "expressions"]
    marked = docs.withColumn("_scanned_here", scan(F.col(text), **how))
    return marked.withColumns({n: F.col("_scanned_here")[n] for n in names}).drop("_scanned_here")
