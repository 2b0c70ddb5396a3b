"""License scans by template markup: token automata with optional and replaceable regions.

A template is plain wording with two marks. ``[[ ... ]]`` may be left out; ``{{n}}`` stands for any 0
to n words (a name, a year). Compiled, it is an automaton over lower-cased words: a region that may be
left out is an edge that reads nothing, a replaceable one a short chain of states that read any word.
A text carries the license if its words run from the first to the last state at some place, that is if
the mandatory wording matches exactly and in order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxledger.llm.common import annotate, free_name, words

# Base phrases and their labels, in the order of the contract.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided "
    "that the following conditions are met [[1]] redistributions of source code must retain the above "
    "copyright notice this list of conditions and the following disclaimer [[2]] redistributions in binary "
    "form must reproduce the above copyright notice this list of conditions and the following disclaimer in "
    "the documentation and or other materials provided with the distribution "
)
_BSD_NAMES = (
    "[[3]] neither the name of {{12}} nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission "
)
_BSD_END = (
    "this software is provided by {{12}} as is and any express or implied warranties including but not limited "
    "to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no "
    "event shall {{12}} be liable for any direct indirect incidental special exemplary or consequential damages "
    "including but not limited to procurement of substitute goods or services loss of use data or profits or "
    "business interruption however caused and on any theory of liability whether in contract strict liability "
    "or tort including negligence or otherwise arising in any way out of the use of this software even if "
    "advised of the possibility of such damage"
)

# Wording of published licenses and their customary notices, with optional and
# replaceable regions marked.
TEMPLATES = [
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software without "
        "restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software and to permit persons to whom the "
        "software is furnished to do so subject to the following conditions the above copyright notice "
        "and this permission notice [[including the next paragraph]] shall be included in all copies or "
        "substantial portions of the software the software is provided as is without warranty of any "
        "kind express or implied including but not limited to the warranties of merchantability fitness "
        "for a particular purpose and noninfringement in no event shall {{12}} be liable for any claim "
        "damages or other liability whether in an action of contract tort or otherwise arising from out "
        "of or in connection with the software or the use or other dealings in the software",
    ),
    ("mit", "[[this {{4}} is]] [[released|licensed|distributed|available]] under the [[terms of the]] mit license"),
    (
        "apache-2",
        "licensed under the apache license version 2 [[0]] [[the license]] [[you may not use {{4}} "
        "except in compliance with the license]]",
    ),
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use {{4}} except in compliance "
        "with the license you may obtain a copy of the license at [[https|http]] [[www]] apache org licenses "
        "license 2 0 [[txt|html]] unless required by applicable law or agreed to in writing software distributed "
        "under the license is distributed on an as is basis without warranties or conditions of any kind either "
        "express or implied see the license for the specific language governing permissions and limitations "
        "under the license",
    ),
    ("apache-2", "apache license version 2 0 january 2004"),
    ("cc-by-nc", "[[licensed|released]] under [[the]] [[a]] cc by nc [[4 0]] [[international]] [[license]]"),
    ("cc-by-nc", "creative commons attribution non commercial [[{{2}} international]] [[public]] license"),
    ("cc-by-nc", "creative commons attribution noncommercial [[{{2}} international]] [[public]] license"),
    ("gpl-3", "[[this {{6}} is]] licensed under the gnu general public license [[as published by {{6}}]] [[either]] version 3"),
    ("gpl-2", "[[this {{6}} is]] licensed under the gnu general public license [[as published by {{6}}]] [[either]] version 2"),
    ("gpl-3", "under the terms of the gnu general public license [[as published by {{6}}]] [[either]] version 3 [[of the license]]"),
    ("gpl-2", "under the terms of the gnu general public license [[as published by {{6}}]] [[either]] version 2 [[of the license]]"),
    (
        "gpl-3",
        "free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option "
        "any later version {{6}} is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu "
        "general public license for more details",
    ),
    (
        "gpl-2",
        "free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 2 of the license or at your option "
        "any later version {{6}} is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu "
        "general public license for more details",
    ),
    ("lgpl-3", "under the terms of the gnu lesser general public license [[as published by {{6}}]] [[either]] version 3 [[0]] [[of the license]]"),
    ("lgpl-2", "under the terms of the gnu lesser general public license [[as published by {{6}}]] [[either]] version 2 [[1]] [[of the license]]"),
    ("agpl-3", "under the terms of the gnu affero general public license [[as published by {{6}}]] [[either]] version 3 [[of the license]]"),
    ("lgpl-3", "gnu lesser general public license version 3 29 june 2007"),
    ("lgpl-2", "gnu lesser general public license version 2 1 february 1999"),
    ("agpl-3", "gnu affero general public license version 3 19 november 2007"),
    ("gpl-3", "gnu general public license version 3 29 june 2007"),
    ("gpl-2", "gnu general public license version 2 june 1991"),
    ("bsd-2", _BSD + _BSD_END),
    ("bsd-3", _BSD + _BSD_NAMES + _BSD_END),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0 [[if a copy of the mpl "
        "was not distributed with this file you can obtain one at {{6}}]]",
    ),
    ("cc-by", "creative commons attribution [[{{2}} international]] [[public]] license"),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify "
        "publish use compile sell or distribute this software either in source code form or as a compiled binary "
        "for any purpose commercial or non commercial and by any means",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and {{12}} disclaims all warranties with regard to this software including "
        "all implied warranties of merchantability and fitness in no event shall {{12}} be liable for any special "
        "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or "
        "profits whether in an action of contract negligence or other tortious action arising out of or in "
        "connection with the use or performance of this software",
    ),
    ("spdx:{}", "spdx license identifier {{!}}"),
]

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("base", T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("found", T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    ]
)


@dataclass(frozen=True)
class Automaton:
    """States 0..n; ``steps[s]`` maps a word (None: any word) to the states it leads to."""

    label: str
    steps: tuple[dict, ...]
    free: tuple[tuple[int, ...], ...]  # states reached by reading nothing, itself included
    final: int
    anchors: tuple[bytes, ...]  # words that a match can begin with

    def run(self, text: list[bytes], start: int) -> int:
        """End of the longest match that begins at ``start``; -1 if there is none."""
        live, at, end = set(self.free[0]), start, -1
        n = len(text)
        while live:
            if self.final in live:
                end = at
            if at >= n:
                break
            word, reached = text[at], set()
            for s in live:
                step = self.steps[s]
                for to in step.get(word, ()):
                    reached.update(self.free[to])
                for to in step.get(None, ()):
                    reached.update(self.free[to])
            live, at = reached, at + 1
        return end


_TOKEN = re.compile(r"\[\[|\]\]|\{\{(?:\d+|!)\}\}|\||[a-z0-9]+")


def compile_template(label: str, markup: str) -> Automaton:
    """The automaton of a template. ``|`` separates single words of an optional region."""
    steps: list[dict] = [{}]
    empty: list[tuple[int, int]] = []  # edges that read nothing
    opened: list[int] = []
    here, branch = 0, False

    def state() -> int:
        steps.append({})
        return len(steps) - 1

    for token in _TOKEN.findall(markup):
        if token == "[[":
            opened.append(here)
        elif token == "]]":
            empty.append((opened.pop(), here))
        elif token == "|":
            branch = True
        elif token == "{{!}}":
            to = state()
            steps[here].setdefault(None, []).append(to)
            here = to
        elif token.startswith("{{"):
            entry = here
            chain = [entry]
            for _ in range(int(token[2:-2])):
                to = state()
                steps[here].setdefault(None, []).append(to)
                here = to
                chain.append(to)
            empty += [(s, here) for s in chain[:-1]]
        elif branch:
            steps[opened[-1]].setdefault(token.encode(), []).append(here)
            branch = False
        else:
            to = state()
            steps[here].setdefault(token.encode(), []).append(to)
            here = to
    free = []
    for s in range(len(steps)):
        seen, todo = {s}, [s]
        while todo:
            x = todo.pop()
            for a, b in empty:
                if a == x and b not in seen:
                    seen.add(b)
                    todo.append(b)
        free.append(tuple(sorted(seen)))
    starts = {w for s in free[0] for w in steps[s]}
    if None in starts:
        raise ValueError(f"template of {label} begins with a replaceable region")
    return Automaton(label, tuple(steps), tuple(free), here, tuple(sorted(starts)))


def phrase_starts(joined: bytes, phrase: bytes) -> list[int]:
    """Word positions of ``phrase`` in space-joined words that have a space on both ends."""
    needle, out, at, word, last = b" " + phrase + b" ", [], joined.find(b" " + phrase + b" "), 0, 0
    while at >= 0:
        word += joined.count(b" ", last, at)
        out.append(word)
        last = at
        at = joined.find(needle, at + 1)
    return out


def scan_licenses(
    docs: DataFrame,
    *,
    text: str = "text",
    templates: list[tuple[str, str]] | None = None,
    phrases: list[tuple[str, str]] | None = None,
    keep: list[str] | None = None,
    result: str = "license",
) -> DataFrame:
    """Rows with a struct ``result``: ``n_words``, and ``base`` and ``found`` places (label, start, end).

    ``base`` are places of fixed phrases, ``found`` the longest match of a template at each place
    where one begins; positions are words from 0, the end is exclusive. Null and empty texts have no
    words and no places. Repeated rows are scanned each. An input column called like ``result`` makes
    the new one get underscores in front. A map over whole texts: no shuffle.
    """
    name = free_name(docs, result)
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases

    def make():
        automata = [compile_template(label, markup) for label, markup in templates]
        by_word: dict[bytes, list[Automaton]] = {}
        for a in automata:
            for w in a.anchors:
                by_word.setdefault(w, []).append(a)
        wanted = [(p.encode(), label) for p, label in phrases]
        # A match holds one of these words at least: texts without them need no automaton.
        rare = [_rare(markup) for _, markup in templates]

        def compute(texts):
            out = {"n_words": [], "base": [], "found": []}
            for raw in texts:
                tokens = words(raw)
                base, found = [], []
                if tokens:
                    joined = b" " + b" ".join(tokens) + b" "
                    for phrase, label in wanted:
                        if phrase in joined:
                            size = phrase.count(b" ") + 1
                            base += [{"label": label, "start": s, "end": s + size} for s in phrase_starts(joined, phrase)]
                    live = {id(a) for a, r in zip(automata, rare) if b" " + r + b" " in joined}
                    if live:
                        found = _matches(tokens, {w: [a for a in v if id(a) in live] for w, v in by_word.items()})
                    base.sort(key=lambda x: (x["start"], x["label"]))
                out["n_words"].append(len(tokens))
                out["base"].append(base)
                out["found"].append(found)
            return out

        return compute

    return annotate(docs, text, make, RESULT, name, keep)


def _rare(markup: str) -> bytes:
    """The longest mandatory word of a template."""
    depth, best = 0, ""
    for token in _TOKEN.findall(markup):
        depth += (token == "[[") - (token == "]]")
        if depth == 0 and token[0] not in "[]{|" and len(token) > len(best):
            best = token
    return best.encode()


def _matches(tokens: list[bytes], by_word: dict[bytes, list[Automaton]]) -> list[dict]:
    found, seen = [], {}
    for at, word in enumerate(tokens):
        for a in by_word.get(word, ()):
            if at < seen.get(id(a), 0):
                continue
            end = a.run(tokens, at)
            if end >= 0:
                seen[id(a)] = end
                label = a.label.format(tokens[end - 1].decode("utf-8", "replace")) if "{}" in a.label else a.label
                found.append({"label": label, "start": at, "end": end})
    return found


def license_table(docs: DataFrame) -> DataFrame:
    """One row per document: words, base places, labels and the share of words in license wording.

    ``score`` is the number of words inside any place (base or template), divided by all words; 0
    without words. Overlapping places count once.
    """
    scanned = scan_licenses(docs.select("doc_id", "text"), keep=["doc_id"], result="license")
    base, found = F.col("license.base"), F.col("license.found")
    spans = F.array_sort(F.transform(F.concat(base, found), lambda s: F.struct(s["start"], s["end"])))
    covered = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(s["start"], acc["to"]))).alias("n"),
            F.greatest(acc["to"], s["end"]).alias("to"),
        ),
        lambda acc: acc["n"],
    )
    starts = F.transform(base, lambda s: s["start"])
    labels = lambda places: F.array_distinct(F.transform(places, lambda s: s["label"]))
    n_words = F.col("license.n_words")
    return scanned.select(
        "doc_id",
        n_words.alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(labels(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels(F.concat(base, found))), ",").alias("labels"),
        F.when(n_words > 0, covered / n_words).otherwise(F.lit(0.0)).alias("score"),
    )
