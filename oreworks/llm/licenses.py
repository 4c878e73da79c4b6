"""License scan: phrases, and notices matched against templates by token automata.

Words are the maximal runs of letters, digits and all signs outside ASCII, A-Z in lower case. A phrase
matches wherever its words stand one after the other. A template is a notice in which
``[[ ]]`` encloses words that may be missing, ``<a b|c>`` wordings of which one must stand, both nested if need be,
``{a,b}`` stands for a to b words of any kind, and ``!a`` at the end for a next word that is not a. Each template is compiled once into an automaton over words (``compile_template``), whose states are
the bits of an integer. A text is accepted if from some word on the automaton
reaches its end: all mandatory words must stand there exactly and in order.

Texts are read whole. Null, empty and wordless texts have no words and no labels, score 0. The score is 1
where a template matches, 0.5 where only phrases do, else 0. Equal texts give equal rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from oreworks.llm import texts

# Phrases and their labels (fixed values).
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

GRANTED = (
    "<licensed|released|distributed|redistributed|published|available|provided|modify {1,4}|redistribute {1,4}>"
    " under [[<a|the>]] [[terms [[and conditions]] of]] [[the]]"
)
FOUNDATION = "as published by the free software foundation [[inc]]"
GNU_REST = (
    "[[or at your option any later version]] {1,3} is distributed in the hope that it will be useful but without any warranty without even the"
    " implied warranty of merchantability or fitness for a particular purpose see the NAME for more details you should have received a copy"
    " of the NAME along with {1,4} if not <see {0,4} org licenses|write to the free software foundation [[inc]] {3,14} ma {1,2}>"
)
MIT = "permission is hereby granted free of charge to any person obtaining a copy of {1,12} to deal in {1,8} without restriction"
MIT_REST = (
    "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of {1,8} and to permit persons"
    " to whom {1,8} <is|are> furnished to do so subject to the following conditions the above copyright notice and this permission notice [[{1,4}]]"
    " shall be included in all copies or substantial portions of {1,8} <is|are> provided as is without warranty of any kind express or implied"
    " including but not limited to the warranties of merchantability fitness for a particular purpose and <noninfringement|non infringement>"
    " in no event shall {1,16} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from"
    " out of or in connection with {1,8} or the use or other dealings in <the|this|these> {1,1}"
)
BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
    " [[{1,1}]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
    " [[{1,1}]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"
    " in the documentation and or other materials provided with the distribution"
)
BSD_CREDIT = (
    "[[{1,1}]] all advertising materials mentioning features or use of this software must display the following acknowledgement"
    " this product includes software developed by {1,24}"
)
BSD_NAMES = (
    "[[{1,1}]] <neither the <name|names> of {1,24} may|the <name|names> of {1,24} may not> be used to endorse or promote products derived from"
    " this software without specific prior written permission"
)
BSD_REST = (
    "this software is provided by {1,24} as is and any express or implied warranties including but not limited to the implied warranties of"
    " merchantability and fitness for a particular purpose are disclaimed in no event shall {1,24} be liable for any direct indirect incidental"
    " special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or"
    " profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including"
    " negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
)
ISC = (
    "permission to use copy modify and [[or]] distribute {1,3} for any purpose with or without fee is hereby granted provided that the above copyright"
    " notice and this permission notice appear in all copies {1,3} is provided as is and {1,16} disclaims all warranties with regard to {1,3} including"
    " all implied warranties of merchantability and fitness in no event shall {1,16} be liable for any special direct indirect or consequential damages"
    " or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action"
    " arising out of or in connection with the use or performance of <the|this> {1,1}"
)


def _gnu() -> dict[str, tuple[str, ...]]:
    """Grants of the GNU licences, and under ``-header`` the notice of a source file to its end."""
    found = {}
    for label, kind, versions in (
        ("gpl", "", ("1.0", "2.0", "3.0")),
        ("lgpl", "<lesser|library>", ("2.0", "2.1", "3.0")),
        ("agpl", "affero", ("3.0",)),
    ):
        name = f"gnu {kind} general public license"
        for version in versions:
            first, second = version.split(".")
            # 2 is not the beginning of 2.1.
            number, bar = (f"{first} [[0]]", "!1") if second == "0" else (f"{first} {second}", "")
            written = f"<version {number}|v {number}|v{number}>"
            found[f"{label}-{version}"] = (
                f"{GRANTED} {name} [[{label}]] [[{FOUNDATION}]] [[<either|only>]] {written} {bar}",
                f"{GRANTED} version {number} of the {name}",
                f"{GRANTED} [[gnu]] {label} [[license]] <{written}|{number}> {bar}",
                f"{GRANTED} [[gnu]] {label}v{number} {bar}",
            )
            found[f"{label}-{version}-header"] = (
                f"modify {{1,4}} under the terms of <version {number} of the {name} [[{FOUNDATION}]]|the {name} version {number} [[only]] {FOUNDATION}"
                f"|the {name} {FOUNDATION} [[either]] version {number} [[only]] [[of the license]]> {GNU_REST.replace('NAME', name)}",
            )
    return found


def _creative_commons() -> dict[str, tuple[str, ...]]:
    words = {"nc": "<noncommercial|non commercial>", "sa": "<sharealike|share alike>", "nd": "<noderivatives|no derivatives|noderivs|no derivs>"}
    found = {}
    for parts in ((), ("nc",), ("sa",), ("nd",), ("nc", "sa"), ("nc", "nd")):
        short, long = " ".join(("by", *parts)), " ".join(("attribution", *(words[p] for p in parts)))
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            # Of version 2 there are two, so it is named in full.
            number = version.replace(".", " ") if version[0] == "2" else f"{version[0]} [[0]]"
            number = f"[[<version|v>]] <{number}|v{number}>"
            found["-".join(("cc", "by", *parts, version))] = (
                f"{GRANTED} <cc|creative commons> {short} [[<license|licence>]] {number}",
                f"{GRANTED} <cc|creative commons> {long} [[<license|licence>]] {number}",
                f"creativecommons org licenses {short} {version.replace('.', ' ')}",
            )
    found["cc0-1.0"] = (f"{GRANTED} [[creative commons]] <cc0|cc zero> [[version]] 1 0", "creativecommons org publicdomain zero 1 0")
    return found


# Notices by label, from their first word to their last. Grants are in words of our own choosing where licences leave the wording open.
TEMPLATES = {
    "apache-1.1": (f"{GRANTED} apache [[software]] [[license]] [[<version|v>]] <1 1|v1 1>",),
    "apache-2.0": (
        f"{GRANTED} apache [[software]] [[<license|licence>]] [[<version|v>]] <2|v2> [[0]]",
        f"{GRANTED} version 2 [[0]] of the apache [[software]] license",
    ),
    "apache-2.0-header": (
        "licensed under the apache license version 2 0 [[the license]] you may not use {1,4} except in compliance with the license you may obtain a copy"
        " of the license at {1,10} unless required by applicable law or agreed to in writing {1,3} distributed under the license is distributed on an"
        " as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing"
        " permissions and limitations under the license",
    ),
    **_gnu(),
    "mit-notice": (f"{GRANTED} mit <license|licence>", MIT),
    "mit-text": (f"{MIT} {MIT_REST}",),
    **_creative_commons(),
    "bsd-2-clause": (f"{BSD} {BSD_REST}",),
    "bsd-3-clause": (f"{BSD} {BSD_NAMES} {BSD_REST}",),
    "bsd-4-clause": (f"{BSD} {BSD_CREDIT} {BSD_NAMES} {BSD_REST}",),
    "isc": (ISC,),
}

WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass(frozen=True)
class Automaton:
    """``by_word``: the states that a word leads to, before masking by what it can come from; ``any_word`` for every
    word. State i is bit i; reading a word moves along i to i + 1, ``skips`` are moves that read nothing."""

    by_word: dict[int, int]
    any_word: int
    skips: tuple[tuple[int, int], ...]
    end: int
    barred: frozenset[int]  # words that may not follow
    needed: frozenset[int]  # words that no match is without

    def closed(self, states: int) -> int:
        for a, b in self.skips:  # sorted by where they start, so one pass closes
            if states >> a & 1:
                states |= 1 << b
        return states

    def matches(self, ids: np.ndarray, start: int) -> bool:
        """Whether the automaton reaches its end on the words from ``start`` on."""
        states = self.closed(1)
        for i in range(start, len(ids) + 1):
            if states >> self.end & 1 and (i == len(ids) or int(ids[i]) not in self.barred):
                return True
            if not states or i == len(ids):
                return False
            states = self.closed((states & (self.by_word.get(int(ids[i]), 0) | self.any_word)) << 1)
        return False

    def first_words(self) -> list[int]:
        states = self.closed(1)
        return [w for w, from_states in self.by_word.items() if from_states & states]


def compile_template(template: str, word_ids: dict[str, int]) -> Automaton:
    """States are the places between the template's words in order; wordings stand one behind the other, a state apart."""
    by_word: dict[int, int] = {}
    any_word, state, skips, opened, wordings, barred, needed = 0, 0, [], [], [], set(), set()
    for token in re.findall(r"\[\[|\]\]|\{\d+,\d+\}|[<|>]|[^\s\[\]{}<|>]+", template):
        if token == "<":
            wordings.append([state])
        elif token == "|":
            wordings[-1].append(state)
            state += 1
            skips.append((wordings[-1][0], state))
        elif token == ">":
            skips.extend((end, state) for end in wordings.pop()[1:])
        elif token[0] == "!":
            barred.add(word_ids[token[1:]])
        elif token == "[[":
            opened.append(state)
        elif token == "]]":
            skips.append((opened.pop(), state))
        elif token[0] == "{":
            least, most = map(int, token[1:-1].split(","))
            first = state
            for _ in range(most):
                any_word |= 1 << state
                state += 1
            skips.extend((i, state) for i in range(first + least, state))
        else:
            word = word_ids[token]
            by_word[word] = by_word.get(word, 0) | 1 << state
            state += 1
            if not opened and not wordings:
                needed.add(word)
    if opened or wordings or state == 0:
        raise ValueError(f"not a template: {template!r}")
    return Automaton(by_word, any_word, tuple(sorted(skips)), state, frozenset(barred), frozenset(needed))


class Scanner:
    """Phrases and templates, compiled."""

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, tuple[str, ...]] = TEMPLATES):
        plain = " ".join([*phrases, *(t for ts in templates.values() for t in ts)])
        vocabulary = sorted(set(re.findall(r"[^\s\[\]{},<|>!]+", re.sub(r"\{\d+,\d+\}", " ", plain))))
        self.vocabulary = pa.array([w.encode() for w in vocabulary], pa.large_binary())
        ids = {w: i for i, w in enumerate(vocabulary)}
        self.phrases = [([ids[w] for w in p.split()], label) for p, label in phrases.items()]
        self.templates = [(compile_template(t, ids), label) for label, ts in templates.items() for t in ts]

    def scan(self, data: np.ndarray, at: np.ndarray) -> list[dict]:
        """One row per text."""
        data, at = texts.spaced(LOWER[data], at)
        starts, _, words = texts.words(data, WORD_BYTES[data])
        first = texts.per_text(starts, at)
        different, which = texts.distinct(words)
        known = pc.index_in(different, self.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
        ids = known[which] if len(which) else np.zeros(0, np.int32)
        text = np.repeat(np.arange(len(at) - 1), np.diff(first))
        found: list[dict] = [
            {"n_words": int(n), "n_base": 0, "first_word": None, "last_word": None, "base": set(), "more": set()} for n in np.diff(first)
        ]
        for words, label in self.phrases:
            n = len(words)
            hit = ids[: len(ids) - n + 1] == words[0] if len(ids) >= n else np.zeros(0, bool)
            for k in range(1, n):
                hit &= ids[k : len(ids) - n + 1 + k] == words[k]
            hit = np.flatnonzero(hit)
            hit = hit[text[hit] == text[hit + n - 1]]
            for i in hit.tolist():
                row, place = found[text[i]], i - int(first[text[i]])
                row["n_base"] += 1
                row["base"].add(label)
                row["first_word"] = place if row["first_word"] is None else min(place, row["first_word"])
                row["last_word"] = place if row["last_word"] is None else max(place, row["last_word"])
        present = set(known.tolist())
        for automaton, label in self.templates:
            if not automaton.needed <= present:
                continue
            for i in np.flatnonzero(np.isin(ids, automaton.first_words())).tolist():
                row = found[text[i]]
                if label not in row["more"] and automaton.matches(ids[: first[text[i] + 1]], i):
                    row["more"].add(label)
        return [
            {k: row[k] for k in ("n_words", "n_base", "first_word", "last_word")}
            | {
                "base_labels": ",".join(sorted(row["base"])),
                "labels": ",".join(sorted(row["base"] | row["more"])),
                "score": 1.0 if row["more"] else 0.5 if row["base"] else 0.0,
            }
            for row in found
        ]


RESULT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(text: Column, scanner: Scanner | None = None) -> Column:
    """A struct with the fields of ``RESULT`` for each text."""
    scanner = scanner or Scanner()
    kind = pa.struct([
        *((n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")),
        *((n, pa.string()) for n in ("base_labels", "labels")),
        ("score", pa.float64()),
    ])

    @F.arrow_udf(f"struct<{RESULT.replace(' ', ':').replace(',:', ',')}>")
    def scanned(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([row for piece in texts.pieces(column) for row in scanner.scan(*piece)], kind)

    return scanned(text)
