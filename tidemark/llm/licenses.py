"""Licence scan: ordered signature rules behind a keyword prefilter.

A text becomes its lower-case words with one blank between. One pass of an Aho-Corasick automaton
over that finds the keywords that it holds; only rules whose keyword is there run their regex. Each
match is an interval of words. Rules go by priority: an interval that lies inside one that a rule of
higher priority has found is suppressed, so "general public license" inside "gnu general public
license version 3" adds nothing. Base phrases are found beside the rules and always stay.

Null and empty texts have no words, no labels and score 0; a very long text is scanned whole, in time in
proportion to its length and matches. Ids pass through as they are, repeated rows give repeated results,
columns are picked by name, and an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.columns import text_of
from tidemark.llm.license_rules import NAMES, VER

#: The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: How sure a kind of evidence is: a tag, a name with its version, a name, a base phrase.
TAG, VERSIONED, NAMED, PHRASE = 1.0, 0.95, 0.8, 0.6
SPDX = "spdx license identifier"

# Bytes outside [0-9A-Za-z\x80-\xff] part words; A-Z become a-z.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


@dataclass(frozen=True)
class LicenseRule:
    label: str
    keyword: str
    pattern: str
    weight: float


def license_rules() -> list[LicenseRule]:
    """All rules in order of priority: tags first, then names as they are listed."""
    names = [[p.strip() for p in line.split(" | ")] for line in NAMES.strip().splitlines()]
    labels = dict.fromkeys(label for label, _, _ in names)
    spelled = {label: re.escape(re.sub(r"[^0-9a-z]+", " ", label)).replace(r"\ ", " ") for label in labels}
    # Longer tags first: "gpl 3 0 or later" before "gpl 3 0".
    tags = [LicenseRule(x, SPDX, f"{SPDX} {spelled[x]}(?: only)?", TAG) for x in sorted(labels, key=lambda x: (-len(spelled[x]), x))]
    version = re.compile(r"-\d")
    return tags + [LicenseRule(x, k, p.replace("VER", VER), VERSIONED if version.search(x) else NAMED) for x, k, p in names]


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split()


class Scanner:
    """Rules ready to run over texts."""

    def __init__(self, rules: Sequence[LicenseRule]):
        import ahocorasick

        self.rules = rules
        self.patterns = [re.compile(f"(?<= )(?:{r.pattern})(?= )") for r in rules]
        self.by_keyword: dict[str, list[int]] = {}
        for k, rule in enumerate(rules):
            self.by_keyword.setdefault(rule.keyword, []).append(k)
        self.automaton = ahocorasick.Automaton()
        for word in [*self.by_keyword, *PHRASES]:
            self.automaton.add_word(word, word)
        self.automaton.make_automaton()

    def scan(self, text: str) -> dict:
        """Number of words, base places, detections (label, first word, end word, weight) that stand."""
        words = words_of(text)
        line = f" {b' '.join(words).decode()} "
        held = {word for _, word in self.automaton.iter(line)}
        # Where each word begins; a word's number is the place of its start in there.
        begins = list(accumulate((len(w) + 1 for w in line[1:-1].split(" ")), initial=1)) if held else []
        base = [(bisect_left(begins, at + 1), label) for phrase, label in PHRASES.items() if phrase in held for at in _places(line, f" {phrase} ")]
        found: list[tuple[str, int, int, float]] = []
        starts: list[int] = []
        reach: list[int] = []  # the farthest end of an interval that starts here or before
        for k in sorted(k for word in held for k in self.by_keyword.get(word, ())):
            rule, fresh = self.rules[k], []
            for m in self.patterns[k].finditer(line):
                first = bisect_left(begins, m.start())
                end = first + m.group().count(" ") + 1
                at = bisect_right(starts, first)
                if not at or reach[at - 1] < end:
                    fresh.append((first, end))
            if fresh:
                found += [(rule.label, first, end, rule.weight) for first, end in fresh]
                starts, reach, far = [], [], 0
                for first, end in sorted((f, e) for _, f, e, _ in found):
                    far = max(far, end)
                    starts.append(first)
                    reach.append(far)
        return {"n_words": len(words), "base": sorted(base), "found": found}


def _places(line: str, phrase: str) -> Iterator[int]:
    at = line.find(phrase)
    while at >= 0:
        yield at
        at = line.find(phrase, at + 1)


@lru_cache(maxsize=2)
def _scanner(rules: tuple[LicenseRule, ...]) -> Scanner:
    return Scanner(rules)


SPAN = "struct<label:string,first:bigint,end:bigint,weight:double>"
_SPAN = pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("weight", pa.float64())])


def scan_licenses(docs: DataFrame, rules: Sequence[LicenseRule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_words``, ``base`` (array of label and first word), ``found`` (array of label, first, end word, weight)."""
    rules = tuple(license_rules() if rules is None else rules)
    rows = docs.select(docs[id_col], text_of(docs, text_col).alias("text"))
    id_type = rows.schema[0].dataType.simpleString()
    place = pa.struct([("label", pa.string()), ("first", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(rules)
        for batch in batches:
            got = [scanner.scan(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([g["n_words"] for g in got], pa.int64()),
                pa.array([[{"label": x, "first": at} for at, x in g["base"]] for g in got], pa.list_(place)),
                pa.array([[{"label": x, "first": a, "end": e, "weight": w} for x, a, e, w in g["found"]] for g in got], pa.list_(_SPAN)),
            ], names=[id_col, "n_words", "base", "found"])

    return rows.mapInArrow(scan, f"`{id_col}` {id_type}, n_words bigint, base array<struct<label:string,first:bigint>>, found array<{SPAN}>")
