"""License scans: notice phrases and identifier tags found in one pass over each text.

An Aho-Corasick automaton runs over the words of a text, joined by single spaces, and
finds every phrase, also overlapping ones. Where a text has identifier tags, the
expression behind each is parsed by the shunting-yard method and evaluated.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Collection, Iterable, Iterator, Mapping
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm.common import texts

# The phrases every scan looks for.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notices: phrase, label, and how sure a single place makes us.
MORE_PHRASES = {
    "gnu lesser general public license": ("lgpl", 0.9),
    "gnu affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "bsd license": ("bsd", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "permission is hereby granted free of charge": ("mit", 0.9),
    "creative commons attribution": ("cc-by", 0.8),
    "creative commons zero": ("cc0", 0.8),
    "all rights reserved": ("proprietary", 0.6),
    "public domain": ("public-domain", 0.5),
    "licensed under the": ("notice", 0.4),
}
BASE_SURE = 0.8
TAG_SURE, BROKEN_TAG_SURE = 0.95, 0.5
TAG = "spdx-license-identifier"
# Licences that a plain redistribution may carry; `permitted` is evaluated over these.
PERMISSIVE = frozenset(
    {"mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "zlib", "unlicense", "cc0-1.0", "cc-by-4.0", "0bsd"}
)

_KEEP = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_EXPRESSION = re.compile(r"[ \t]*:[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"\s*(\(|\)|[A-Za-z0-9.+:_-]+)")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


@dataclass(frozen=True)
class Licence:
    """A leaf or an operation of a parsed expression."""

    name: str
    parts: tuple[Licence, ...] = ()

    def leaves(self) -> set[str]:
        return {p.name for p in self._all() if not p.parts}

    def permitted(self, allowed: Collection[str]) -> bool:
        """`or` leaves the choice, `and` demands both, an exception only adds rights."""
        known: dict[int, bool] = {}
        for p in reversed(self._all()):
            if not p.parts:
                known[id(p)] = p.name.removesuffix("+") in allowed
            elif p.name == "with":
                known[id(p)] = known[id(p.parts[0])]
            else:
                known[id(p)] = (any if p.name == "or" else all)([known[id(q)] for q in p.parts])
        return known[id(self)]

    def _all(self) -> list[Licence]:
        """This and its parts, exceptions apart, each before its own ones; no recursion, as expressions may be long."""
        found, waiting = [], [self]
        while waiting:
            found.append(waiting.pop())
            parts = found[-1].parts
            waiting += parts[:1] if found[-1].name == "with" else parts
        return found


def parse_expression(text: str) -> Licence | None:
    """The expression at the start of `text` by shunting-yard; None if there is none.

    It ends where no further operand or operator fits. Parentheses must close, and an
    operator needs both operands.
    """
    output: list[Licence] = []
    waiting: list[str] = []
    place, operand_next, depth = 0, True, 0

    def reduce() -> bool:
        if len(output) < 2:
            return False
        right, left = output.pop(), output.pop()
        output.append(Licence(waiting.pop(), (left, right)))
        return True

    while match := _TOKEN.match(text, place):
        token = match[1].lower()
        if operand_next:
            if token in _PRECEDENCE or token == ")":
                return None
            if token == "(":
                waiting.append(token)
                depth += 1
            else:
                output.append(Licence(token))
                operand_next = False
        elif token in _PRECEDENCE:
            while waiting and _PRECEDENCE.get(waiting[-1], 0) >= _PRECEDENCE[token]:
                if not reduce():
                    return None
            waiting.append(token)
            operand_next = True
        elif token == ")" and depth:
            while waiting[-1] != "(":
                if not reduce():
                    return None
            waiting.pop()
            depth -= 1
        else:
            break  # an operand after an operand, or a parenthesis that was not opened
        place = match.end()
    if operand_next:
        return None
    while waiting:
        if waiting[-1] == "(" or not reduce():
            return None
    return output[0]


class Scanner:
    """The automaton of all phrases, and what is made of its finds."""

    def __init__(self, more: Mapping[str, tuple[str, float]] = MORE_PHRASES) -> None:
        self.base, self.more = dict(BASE_PHRASES), dict(more)
        self._automaton = None

    def __getstate__(self) -> dict:
        return {"base": self.base, "more": self.more, "_automaton": None}

    def _build(self) -> None:
        self._automaton = ahocorasick.Automaton()
        phrases = {p: ("base", label, BASE_SURE) for p, label in self.base.items()}
        phrases |= {p: ("more", *found) for p, found in self.more.items() if p not in self.base}
        phrases[TAG.replace("-", " ")] = ("tag", "", 0.0)
        for phrase, found in phrases.items():
            self._automaton.add_word(f" {phrase} ", (len(phrase) + 2, found))
        self._automaton.make_automaton()

    def scan(self, text: str) -> dict:
        """All facts about one text."""
        if self._automaton is None:
            self._build()
        words = text.encode("utf-8", "surrogatepass").translate(_KEEP).split()
        line = f" {b' '.join(words).decode('utf-8', 'replace')} "
        base_at, base_labels, labels, doubt, tagged = [], set(), set(), 1.0, False
        for end, (length, (kind, label, sure)) in self._automaton.iter(line):
            if kind == "tag":
                tagged = True
                continue
            doubt *= 1 - sure
            labels.add(label)
            if kind == "base":
                base_labels.add(label)
                base_at.append(end - length + 1)
        expressions, permitted = [], None
        if tagged:
            for part in re.split(TAG, text, flags=re.IGNORECASE)[1:]:
                match = _EXPRESSION.match(part)
                parsed = parse_expression(match[1]) if match else None
                if parsed is None:
                    doubt *= 1 - BROKEN_TAG_SURE
                    continue
                doubt *= 1 - TAG_SURE
                labels |= parsed.leaves()
                expressions.append(match[1].strip())
                permitted = parsed.permitted(PERMISSIVE) and permitted is not False
        first = last = None
        if base_at:
            # The word that starts after the k-th space has number k.
            spaces = [k for k, c in enumerate(line) if c == " "]
            first, last = (bisect_right(spaces, place) - 1 for place in (min(base_at), max(base_at)))
        return {
            "n_words": len(words),
            "n_base": len(base_at),
            "first_word": first,
            "last_word": last,
            "base_labels": ",".join(sorted(base_labels)),
            "labels": ",".join(sorted(labels)),
            "score": 1.0 - doubt,
            "expressions": expressions,
            "permitted": permitted,
        }


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        ("expressions", pa.list_(pa.string())),
        ("permitted", pa.bool_()),
    ]
)
RESULT_SQL = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string,"
    " labels string, score double, expressions array<string>, permitted boolean"
)


def scan_licenses(docs: DataFrame, more: Mapping[str, tuple[str, float]] = MORE_PHRASES) -> DataFrame:
    """One row per row of `docs` with the licence facts of its whole text.

    Words are runs of a-z (A-Z lower-cased), digits and non-ASCII characters. `n_base`
    counts all places of base phrases, `first_word` and `last_word` are the smallest and
    largest start (null without any). `labels` adds those of `more` phrases and of
    identifier tags; `expressions` are the tags' well-formed expressions and `permitted`
    says whether all of them can be met by permissive licences (null without any).
    `score` is the probability-like union of the finds, 0 without any. A null or empty
    text has no words. Rows are independent: nothing is shuffled, repeated rows give
    repeated results, an empty table gives none, other columns are ignored.
    """
    scanner = Scanner(more)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"doc_id": i.as_py()} | scanner.scan(t.as_py()) for i, t in zip(batch.column(0), batch.column(1))]
            yield from pa.Table.from_pylist(rows, schema=RESULT).to_batches()

    return texts(docs).mapInArrow(run, RESULT_SQL)
