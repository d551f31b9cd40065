"""Short license notices in texts, found with a bounded number of errors.

A notice of n characters that may have k errors (characters put in, left out or
replaced) is split into k + 1 pieces: wherever it stands with at most k errors,
one of its pieces stands unchanged. Pieces of all notices are searched for at
once (an Aho-Corasick automaton); around each piece found, a window just wide
enough for the notice is matched by the ``regex`` library with the bound on
errors, which gives the edits and the span. A place without an unchanged piece
is never looked at, one with a piece is never missed.

Texts are compared as words: A-Z become lower case, everything in ASCII that is
no letter or digit separates words, one space stands between two words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.texts import require, worker_cache


@dataclass(frozen=True)
class Notice:
    """``text``: words with one space between; ``sure``: its words that name the
    license and must stand without an error; ``exact`` adds places where the
    words stand consecutively and nothing else."""

    label: str
    text: str
    sure: tuple[str, ...] = ()
    errors: int | None = None

    @property
    def allowed(self) -> int:
        return len(self.text) // 10 if self.errors is None else self.errors


#: Phrases whose unchanged places are counted.
BASE = (
    Notice("mit", "under the mit license", ("mit",)),
    Notice("apache-2", "apache license version 2", ("2",)),
    Notice("cc-by-nc", "cc by nc", ("cc", "by", "nc")),
)
#: Notices that only the search with errors looks for, besides those of BASE.
MORE = (
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Notice("apache-2", "www apache org licenses license 2 0", ("apache", "2")),
    Notice("cc-by-nc", "creative commons attribution noncommercial", ("noncommercial",)),
    Notice("cc-by-nc", "creative commons attribution non commercial", ("non", "commercial")),
    Notice("gpl", "gnu general public license", ("gnu",)),
    Notice("lgpl", "gnu lesser general public license", ("gnu", "lesser")),
    Notice("agpl", "gnu affero general public license", ("gnu", "affero")),
    Notice("mpl", "mozilla public license", ("mozilla",)),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification"),
)

_MATCH = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("notice", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("edits", T.IntegerType()),
    ]
)
_ADDED = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")]
    + [T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType())]
    + [T.StructField("score", T.DoubleType()), T.StructField("matches", T.ArrayType(_MATCH))]
)

_WORD = np.ones(256, dtype=bool)
_WORD[:0x80] = False
_WORD[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if _WORD[b] else 32 for b in range(256))


def pieces(text: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of ``text`` with their places, of even lengths."""
    cut = [len(text) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, text[a:b]) for a, b in zip(cut, cut[1:])]


class Words:
    """The words of a text with one space between, before and after them."""

    def __init__(self, raw: bytes) -> None:
        plain = np.frombuffer(raw.translate(_PLAIN), dtype=np.uint8)
        blank = plain == 32
        first = np.append(True, blank)[: len(plain)]  # what follows a blank, or nothing
        self.kept = ~(blank & first)
        # one character a byte; places in ``text`` count the space before
        self.text = " " + plain[self.kept].tobytes().decode("latin-1").rstrip(" ") + " "
        self.starts = np.flatnonzero((first & ~blank)[self.kept])

    def __len__(self) -> int:
        return len(self.starts)

    def number(self, at: int) -> int:
        """Number of the word that begins at place ``at`` of ``text``."""
        return int(np.searchsorted(self.starts, at - 1))

    def spans(self, places: list[tuple[int, int]], raw: bytes) -> list[tuple[int, int]]:
        """Characters of the text, from the first to the one after the last, of places in ``text``."""
        at = np.flatnonzero(self.kept)
        follows = (np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80
        chars = np.cumsum(follows) - 1
        return [(int(chars[at[a - 1]]), int(chars[at[b - 2]]) + 1) for a, b in places]


class Search:
    def __init__(self, base: Sequence[Notice], more: Sequence[Notice]) -> None:
        self.base = list(base)
        self.notices = [*base, *more]
        for n in self.notices:
            if not regex.fullmatch("[a-z0-9]+( [a-z0-9]+)*", n.text) or n.allowed * 4 >= len(n.text):
                raise ValueError(f"no notice to search for with {n.allowed} errors: {n.text!r}")
        self.seeds = ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int]]] = {}
        for i, n in enumerate(self.notices):
            # the spaces around a notice are part of it only where nothing may be wrong
            text = n.text if n.allowed else f" {n.text} "
            for at, piece in pieces(text, n.allowed):
                found.setdefault(piece, []).append((i, at - (0 if n.allowed else 1)))
        for piece, where in found.items():
            self.seeds.add_word(piece, (len(piece), where))
        self.seeds.make_automaton()
        self.patterns = [
            regex.compile(f"(?b)(?<= )(?:{n.text}){{e<={n.allowed}}}(?= )") for n in self.notices
        ]

    def exact(self, words: Words) -> list[tuple[int, int]]:
        """(number of the base notice, number of the first word) of all unchanged places."""
        out = []
        for i, n in enumerate(self.base):
            wanted, at = f" {n.text} ", -1
            while (at := words.text.find(wanted, at + 1)) >= 0:
                out.append((i, words.number(at + 1)))
        return out

    def near(self, words: Words) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) of places with at most the allowed errors,
        in order; of places of one notice that overlap, the one with the fewest
        errors, of equal ones the first."""
        windows: dict[int, set[int]] = {}
        for last, (size, where) in self.seeds.iter(words.text):
            for i, at in where:
                windows.setdefault(i, set()).add(last + 1 - size - at)
        out = []
        for i, starts in windows.items():
            notice, pattern = self.notices[i], self.patterns[i]
            k, length = notice.allowed, len(notice.text)
            found = set()
            for s in starts:
                # the lookarounds see one character beyond the widest place
                m = pattern.search(words.text, max(0, s - k - 1), s + length + k + 1)
                if m and set(notice.sure) <= set(m.group().split(" ")):
                    found.add((sum(m.fuzzy_counts), m.start(), m.end()))
            kept: list[tuple[int, int, int]] = []
            taken: dict[int, list[tuple[int, int]]] = {}
            reach = length + 2 * k + 2
            for edits, start, end in sorted(found):
                near = [p for b in (-1, 0, 1) for p in taken.get(start // reach + b, [])]
                if all(end <= a or start >= z for a, z in near):
                    kept.append((edits, start, end))
                    taken.setdefault(start // reach, []).append((start, end))
            out += [(i, start, end, edits) for edits, start, end in kept]
        return sorted(out, key=lambda f: (f[1], f[2], f[0]))


def _labels(notices: Sequence[Notice]) -> str:
    return ",".join(sorted({n.label for n in notices}))


def scan_notices(
    docs: DataFrame, base: Sequence[Notice] = BASE, more: Sequence[Notice] = MORE, text: str = "text"
) -> DataFrame:
    """``docs`` with the license notices of each whole text.

    Added columns: ``n_words``; ``n_base``, ``first_word``, ``last_word`` and
    ``base_labels``: number, first and last word (from 0, else null) and labels
    of the places where the words of a ``base`` notice stand consecutively;
    ``matches``: label, notice, start and end (characters of the text) and edits
    of each place of a notice with at most its allowed errors, in their order;
    ``labels``: those of both; ``score``: 1 for an unchanged notice, less by the
    share of wrong characters for the best changed one, 0 without any.

    A null text is an empty one: no words, no labels (empty strings), score 0.
    Columns with one of these names are replaced, others stay. Rows are
    independent of each other: no shuffle, memory bounded by one text.
    """
    require(docs, text)
    docs = docs.drop(*[c for c in _ADDED.fieldNames() if c in docs.columns and c != text])
    schema = T.StructType([*docs.schema.fields, *[f for f in _ADDED if f.name != text]])
    name = "notices_" + hashlib.sha256(repr((tuple(base), tuple(more))).encode()).hexdigest()

    def one(search: Search, raw: bytes) -> dict:
        words = Words(raw)
        exact, near = search.exact(words), search.near(words)
        found = [search.notices[i] for i, *_ in near]
        best = max((1.0 - f[3] / len(n.text) for f, n in zip(near, found)), default=0.0)
        spans = words.spans([f[1:3] for f in near], raw) if near else []
        return {
            "n_words": len(words),
            "n_base": len(exact),
            "first_word": min((w for _, w in exact), default=None),
            "last_word": max((w for _, w in exact), default=None),
            "base_labels": _labels([search.base[i] for i, _ in exact]),
            "labels": _labels([search.base[i] for i, _ in exact] + found),
            "score": 1.0 if exact else best,
            "matches": [
                {"label": n.label, "notice": n.text, "start": a, "end": b, "edits": f[3]}
                for n, f, (a, b) in zip(found, near, spans)
            ],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = worker_cache(name, lambda: Search(base, more))
        out = to_arrow_schema(_ADDED)
        for batch in batches:
            texts = batch.column(text).cast(pa.string()).cast(pa.binary())
            rows = [one(search, t.as_py() or b"") for t in texts]
            added = [pa.array([r[f.name] for r in rows], f.type) for f in out if f.name != text]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.fieldNames())

    return docs.mapInArrow(run, schema)
