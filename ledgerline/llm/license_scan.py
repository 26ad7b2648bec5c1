"""Licence scan: short notices found exactly and with a bounded number of edits.

A text is lower-cased (A-Z) and reduced to its words, joined by single spaces;
words are runs of ASCII letters and digits and of all characters beyond ASCII.
Base phrases are places where their words stand consecutively. Notices are
searched fuzzily: a notice allowed k edits is cut into k + 1 pieces, of which
any occurrence holds one unchanged (pigeonhole). One Aho-Corasick automaton
finds the pieces of all notices in one pass; each hit opens the window in which
its notice could stand, windows of one notice that overlap are joined, and the
regex library's bounded-error matching decides there and gives span and edits.

Nothing is shuffled; a task holds one batch and one text's words.

Defined results: null and empty texts have no words, no places, no labels and
score 0; texts of any length are searched whole; ids may be null or repeat; an
empty table gives none; extra columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import text_of

# Base phrases and their labels.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
# Label and wording of common notices, as words.
NOTICES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "licensed under a creative commons attribution license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
EDIT_SHARE = 12     # one edit for every so many characters of a notice,
MAX_EDITS = 4       # but no more than these

_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def normal_words(text: str | None) -> list[bytes]:
    """The text's words. Bytes beyond 0x7F belong to characters beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class Scanner:
    """Phrases, pieces and patterns, compiled."""

    def __init__(self, base, notices, edit_share: int, max_edits: int):
        import ahocorasick

        self.base = [(f" {p} ".encode(), label, len(p.split())) for p, label in base]
        self.notices = []       # (label, notice, edits, pattern)
        self.pieces = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}       # piece to (notice, offset)
        for n, (label, notice) in enumerate(notices):
            edits = min(max_edits, len(notice) // edit_share)
            self.notices.append((label, notice, edits, regex.compile(f"(?e)(?:{regex.escape(notice)}){{e<={edits}}}")))
            cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:]):
                places.setdefault(notice[a:b], []).append((n, a))
        for piece, where in places.items():
            self.pieces.add_word(piece, (len(piece), where))
        if places:
            self.pieces.make_automaton()

    def exact(self, joined: bytes) -> list[tuple[str, int, int]]:
        """(label, first word, words) of every base place; ``joined`` has a
        space on both ends."""
        out = []
        for phrase, label, words in self.base:
            at = joined.find(phrase)
            while at >= 0:
                out.append((label, joined.count(b" ", 0, at), words))
                at = joined.find(phrase, at + 1)
        return sorted(out, key=lambda x: (x[1], x[0]))

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Per notice the joined windows in which it could stand."""
        out: dict[int, list[list[int]]] = {}
        if not self.notices:
            return out
        for last, (size, where) in self.pieces.iter(text):
            for n, offset in where:
                _, notice, edits, _ = self.notices[n]
                start = last + 1 - size - offset
                lo, hi = max(start - edits, 0), min(start + len(notice) + edits, len(text))
                seen = out.setdefault(n, [])
                if seen and lo <= seen[-1][1]:      # hits of a notice come in order but for its offsets
                    seen[-1][0], seen[-1][1] = min(lo, seen[-1][0]), max(hi, seen[-1][1])
                else:
                    seen.append([lo, hi])
        return {n: _joined(w) for n, w in out.items()}

    def fuzzy(self, text: str) -> list[tuple[str, str, int, int, int]]:
        """(label, notice, start, end, edits) of the matches, in characters of ``text``."""
        out = []
        for n, windows in self.windows(text).items():
            label, notice, _, pattern = self.notices[n]
            for lo, hi in windows:
                out += [(label, notice, m.start(), m.end(), sum(m.fuzzy_counts))
                        for m in pattern.finditer(text, lo, hi)]
        return sorted(out, key=lambda x: (x[2], x[0], x[1]))


def _joined(windows: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(windows):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def settled(matches: list[tuple[str, str, int, int, int]]) -> list[tuple[str, str, int, int, int]]:
    """Where matches of different labels overlap, those with more edits than
    another one go: one wording is near to several notices."""
    near: list[int] = []        # earlier matches that may still overlap
    lost = set()
    for i, m in enumerate(matches):     # by start; a match overlaps few others, its length being bounded
        near = [j for j in near if matches[j][3] > m[2]]
        for j in near:
            o = matches[j]
            if o[0] != m[0] and o[4] != m[4]:
                lost.add(i if m[4] > o[4] else j)
        near.append(i)
    return [m for i, m in enumerate(matches) if i not in lost]


@functools.lru_cache(maxsize=4)
def scanner(base=BASE, notices=NOTICES, edit_share: int = EDIT_SHARE, max_edits: int = MAX_EDITS) -> Scanner:
    """One per worker and setting."""
    return Scanner(base, notices, edit_share, max_edits)


def scan_licenses(df: DataFrame, id_col="doc_id", text_col="text", base=BASE, notices=NOTICES,
                  edit_share: int = EDIT_SHARE, max_edits: int = MAX_EDITS) -> DataFrame:
    """One row per input row: id, n_words; places (array of label, word,
    words: the base phrases, by word); matches (array of label, notice, word,
    words, edits, span: the notices, by start, with the words they touch; of
    overlapping ones with different labels those with fewest edits);
    score: 1 for a text with a base place, else the best match's share of
    characters without an edit, 0 for none."""
    id_type = df.schema[id_col].dataType.simpleString()
    schema = (f"id {id_type}, n_words long, places array<struct<label: string, word: long, words: long>>, "
              "matches array<struct<label: string, notice: string, word: long, words: long, edits: int, span: string>>, "
              "score double")
    place = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("words", pa.int64())]))
    match = pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("word", pa.int64()),
                                ("words", pa.int64()), ("edits", pa.int32()), ("span", pa.string())]))

    def one(scan: Scanner, text: str | None):
        words = normal_words(text)
        joined = b" ".join(words)
        places = [dict(zip(("label", "word", "words"), p)) for p in scan.exact(b" " + joined + b" ")]
        chars = joined.decode("utf-8", "surrogatepass")
        matches, score = [], 1.0 if places else 0.0
        for label, notice, start, end, edits in settled(scan.fuzzy(chars)):
            score = max(score, 1 - edits / len(notice))
            span = chars[start: end]
            matches.append({"label": label, "notice": notice,
                            "word": chars.count(" ", 0, start) + (len(span) - len(span.lstrip(" "))),
                            "words": len(span.split()), "edits": edits, "span": span})
        return len(words), places, matches, score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(base, notices, edit_share, max_edits)
        for batch in batches:
            if batch.num_rows:
                n, places, matches, scores = zip(*(one(scan, batch.column(1)[i].as_py()) for i in range(batch.num_rows)))
                yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(places, place),
                                       pa.array(matches, match), pa.array(scores, pa.float64())],
                                      names=["id", "n_words", "places", "matches", "score"])

    return df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, schema)
