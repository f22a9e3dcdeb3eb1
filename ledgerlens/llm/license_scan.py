"""License scans by ordered signature rules.

Each licence has a rule for its name, for a notice that grants under that name, and for an
SPDX tag, and some have rules for passages and addresses: some four hundred regular
expressions over the words of a text joined by single spaces. A rule runs only on texts that
hold its keyword, found by plain substring search. Detections are ordered by priority, then
length, then rule; one whose interval lies within that of an earlier detection is suppressed.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlens.llm.common import LOWER_BYTES, PLAIN_WORD, beside, slices, whole
from ledgerlens.llm.license_rules import NAMES, PASSAGES

# Phrases and labels that always count.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
GRANT = r"(?:licen[cs]ed|released|distributed|available|published|covered|provided)(?: to you)? (?:under|by)(?: the)?(?: terms of(?: the)?)?"
SCORES = {"tag": 1.0, "passage": 0.95, "notice": 0.9, "name": 0.6}
ORDER = ("tag", "passage", "notice", "name")
WORDS = re.compile(PLAIN_WORD)


class Rule(NamedTuple):
    label: str
    kind: str
    keyword: str
    pattern: re.Pattern


def _rows(text: str) -> list[tuple[str, str, str]]:
    return [tuple(p.strip() for p in line.split(" | ", 2)) for line in text.strip().splitlines()]


def rules() -> list[Rule]:
    """All rules in order. A pattern matches whole words of the joined text."""
    found: dict[tuple[str, str], tuple[str, str]] = {}
    for label, keyword, name in _rows(NAMES):
        ident = label.replace("-", " ").replace(".", " ")
        for kind, pattern in (("notice", f"{GRANT} (?:a )?(?:{name})"), ("name", name), ("tag", f"spdx license identifier {ident}")):
            key = (kind, pattern)
            found.setdefault(key, (label, "spdx" if kind == "tag" else keyword))
    for label, keyword, passage in _rows(PASSAGES):
        found.setdefault(("passage", passage), (label, keyword))
    made = [Rule(label, kind, keyword, re.compile(rf"(?<= )(?:{pattern})(?= )"))
            for (kind, pattern), (label, keyword) in found.items()]
    return sorted(made, key=lambda r: ORDER.index(r.kind))


class Detection(NamedTuple):
    start: int
    end: int
    kind: int
    rule: int


def resolve(found: list[Detection]) -> list[Detection]:
    """Drops detections whose interval lies within that of one that comes first: by kind, then
    the longer one, then the earlier rule. Sweeping from left to right, the furthest end of
    each kind so far tells; the kinds are four, so it takes n log n steps."""
    kept, furthest = [], {}
    for d in sorted(found, key=lambda d: (d.start, -d.end, d.kind, d.rule)):
        if not any(kind <= d.kind and end >= d.end for kind, end in furthest.items()):
            kept.append(d)
            furthest[d.kind] = d.end
    # One of a better kind that starts where a kept one does, or later, may still hold it.
    final, best = [], []
    for d in sorted(kept, key=lambda d: (d.end, -d.start), reverse=True):
        if not any(kind < d.kind and start <= d.start for kind, start in best):
            final.append(d)
        best = [(d.kind, d.start), *[b for b in best if b[0] != d.kind or b[1] < d.start]][:8]
    return sorted(final)


class Scanner:
    def __init__(self) -> None:
        self.rules = rules()
        self.by_keyword: dict[str, list[int]] = defaultdict(list)
        for i, r in enumerate(self.rules):
            self.by_keyword[r.keyword].append(i)

    def gated(self, lowered: str) -> list[int]:
        """The rules whose keyword the text holds."""
        return sorted(i for keyword, own in self.by_keyword.items() if keyword in lowered for i in own)

    def scan(self, lowered: str, active: list[int]) -> dict:
        words = WORDS.findall(lowered)
        joined = " " + " ".join(words) + " "
        starts = np.cumsum([1] + [len(w) + 1 for w in words])

        def word(at: int) -> int:
            return int(np.searchsorted(starts, at))

        base, base_labels = [], set()
        for phrase, label in BASE.items():
            here = [word(m.start()) for m in re.finditer(rf"(?<= ){phrase}(?= )", joined)]
            base += here
            base_labels |= {label} if here else set()
        hits = [Detection(m.start(), m.end(), ORDER.index(self.rules[i].kind), i)
                for i in active for m in self.rules[i].pattern.finditer(joined)]
        kept = resolve(hits)
        labels = base_labels | {self.rules[d.rule].label for d in kept}
        score = max([SCORES[ORDER[d.kind]] for d in kept] + [SCORES["name"]] * bool(base), default=0.0)
        return {
            "n_base": len(base), "first_word": min(base, default=None), "last_word": max(base, default=None),
            "base_labels": ",".join(sorted(base_labels)), "labels": ",".join(sorted(labels)), "score": score,
            "spans": [{"label": self.rules[d.rule].label, "kind": ORDER[d.kind], "start": word(d.start), "end": word(d.end + 1)}
                      for d in kept]}


NOTHING = {"n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "spans": []}
IN_WORD = np.array([chr(b).isalnum() or b >= 128 for b in range(256)])


def count_words(data: bytes) -> int:
    """Words of lower-cased UTF-8: runs of digits, letters and bytes above 127."""
    inside = IN_WORD[np.frombuffer(data, np.uint8)]
    return int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())


COLUMNS = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
           "spans array<struct<label:string,kind:string,start:int,end:int>>")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans (kept
    detections: label, kind, first word, word after the last), per row of docs.

    A-Z is lower-cased and words are those of `PLAIN_WORD`; null counts as empty. score is that
    of the strongest detection. Rows are treated one by one: repeated ones repeat, other columns
    are not read, an empty table gives none. Memory: one slice of texts, or one text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
            [("label", pa.string()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))]
        for b in slices(batches, "_text"):
            out = []
            for text in b["_text"].to_pylist():
                data = text.encode().translate(LOWER_BYTES)
                lowered = data.decode()
                active = scanner.gated(lowered)
                # Every base phrase holds a keyword of a rule, so nothing is lost here.
                out.append({"n_words": count_words(data), **(scanner.scan(lowered, active) if active else NOTHING)})
            names = list(out[0])
            yield pa.RecordBatch.from_arrays(
                [b[id_col], *[pa.array([o[n] for o in out], k) for n, k in zip(names, kinds, strict=True)]], [id_col, *names])

    return docs.select(id_col, whole(text_col).alias("_text")).mapInArrow(run, beside(docs, id_col, COLUMNS))
