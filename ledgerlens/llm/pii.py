"""Personal data by fixed patterns and a semi-Markov conditional random field.

Base spans follow fixed patterns. The field adds spans that are written in other ways: it cuts
a region of tokens into segments, scores whole segments by features of the whole span (digits,
separators, checksum, shape, what stands before), and finds the best cut and types jointly by
dynamic programming over entities of at most `LONGEST` tokens. It is trained on a bounded sample
of documents (`SAMPLE_DOCS`, drawn by hash): base spans are its labels, everything else there is
none, and rewritten base spans teach it the other ways of writing.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import beside, slices, whole

KINDS = ("email", "ip", "card", "phone")
LONGEST, EPOCHS, RATE, DECAY, MARGIN = 14, 6, 0.3, 0.002, 1.0
# Bounds of the sample that the field is fitted on.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_TOKENS = 400, 2000, 200
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match that fails at the start of a run of digits fails everywhere in it.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DATE = re.compile(r"(?<![0-9])(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9](?![0-9])")
DIGIT = re.compile("[0-9]")

Span = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def is_ip(text: str) -> bool:
    # int() refuses thousands of digits, zeros included.
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (part.lstrip("0") for part in text.split(".")))


def is_card(text: str) -> bool:
    digits = only_digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches: at each @ the run before it, back to the last match, and the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end(), 0
            done = m.end()
        # The next local part can't reach over this @.
        done = max(done, at + 1)
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    found = list(emails(text)) if "@" in text else []
    if DIGIT.search(text):
        found += [(m.start(), m.end(), 1) for m in IP.finditer(text) if is_ip(m[0])]
        found += [(m.start(), m.end(), 2) for m in CARD.finditer(text) if is_card(m[0])]
        found += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 9 <= len(only_digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


# Stretches that may hold an entity: words with a digit or an @, and what joins them.
WORD = re.compile(r"\S+")
HOLDS = re.compile(r"[0-9@]")


def regions(text: str) -> Iterator[tuple[int, int]]:
    """The stretches of neighbouring words with a digit or an @ in each, one space between
    them. Every character is looked at a bounded number of times."""
    start = end = -1
    for m in WORD.finditer(text):
        if not HOLDS.search(text, m.start(), m.end()):
            continue
        if end >= 0 and m.start() == end + 1 and text[end] == " ":
            end = m.end()
            continue
        if end >= 0:
            yield start, end
        start, end = m.start(), m.end()
    if end >= 0:
        yield start, end


TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)
FEATURES = (
    "bias", "at", "at_dot", "digits_7_8", "digits_9_11", "digits_12_15", "digits_16_19", "digits_more", "luhn", "dotted4",
    "plus", "paren", "letters", "long_letters", "seps_even", "many_seps", "joined_before", "joined_after", "spaces", "colon_before", "hyphens", "other_signs")


def features(text: str, start: int, end: int) -> list[float]:
    """The whole span's features; text is the region's line."""
    span = text[start:end]
    digits = only_digits(span)
    n = len(digits)
    letters = sum(c.isalpha() for c in span)
    seps = sum(c in " -.()" for c in span)
    before, after = text[start - 1: start], text[end: end + 1]
    local, _, domain = span.partition("@")
    groups = re.split(r"[^0-9]+", span.strip("+()"))
    even = len(groups) > 2 and len({len(g) for g in groups[:-1]}) == 1
    return [
        1.0, float("@" in span), float(bool(local) and bool(DOMAIN.fullmatch(domain))), float(7 <= n <= 8), float(9 <= n <= 11),
        float(12 <= n <= 15), float(16 <= n <= 19), float(n > 19), float(12 <= n <= 19 and luhn(digits)),
        float(bool(IP.fullmatch(span)) and is_ip(span)), float(span[0] == "+"), float("(" in span and ")" in span),
        float("@" not in span and letters > 0), min(letters, 20) / 20, float(even), min(seps, 6) / 6,
        float(before.isalnum() or before in ("@", ".", "-", "+") and before != ""),
        float(after.isalnum() or after == "@"), float(" " in span), float(text[max(0, start - 2):start].strip()[-1:] in (":", "=")),
        float("-" in span), float(sum(not (c.isalnum() or c in " -.()+@_%") for c in span) > 0)]


def candidates(text: str, start: int, end: int) -> tuple[list[int], list[tuple[int, int, list[float]]]]:
    """Token borders of a region, and the segments worth a score: (first border, last border,
    features). A segment starts and ends on a digit, a letter, + or ( and holds an @ or seven
    digits; no other can be an entity."""
    borders = [start, *(m.end() for m in TOKEN.finditer(text, start, end))]
    out = []
    for i in range(len(borders) - 1):
        if not (text[borders[i]].isalnum() or text[borders[i]] in "+("):
            continue
        digits, sign = 0, False
        for j in range(i + 1, min(i + LONGEST, len(borders) - 1) + 1):
            piece = text[borders[j - 1]:borders[j]]
            digits += len(piece) if "0" <= piece[0] <= "9" else 0
            sign |= piece == "@"
            if text[borders[j] - 1].isalnum() and (digits >= 7 or sign or digits >= 4 and "." in text[borders[i]:borders[j]]):
                out.append((i, j, features(text, borders[i], borders[j])))
    return borders, out


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """What spans cover, as stretches in order that do not touch."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def overlaps(stretches: list[tuple[int, int]], ends: list[int], s: int, e: int) -> bool:
    at = bisect_right(ends, s)
    return at < len(stretches) and stretches[at][0] < e


def best(weights: np.ndarray, n: int, segments: list) -> list[tuple[int, int, int, float]]:
    """Viterbi over n tokens: segments (first, last border, kind, score) of the best cut; a
    token outside of entities scores nothing."""
    if not segments:
        return []
    scores = np.array([s[2] for s in segments]) @ weights.T
    score, back = [0.0] * (n + 1), [None] * (n + 1)
    by_end: dict[int, list[int]] = {}
    for k, s in enumerate(segments):
        by_end.setdefault(s[1], []).append(k)
    for j in range(1, n + 1):
        score[j] = score[j - 1]
        for k in by_end.get(j, ()):
            kind = int(np.argmax(scores[k]))
            value = score[segments[k][0]] + float(scores[k][kind])
            if value > score[j]:
                score[j], back[j] = value, (k, kind)
    out, j = [], n
    while j > 0:
        if back[j] is None:
            j -= 1
        else:
            k, kind = back[j]
            out.append((segments[k][0], j, kind, float(scores[k][kind])))
            j = segments[k][0]
    return out[::-1]


def gradient(weights: np.ndarray, n: int, segments: list, gold: dict[tuple[int, int], int]) -> np.ndarray:
    """Of the log-likelihood of the gold cut: observed minus expected features."""
    x = np.array([s[2] for s in segments])
    scores = x @ weights.T
    starts, ends = [s[0] for s in segments], [s[1] for s in segments]
    total = np.logaddexp.reduce(scores, axis=1)
    fore, aft = np.full(n + 1, -math.inf), np.full(n + 1, -math.inf)
    fore[0] = aft[n] = 0.0
    into, out_of = {}, {}
    for k in range(len(segments)):
        into.setdefault(ends[k], []).append(k)
        out_of.setdefault(starts[k], []).append(k)
    for j in range(1, n + 1):
        fore[j] = np.logaddexp.reduce([fore[j - 1], *(fore[starts[k]] + total[k] for k in into.get(j, ()))])
    for i in range(n - 1, -1, -1):
        aft[i] = np.logaddexp.reduce([aft[i + 1], *(aft[ends[k]] + total[k] for k in out_of.get(i, ()))])
    p = np.exp(fore[starts][:, None] + scores + aft[ends][:, None] - fore[n])
    seen = np.zeros_like(p)
    for k, s in enumerate(segments):
        if (s[0], s[1]) in gold:
            seen[k, gold[s[0], s[1]]] = 1.0
    return (seen - p).T @ x


def rewritten(span: str, kind: int) -> list[str]:
    """Other ways of writing an entity."""
    digits = only_digits(span)
    if kind == 3 and len(digits) >= 10:
        d = digits[-10:]
        return [f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}"]
    if kind == 2:
        return [".".join(digits[i:i + 4] for i in range(0, len(digits), 4))]
    return []


def fit(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Weights (kinds x features) from a bounded sample: of the SAMPLE_DOCS texts with the
    smallest hashes among those that hold a digit or an @, the SAMPLE_CHARS characters around
    the first one; regions of more than SAMPLE_TOKENS tokens are left out. Only hashes are
    ranked, equal ones once, so what reaches the driver does not follow the corpus."""
    first = F.regexp_instr("_text", F.lit("[0-9@]"))
    holds = docs.select(whole(text_col).alias("_text")).withColumn("_at", first).filter("_at > 0")
    around = F.substring("_text", F.greatest(F.col("_at") - SAMPLE_CHARS // 4, F.lit(1)), F.lit(SAMPLE_CHARS))
    hashed = holds.select(F.xxhash64("_text").alias("_hash"), around.alias("_around"))
    ranked = hashed.select("_hash").groupBy("_hash").count().orderBy("_hash").select("_hash").limit(SAMPLE_DOCS).collect()
    last = ranked[-1][0] if ranked else 0
    rows = hashed.filter(F.col("_hash") <= F.lit(last)).groupBy("_hash").agg(F.min("_around").alias("_around")).orderBy("_hash").select("_around")
    cases = []
    for (text,) in rows.collect():
        base = base_spans(text)
        texts = [(text, {(s, e): k for s, e, k in base})]
        for s, e, k in base:
            for other in rewritten(text[s:e], k):
                before = text[max(0, s - 10):s]
                texts.append((before + other + text[e:e + 10], {(len(before), len(before) + len(other)): k}))
        for t, gold in texts:
            for start, end in regions(t):
                borders, segments = candidates(t, start, end)
                at = {b: i for i, b in enumerate(borders)}
                own = {(at[s], at[e]): k for (s, e), k in gold.items() if s in at and e in at}
                if segments and len(borders) <= SAMPLE_TOKENS:
                    cases.append((len(borders) - 1, segments, own))
    weights = np.zeros((len(KINDS), len(FEATURES)))
    weights[:, 0] = -2.0
    order = np.random.default_rng(0)
    for epoch in range(EPOCHS):
        for i in order.permutation(len(cases)):
            weights += RATE / (1 + epoch) * (gradient(weights, *cases[i]) - DECAY * weights)
    return weights


def valid(text: str, kind: int) -> bool:
    """What no reading of a kind may break, however it is written."""
    digits = only_digits(text)
    return (text.count("@") == 1 if kind == 0 else is_ip(text) and text.count(".") == 3 and digits != "" if kind == 1
            else is_card(text) if kind == 2
            else 9 <= len(digits) <= 15 and all(c in "+() .-" or "0" <= c <= "9" for c in text) and not DATE.search(text))


def added_spans(weights: np.ndarray, text: str, base: list[Span]) -> list[Span]:
    """What the field finds beside the base spans."""
    out = []
    if "@" not in text and not DIGIT.search(text):
        return out
    covered = merged((s, e) for s, e, _ in base)
    ends = [e for _, e in covered]
    for start, end in regions(text):
        borders, segments = candidates(text, start, end)
        for i, j, kind, score in best(weights, len(borders) - 1, segments):
            s, e = borders[i], borders[j]
            shape = re.fullmatch(r"[0-9.]+", text[s:e]) if kind == 1 else True
            if score >= MARGIN and shape and valid(text[s:e], kind) and not overlaps(covered, ends, s, e):
                out.append((s, e, kind))
    return out


COLUMNS = "n_email long, n_ip long, n_card long, n_phone long, base string, spans string"


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, counts of base spans by kind, `base` (all base spans) and `spans` (those of the field
    too), each kind:start:end by start, then kind, comma-joined, in code points.

    Null counts as empty. Rows are treated one by one: repeated ones repeat, other columns are
    not read, an empty table gives none. Base spans of different kinds may overlap; added ones
    overlap none. Memory: one slice of texts, or one text, and the tokens of one region.
    """
    weights = fit(docs, text_col)

    def told(spans: list[Span]) -> str:
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text"):
            counts, base_told, all_told = [], [], []
            for text in b["_text"].to_pylist():
                base = base_spans(text)
                counts.append([sum(k == kind for _, _, k in base) for kind in range(len(KINDS))])
                base_told.append(told(base))
                all_told.append(told(base + added_spans(weights, text, base)))
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [b[id_col], *columns, pa.array(base_told, pa.string()), pa.array(all_told, pa.string())],
                [id_col, "n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    return docs.select(id_col, whole(text_col).alias("_text")).mapInArrow(run, beside(docs, id_col, COLUMNS))


def pii_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, the counts of the four kinds, base_sha256 and spans.

    A null or empty text, or one without personal data, has zeros, the digest of nothing and no
    spans. Repeated rows and null ids are rows like any other; other columns are not read; an
    empty table gives none.
    """
    found = personal_data(docs, id_col, text_col)
    return found.select(id_col, "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")
