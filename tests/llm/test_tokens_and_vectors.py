"""Packing, token alignment and whitening on awkward rows, against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import fast_encoding, packing, token_alignment, whitening
from ledgerlens.llm.bpe import byte_symbols
from ledgerlens.llm.queries import piece_model_path, tokenizer_path

SCHEMA = "doc_id long, text string, start long, length string, slice int, pair string, sequence_id long"
ODD = ["a", "b", " ", "  ", "\n", "\t", "　", "\xa0", " ", "<|endoftext|>", "é", "ß", "'s", "1", "中", "😀", "▁", "<0x41>", "\x85", "\x1c", "the", "</s>", "x" * 30, "=-" * 40]
LONG = "🇩🇪" * 300 + "x" * 30000 + " " * 500 + "中" * 200


def odd_texts(n, seed=3):
    draw = random.Random(seed)
    return ["".join(draw.choices(ODD, k=draw.randint(0, 12))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(odd_texts(300))] + [
        (None, None), (5, None), (6, ""), (7, " "), (None, "abc"), (8, "abc"), (8, "abc"), (400, LONG), (401, "a word " * 9000)]
    return spark.createDataFrame([(d, t, 1, "x", 2, "y", 3) for d, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def library(special):
    made = Tokenizer.from_file(tokenizer_path())
    made.encode_special_tokens = not special
    return made


@pytest.mark.parametrize("special", [True, False])
def test_fast_encoding_equals_the_library(special):
    texts = [*odd_texts(5000, 8), LONG, "", " ", " " * 40000, "y" * 50000]
    want = [e.ids for e in library(special).encode_batch(texts, add_special_tokens=False)]
    ids, bounds = fast_encoding.ByteLevel(tokenizer_path(), special)(pa.array(texts))
    assert [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:])] == want


def test_piece_model_equals_the_library_where_it_spells_the_text():
    texts = [t for t in odd_texts(5000, 9) if "▁" not in t]
    model = fast_encoding.PieceModel(piece_model_path())
    want = model.model.encode(texts)
    ids, bounds = model(fast_encoding.Pieces(pa.array([" " + t for t in texts])))
    got = [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:])]
    # The library drops the space it adds to an empty text.
    assert [g for g, t in zip(got, texts) if t] == [w for w, t in zip(want, texts) if t]


def test_cut_covers_each_document_once():
    lengths = np.array([1, 2047, 2048, 2049, 5000, 3, 4096])
    doc, start, length = packing.cut(lengths)
    for d, n in enumerate(lengths):
        mine = np.flatnonzero(doc == d)
        assert start[mine].tolist() == np.concatenate([[0], np.cumsum(length[mine])[:-1]]).tolist()
        assert length[mine].sum() == n
    assert all(x & (x - 1) == 0 and x <= 2048 for x in length.tolist())


@pytest.mark.parametrize("capacity", [1, 16, 2048])
def test_packing_keeps_every_id_and_pads_none(docs, capacity):
    rows = packing.pack(docs, tokenizer_path(), capacity=capacity).collect()
    tokenizer = library(True)
    want = Counter((d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1]))
                   for d, t in docs.select("doc_id", "text").collect())
    by_doc = {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]
        by_doc.setdefault(r["doc_id"], []).append(r)
    for d, mine in by_doc.items():
        texts = [ids for (i, ids), k in want.items() if i == d for _ in range(k)]
        assert sum(r["length"] for r in mine) == sum(map(len, texts))
        if len(texts) == 1:
            at = b"".join(r["ids"] for r in sorted(mine, key=lambda r: r["start"]))
            assert np.frombuffer(at, "<u4").tolist() == list(texts[0])
            assert {r["doc_tokens"] for r in mine} == {len(texts[0])}
    fill = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= capacity and n & (n - 1) == 0 for n in fill.values())


def test_packing_digests_and_empty_table(docs, nothing):
    got = packing.packing_digests(docs.where("doc_id = 401"), tokenizer_path()).orderBy("start").collect()
    ids = library(True).encode("a word " * 9000, add_special_tokens=False).ids + [1]
    assert [r["ids_crc32"] for r in got] == [
        zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) for r in got]
    assert packing.packing_digests(nothing, tokenizer_path()).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, tokenizer_path(), capacity=1000)


def aligned_by_hand(text):
    symbols, model, tokenizer = byte_symbols(), aligned_by_hand.model, aligned_by_hand.tokenizer
    a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    spell_a = [bytes(symbols[c] for c in tokenizer.id_to_token(i)) for i in a]
    spell_b = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not text or not b"".join(spell_a) == b"".join(spell_b) == (" " + text).encode():
        return []
    groups, mine, at = [], ([], []), [0, 0]
    i = j = 0
    while i < len(a) or j < len(b):
        if at[0] <= at[1]:
            mine[0].append(a[i])
            at[0] += len(spell_a[i])
            i += 1
        else:
            mine[1].append(b[j])
            at[1] += len(spell_b[j])
            j += 1
        if at[0] == at[1]:
            groups.append(mine)
            mine = ([], [])
    return groups


aligned_by_hand.tokenizer = library(False)
aligned_by_hand.model = sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


@pytest.mark.parametrize("size", [500, 8 << 20])
def test_alignment_equals_brute_force(docs, size, monkeypatch):
    monkeypatch.setattr(token_alignment, "SLICE", size)
    counts, groups = Counter(), []
    for d, t in docs.select("doc_id", "text").collect():
        found = aligned_by_hand(t or "")
        groups.append((d, found))
        counts.update({(x, y) for g in found for x in g[0] for y in g[1]})
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    want = Counter()
    for d, found in groups:
        links = [(x, y) for g in found for x in g[0] for y in g[1]]
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in found)
        want[d, sum(len(x) for x, _ in found), sum(len(y) for _, y in found), len(found), len(links),
             sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(written.encode()).hexdigest() if found else ""] += 1
    got = token_alignment.alignment_digests(docs, tokenizer_path(), piece_model_path())
    assert Counter(map(tuple, got.collect())) == want
    aligned = token_alignment.aligned_slices(docs, tokenizer_path(), piece_model_path())
    table = {(r["a_id"], r["b_id"]): (r["n_docs"], r["best"]) for r in token_alignment.link_counts(aligned).collect()}
    assert table == {p: (n, n == best[p[0]]) for p, n in counts.items()}


def test_alignment_of_an_empty_table(nothing):
    assert token_alignment.alignment_digests(nothing, tokenizer_path(), piece_model_path()).collect() == []


VECTORS = "vec_id long, embedding array<float>, component string, n string, index int, _index int"


def vectors(spark, rows):
    as_floats = lambda v: v and [c if c is None else float(c) for c in v]
    return spark.createDataFrame([(i, as_floats(v), "x", "y", 1, 2) for i, v in rows], VECTORS)


def test_whitening_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 8)
    draw = np.random.default_rng(4)
    data = (draw.normal(size=(150, 6)) * [1, 2, 3, 4, 5, 6] + 100).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    bad = [(900, None), (901, [1.0, None, 1, 1, 1, 1]), (902, [math.nan] * 6), (903, [math.inf, 1, 1, 1, 1, 1]), (904, []), (905, [1.0, 2.0])]
    rows += [rows[3], (None, rows[4][1])]
    kept = np.array([v for _, v in rows])
    got = whitening.whitening(vectors(spark, rows + bad), components=4).toPandas()
    x = np.floor(64 * kept).astype(int) + 1_000_000
    n, s = len(x), x.sum(0)
    centred = x - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    want = centred @ axes[:, ::-1][:, :4] / np.sqrt(values[::-1][:4])
    assert len(got) == 4 * n and set(got["n"]) == {n} and got["identity_error"].nunique() == 1
    assert got["identity_error"][0] < 1e-9
    deviation = {i: int(((n * r - s) ** 2).sum()) for (i, _), r in zip(rows, x)}
    assert all(deviation[None if math.isnan(i) else int(i)] == d for i, d in zip(got["vec_id"], got["deviation"]))
    for c in range(4):
        mine = got[got["component"] == c + 1]
        assert abs(mine["explained"].iloc[0] - values[::-1][c] / values.sum()) < 1e-9
        single = mine[mine["vec_id"] == 7]["whitened"].iloc[0]
        assert min(abs(single - want[7, c]), abs(single + want[7, c])) < 1e-7
        assert abs((mine["whitened"] ** 2).mean() - 1) < 1e-9


def test_whitening_of_few_or_equal_vectors(spark):
    assert whitening.whitening(vectors(spark, [(1, None)])).collect() == []
    assert whitening.whitening(vectors(spark, [])).collect() == []
    one = whitening.whitening(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(one) == 4 and all(r["whitened"] is None and r["deviation"] == 0 and r["explained"] is None and r["identity_error"] is None for r in one)
    line = whitening.whitening(vectors(spark, [(i, [float(i), 2.0 * i]) for i in range(9)])).orderBy("component", "vec_id").collect()
    assert all(r["whitened"] is None for r in line[9:]) and all(r["whitened"] is not None for r in line[:9])
    far = whitening.whitening(vectors(spark, [(1, [3e38, 1.0]), (2, [-3e38, 1.0])])).where(F.col("component") == 1).collect()
    assert {r["deviation"] for r in far} == {None}


def thue_morse(n, a, b):
    out = [0]
    while len(out) < n:
        out += [1 - x for x in out]
    return "".join((a, b)[x] for x in out[:n])


def removed_by_hand(texts):
    from collections import defaultdict

    places = defaultdict(list)
    raw = [t.encode() for t in texts]
    for i, t in enumerate(raw):
        for p in range(len(t) - 399):
            places[t[p:p + 400]].append((i, p))
    gone = [set() for _ in raw]
    for found in places.values():
        if len(found) > 1:
            for i, p in found:
                gone[i].update(range(p, p + 400))
    return [len(g) for g in gone]


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_suffix_dedup_on_alternating_texts_null_and_repeated_ids(spark, partitions):
    from ledgerlens.llm import suffix_dedup

    draw = random.Random(1)
    own = ["".join(draw.choice("abcdefgh ") for _ in range(700)) for _ in range(6)]
    texts = [thue_morse(768, "a", "b"), thue_morse(768, "b", "a")[::-1].replace("a", "c"), thue_morse(768, "c", "d"), own[0] + own[1][:450], own[1] + own[2], own[2][100:], own[3],
             own[4], own[4], "x" * 900]
    ids = [None, None, None, None, 7, 7, None, 9, 9, 10]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        docs = spark.createDataFrame([(i, t) for i, t in zip(ids, texts)], "doc_id long, text string")
        got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix_dedup.suffix_digests(docs).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == Counter((i, len(t), g) for i, t, g in zip(ids, texts, removed_by_hand(texts)))


def test_personal_data_in_long_texts_takes_time_in_proportion():
    import re
    import time

    from ledgerlens.llm import pii

    old = re.compile(r"[^\s]*[0-9@][^\s]*(?:[ ][^\s]*[0-9@][^\s]*)*")
    draw = random.Random(2)
    for _ in range(3000):
        text = "".join(draw.choice("ab1@ \n\t　") for _ in range(draw.randrange(30)))
        assert list(pii.regions(text)) == [m.span() for m in old.finditer(text)]
    began = time.time()
    assert list(pii.regions("漢" * 1_000_000 + " a1")) == [(1_000_001, 1_000_003)]
    weights = np.zeros((len(pii.KINDS), len(pii.FEATURES)))
    assert len(pii.base_spans("a@b.cc " * 20_000)) == 20_000
    assert pii.added_spans(weights, "a@b.cc " * 20_000, pii.base_spans("a@b.cc " * 20_000)) == []
    assert time.time() - began < 20


def test_words_that_one_checksum_takes_for_equal_are_apart():
    from ledgerlens.llm import near_dedup

    assert near_dedup.shingles("ytyauqyid", {})[0] != near_dedup.shingles("pfnxpvlja", {})[0]


def test_a_stage_of_the_pipeline_removes_the_tables_of_the_one_before(spark, docs):
    import corpus_pipeline
    from ledgerlens.llm import common
    from ledgerlens.sources.files import exists

    rows = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    stages = dict(corpus_pipeline.STAGES)
    first = common.table(stages["exact_dedup"](spark, rows, ""), "first")
    held = list(corpus_pipeline._left_over)
    assert held and all(exists(spark, p) for p in held)
    assert stages["mixing"](spark, first, "").columns == rows.columns
    assert not any(exists(spark, p) for p in held)
