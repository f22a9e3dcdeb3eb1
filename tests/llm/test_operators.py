"""Each operator on awkward rows, against brute force where it has an exact answer."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlens.llm import (
    bpe,
    chunks,
    common,
    exact_dedup,
    fast_encoding,
    license_scan,
    mixing,
    near_dedup,
    pii,
    quality,
    suffix_dedup,
    token_files,
    wrappers,
)
from ledgerlens.llm.queries import ORACLES, QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n_words string, _node int, taken int"


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice("the sun rises over old hills and rivers run to seas while birds sing of far lands".split()) + str(draw.randrange(40)) for _ in range(n))


def texts():
    base, passage = prose(1, 220), prose(2, 90)
    words = base.split()
    near = " ".join(w if i not in (50, 140) else "changed" for i, w in enumerate(words))
    rows = [
        base, base, base.upper(), near, None, "", "   \n\t ", "a", "Ünïcode Straße É é 漢字 😀 <|endoftext|> x",
        prose(3, 60) + " " + passage + " " + prose(4, 60), passage + " " + prose(5, 80), prose(6, 8000), "word " * 3000,
        "x" * 1500, "Released under the MIT License. mit license, Apache License 2.0", "GNU General Public License, version 3.",
        "mail a.b@c.de or x@y.org, 10.0.0.300 10.0.0.3, +49 (30) 1234567 and 4111 1111 1111 1111.", prose(7, 100),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", [None, "b", "a"][i % 3], 0, True, "x", 1, 2) for i, t in enumerate(texts())]
    rows.append((17, rows[17][1], "en", "a", 0, True, "x", 1, 2))  # a row once more
    rows.append((None, "no id at all " * 20, None, None, None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def test_exact_dedup(docs, nothing):
    got = exact_dedup.exact_dedup(docs).collect()
    groups = defaultdict(list)
    for i, t in plain(docs):
        groups[re.sub("[A-Z]", lambda m: m[0].lower(), t)].append(i)
    assert len(got) == docs.count()
    want = {hashlib.sha256(t.encode()).hexdigest(): (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}
    for r in got:
        assert want[r.text_sha256] == (r.keep_id, r.group_size)
    assert Counter(r.text_sha256 for r in got if r.kept) == dict.fromkeys(want, 1)
    assert exact_dedup.exact_dedup(nothing).count() == 0
    assert exact_dedup.drop_copies(docs).count() == len(want)
    assert exact_dedup.drop_copies(docs).columns == docs.columns


@pytest.mark.parametrize("partitions", ["1", "4", "100"])
def test_exact_dedup_by_any_number_of_runs(spark, partitions):
    """Copies in every run, a third of all rows among them, and null ids with one text."""
    data = [(i if i % 7 else None, ("hot", "HOT", f"text {i % 50}", "", None, "ünder")[i % 6]) for i in range(600)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        runs = exact_dedup.run_count(spark)
        assert runs == {"1": 1, "4": 1, "100": 32}[partitions]
        rows = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
        got = exact_dedup.exact_dedup(rows).collect()
        levels = exact_dedup.merge_up(common.table(exact_dedup.digests(rows, runs), "digests"), runs)
        assert [n.agg({"_run": "max"}).first()[0] for n in levels] == [runs // (1 << k) - 1 for k in range(len(levels))]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    of_text = {}
    for i, t in data:
        of_text.setdefault((t or "").lower(), []).append(i)
    want = sorted((i or -1, max((j for j in ids if j is not None), default=None) or -1, len(ids)) for ids in of_text.values() for i in ids)
    assert sorted((r.doc_id or -1, r.keep_id or -1, r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(of_text)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_merges_sorted_runs(spark, docs):
    """Rows are combined in sorted order on both sides of an exchange."""
    rows = docs.selectExpr("doc_id as _id", "0 as _run", "doc_id as _row_number", "text as _digest", "1 as _bytes", "1 as _check")
    level = rows.groupBy("_run", *exact_dedup.DIGEST).agg(F.max(F.struct("_id", "_row_number")))
    plan = level._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortAggregate") == 2 and "HashAggregate" not in plan


def test_mixing(docs, nothing):
    got = mixing.mix(docs).collect()
    assert sorted((r.doc_id or -1, r.taken) for r in got) == sorted((r.doc_id or -1, r.taken) for r in mixing.mix(docs).collect())
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in plain(docs)}
    assert all(r["size"] == size[r.doc_id] and 0 <= r.taken <= 2 * r["size"] for r in got)
    sources = defaultdict(int)
    for r in docs.collect():
        sources[r.source] += size[r.doc_id]
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    open_, left, target = set(order), 1.5 * sum(sources.values()), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * sources[s]}
        for s in full or open_:
            target[s] = 2 * sources[s] if full else level * weight[s]
            left -= target[s] if full else 0
        open_ = open_ - full if full else set()
    taken, seen = defaultdict(int), {}
    by_id = {r.doc_id: r.source for r in docs.collect()}
    for r in got:
        taken[by_id[r.doc_id]] += r.taken
        seen[by_id[r.doc_id]] = (r.source_size, r.target)
    for s in order:
        assert seen[s] == (sources[s], pytest.approx(target[s]))
        assert abs(taken[s] - target[s]) <= max(2, 0.01 * target[s])
    assert mixing.mix(nothing).count() == 0
    repeated = mixing.repeat(docs)
    assert repeated.columns == docs.columns and repeated.count() > 0


def test_apportionment_follows_the_highest_quotients(spark):
    draw = random.Random(4)
    for seats in (0, 1, 7, 100):
        weights = [draw.randrange(0, 50) for _ in range(9)]
        if not sum(weights):
            continue
        quotients = sorted(((-w / (2 * k + 1), i) for i, w in enumerate(weights) for k in range(seats)))[:seats]
        want = Counter(i for _, i in quotients)
        rows = spark.createDataFrame([(0, i, float(w), seats) for i, w in enumerate(weights)], "g int, i int, w double, s long")
        assert {r.i: r.quota for r in mixing.apportion(rows, "g", "i", "w", "s").collect()} == {i: want.get(i, 0) for i in range(9)}


@pytest.mark.parametrize("hot", [10**6, 10**8, 5 * 10**9])
def test_small_sources_beside_a_hot_one_get_their_target(spark, hot):
    """At totals that give blocks of thousands of words by themselves."""
    words = [hot, *range(1, 60), *([300] * 100), 3000, 0]
    sources = spark.createDataFrame([(f"s{k:03}", w) for k, w in enumerate(words)], "_key string, _words long")
    got = mixing.shard_quotas(mixing.targets(sources)).collect()
    quota, target = Counter(), {}
    for r in got:
        assert r._blocks >= 0
        quota[r._key] += r._blocks * r._block
        target[r._key] = r._target
    assert len(target) == len(words) and target["s000"] > hot
    for key, want in target.items():
        assert abs(quota[key] - want) <= max(1, 0.01 * want)


def test_mixing_keeps_one_document_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 8)  # blocks of thousands of words on a small table
    rows = [(k, prose(k, 400), "hot") for k in range(150)] + [(1000 + k, prose(k, 20 + k), f"one{k:02}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.mix(docs).collect()}
    for k in range(40):
        assert abs(got[1000 + k].taken - got[1000 + k].target) <= 1 and got[1000 + k].taken > 0
    kept = {r.doc_id for r in mixing.repeat(docs).select("doc_id").collect()}
    assert kept >= {1000 + k for k in range(40)}


def test_quality(docs, nothing):
    got = quality.quality(docs).collect()
    by = Counter()
    for i, t in plain(docs):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        three = list(zip(words, words[1:], words[2:]))
        often = Counter(three)
        repeated = {k + d for k, w in enumerate(three) if often[w] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        by[(i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated), failed)] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == by
    assert not any(r.kept and r.base_failed for r in got)
    assert {r.doc_id for r in got if r.kept} >= {0, 3, 9, 10}
    assert quality.quality(nothing).count() == 0
    assert quality.keep_good(docs).columns == docs.columns


def test_license_scan(docs, nothing):
    got = {r.doc_id: r for r in license_scan.license_scan(docs).collect()}
    for i, t in plain(docs):
        words = re.findall(license_scan.PLAIN_WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t))
        places = [(k, label) for phrase, label in license_scan.BASE.items() for k in range(len(words)) if words[k:k + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (min((p for p, _ in places), default=None), max((p for p, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert got[14].labels == "apache,apache-2.0,mit" and got[15].labels == "gpl,gpl-3.0"
    assert license_scan.license_scan(nothing).count() == 0


def test_contained_detections_are_suppressed():
    d = license_scan.Detection
    kept = license_scan.resolve([d(0, 30, 2, 5), d(10, 30, 3, 9), d(10, 40, 3, 8), d(0, 30, 3, 1)])
    assert kept == sorted([d(0, 30, 2, 5), d(10, 40, 3, 8)])


def test_pieces_and_bpe_equal_the_library(docs, nothing):
    tokenizer = Tokenizer.from_file(PATH)
    draw = random.Random(1)
    parts = ["a", "b", "th", "ing", " ", "  ", "\n", "\t", "'s", "12", "é", "漢", "😀", "<|endoftext|>", "<|end", "!", "zz", "　", "\x85", "̀"]
    some = ["".join(draw.choice(parts) for _ in range(draw.randrange(40))) for _ in range(2000)] + ["ab" * 400, "aaaaaaa" * 30]
    want = [e.ids for e in tokenizer.encode_batch(some, add_special_tokens=False)]
    assert ["".join(chunks.pieces(t)) for t in some] == some
    codec = bpe.Codec(PATH)
    coded = codec.encode(some)
    assert [c.tolist() for c in coded] == want
    assert [codec.decode(c) for c in coded] == some
    flat, bounds = fast_encoding.byte_level(PATH, True)(pa.array(some))
    assert [flat[i:j].tolist() for i, j in zip(bounds[:-1], bounds[1:])] == want
    got = Counter(tuple(r) for r in bpe.bpe_digests(docs, PATH).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = [(i, t, tokenizer.encode(t, add_special_tokens=False).ids) for i, t in plain(docs)]
    assert got == Counter((i, len(x), sha(",".join(map(str, x))), sha(t)) for i, t, x in ids)
    assert bpe.bpe_digests(nothing, PATH).count() == 0


def test_token_files(docs, nothing):
    tokenizer = Tokenizer.from_file(PATH)
    got = token_files.token_files(docs, PATH).collect()
    coded = sorted(((i is not None, i or 0, tokenizer.encode(t, add_special_tokens=False).ids + [2]) for i, t in plain(docs)), key=lambda x: x[:2])
    starts = np.cumsum([0] + [len(x) for *_, x in coded]).tolist()
    want = [(i if known else None, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (known, i, x), s in zip(coded, starts)]
    assert Counter(map(tuple, got)) == Counter(want)
    assert token_files.token_files(nothing, PATH).count() == 0


@pytest.mark.parametrize("values", [[], [5], [-(2**63), 0, 2**63 - 1], list(range(1000)), [3] * 600, sorted(random.Random(2).randrange(10**12) for _ in range(1500))])
def test_elias_fano(values):
    coded = token_files.EliasFano.encode(np.array(values, np.int64))
    raw = memoryview(b"".join(coded.parts()))
    back, used = token_files.EliasFano.read(coded.sizes(), raw)
    assert used == len(raw)
    for a, b in ((0, len(values)), (len(values) // 3, len(values) // 2), (max(0, len(values) - 1), len(values))):
        assert back.decode(a, b).tolist() == values[a:b]


def test_personal_data(docs, nothing):
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    r = got[16]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (2, 1, 1, 1)
    assert set(r.base.split(",")) <= set(r.spans.split(","))
    assert all(not x.spans for i, x in got.items() if i in (0, 4, 5, 17))
    assert pii.personal_data(nothing).count() == 0


def test_patterns_equal_plain_regexes():
    draw = random.Random(3)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        t = "".join(draw.choice("a1.@-_+ 2é") for _ in range(40))
        assert [(s, e) for s, e, _ in pii.emails(t)] == [m.span() for m in email.finditer(t)]
        assert [m.span() for m in pii.IP.finditer(t)] == [m.span() for m in ip.finditer(t)]


def test_an_address_with_thousands_of_zeros():
    zeros = "0" * 5000
    for part, want in ((zeros, True), (zeros + "255", True), (zeros + "256", False), ("9" * 5000, False)):
        text = f"at 1.1.1.{part} now"
        assert [(s, e) for s, e, kind in pii.base_spans(text) if kind == 1] == ([(3, len(text) - 4)] if want else [])


PAGE = """<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav>
<div class="ad">Buy</div>{0}<aside>side</aside><form>f</form><script>var x="<p>no</p>";</script><footer>&copy; me</footer>"""


def test_main_text(spark):
    article = "<article><h1>Title &amp; more</h1><p>One <b>bold</b>\n two<p>Three<br>four<div class='comments'><p>nice!</p></div></article>"
    bare = "<div><p>Unique text {0}</p></div><div><span>Same everywhere</span></div>"
    rows = [(1, "http://a.b/1", PAGE.format(article)), (2, None, None), (3, "http://c.d/1", PAGE.format(bare.format("one"))),
            (4, "http://c.d/2", PAGE.format(bare.format("two"))), (5, "odd", "<p>x &#38; y<!-- no"), (5, "odd", "<p>x &#38; y<!-- no"), (6, "http://a.b/2", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = defaultdict(list)
    for r in wrappers.main_text(pages).collect():
        got[r.page_id].append((r.text, r.n_chars))
    text = "Title & more One bold two Three four"
    assert got[1] == [(text, len(text))] and got[2] == got[6] == [("", 0)] and got[5] == [("x & y", 5)] * 2
    assert "Unique text one" in got[3][0][0] and "Home" not in got[3][0][0] and "side" not in got[3][0][0]
    assert wrappers.main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("inner, want", [
    ("<svg viewbox='0 0 1 1'/>", ""), ("<math/>", ""), ("<svg><title/><path d=M0/></svg>", ""), ("<svg><title>Icon</title></svg>", ""),
    ("<div><object data=x></div>", ""), ("<div><svg></div>", ""), ("<canvas>drawn</canvas>", "drawn"),
    ("<math><mi>a</mi><mo>=</mo><mn>2</mn></math>", "a = 2"), ("<object data=x><p>no player</p></object>", "no player"),
    ("<select><option>one<option>two</select>", ""), ("<div><select><option>one</div>", ""), ("<script/>var x</script>", ""),
    ("<textarea><p>draft</textarea>", ""), ("<iframe src=x/><p>frame</iframe>", ""), ("<noscript><p>on</noscript>", ""), ("<template><p>t</template>", "")])
def test_elements_that_are_not_raw_lose_nothing_after_them(inner, want):
    page = f"<article><p>before</p>{inner}<p>after</p></article><p>end"
    assert wrappers.extract(page, {}).split() == ["before", *want.split(), "after"]


def test_the_wrapper_decides_what_is_main_text(spark):
    """Articles in other containers than their teasers, lines of the template, copies, templates."""
    def page(k, body):
        return f"<body><main><div class=content><h1>Title {k}</h1>{body}<p class=tip>Tell your friends</p></div><article class=card><p>Teaser {k}</article></main><footer>f</footer>"
    story = [f"Story {k} " + prose(k, 60) for k in range(9)]
    rows = [(k, f"http://tea.ser/{k}", page(k, f"<p>{story[k]}")) for k in range(5)]
    rows += [(5, "http://alo.ne/", page(5, f"<p>{story[5]}"))]
    rows += [(6, "http://tea.ser/6", f"<body><section><p>{story[6]}</section>")]  # paths the wrapper lacks
    listed = page(7, f"<p>{story[7]}<ul><li>only here</ul>")
    rows += [(10 + k, "http://tea.ser/copy", listed) for k in range(4)]
    rows += [(20 + k, f"http://pla.in/{k}", f"<div class=x><p>{story[k]}</div><div class=y><p>Same</div>") for k in range(4)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(5):
        assert got[k] == f"Title {k} {story[k]}"
        assert k == 4 or got[20 + k] == story[k]
    assert got[5] == f"Title 5 {story[5]} Tell your friends" and got[6] == story[6]
    assert [got[10 + k] for k in range(4)] == [f"Title 7 {story[7]} only here"] * 4


def test_a_wrapper_does_not_grow_with_the_pages(spark):
    """Ids of their own, and names of their own, on each page."""
    def pages(host, n):
        word = "".join(chr(97 + k % 26) for k in range(26))
        return [(f"http://{host}/{k}", f"<body class='page{k} k{k}z'><div id=post-{k} class='lead {word[k % 26]}{word[k // 26]}x'><p>Story {k}<p>more {k}</div>"
                 f"<div class=rail><p>Same everywhere</div><div id=sidebar><p>Links {k}</div>") for k in range(n)]
    rows = spark.createDataFrame(pages("few", 40) + pages("many", 160) + [("http://one/", "<p>x")], "url string, html string")
    got = {r.host: (json.loads(r.paths), json.loads(r.wrapper)) for r in wrappers.infer(rows).collect()}
    assert set(got) == {"few", "many"} and len(got["few"][1]) == len(got["many"][1]) <= 5
    paths, wrapper = got["many"]
    assert not any(c.isdigit() for p in paths for c in p)
    slot = {u["path"]: u for u in wrapper}
    assert slot["body/div.post/p"] | {"chars": 0} == {"path": "body/div.post/p", "pages": 160, "chars": 0, "optional": False, "repeated": True, "varies": True}
    assert not slot["body.page/div.rail/p"]["varies"] and not paths["body.page/div.rail/p"] and paths["body/div.post/p"] == 1


def test_near_dedup(docs, nothing):
    got = near_dedup.near_dedup(docs).collect()
    classes = {r.doc_id: r.class_id for r in got}
    assert len(got) == docs.count()
    # Copies, the one in capitals and the one with two words changed are one class.
    assert {classes[i] for i in (0, 1, 2, 3)} == {0} and classes[4] == classes[5] == 4
    assert len({classes[i] for i in (6, 9, 10, 11, 12, 13, 14, 15, 16, 17)}) == 10
    kept = Counter(r.class_id for r in got if r.kept)
    assert set(kept.values()) == {1} and set(kept) == set(classes.values())
    assert near_dedup.near_dedup(nothing).count() == 0


def test_near_dedup_of_null_and_repeated_ids(spark):
    """Null ids are larger than any other, and of every class exactly one row stays."""
    base, other = prose(21, 200), prose(22, 60)
    words = base.split()
    close = " ".join(w if i != 90 else "changed" for i, w in enumerate(words))
    rows = [(None, base)] * 40 + [(7, close)] * 3 + [(9, base)] + [(None, other)] * 5
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size, r.n_links) for r in got) == {
        (None, 7, 44, 1): 40, (7, 7, 44, 1): 3, (9, 7, 44, 1): 1, (None, None, 5, 0): 5}
    assert sorted((r.doc_id or -1, r.class_size) for r in got if r.kept) == [(-1, 5), (7, 44)]


def test_near_dedup_keeps_every_link_between_classes(spark):
    """Chains of edits, whose ends are not similar, and a shared passage, against all pairs."""
    draw = random.Random(11)
    rows = []
    for family in range(6):
        words = prose(50 + family, 150).split()
        for _ in range(12):
            rows.append(" ".join(words))
            for _ in range(2):
                words[draw.randrange(len(words))] = f"new{draw.randrange(1000)}"
    passage = prose(60, 120)
    rows += [passage + " " + prose(70 + k, 60) for k in range(30)]
    parts = [near_dedup.shingles(t, {}) for t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if near_dedup.similarity(parts[i], parts[j]) >= near_dedup.SIMILAR:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_dedup(docs).collect()}
    assert got == {i: find(i) for i in range(len(rows))}


def test_alignment_equals_dynamic_programming():
    draw = random.Random(5)
    for _ in range(300):
        a = [draw.randrange(30) for _ in range(draw.randrange(1, 60))]
        b = [x for x in a if draw.random() > 0.06]
        for _ in range(draw.randrange(3)):
            b.insert(draw.randrange(len(b) + 1), draw.randrange(30))
        if not b:
            continue
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        lcs = best[-1][-1]
        want = lcs / (len(a) + len(b) - lcs)
        got = near_dedup.similarity(np.array(a, np.uint64), np.array(b, np.uint64))
        assert got == pytest.approx(want) if want >= near_dedup.SIMILAR else got < near_dedup.SIMILAR


def test_suffix_dedup(docs, nothing):
    rows = [(i, t.encode()) for i, t in plain(docs)]
    seen = Counter(b[p:p + 400] for _, b in rows for p in range(len(b) - 399))
    want = Counter()
    for i, b in rows:
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - 399):
            if seen[b[p:p + 400]] > 1:
                gone[p:p + 400] = 1
        runs = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        want[(i, len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest())] += 1
    assert Counter(map(tuple, suffix_dedup.suffix_digests(docs).collect())) == want
    assert suffix_dedup.suffix_digests(nothing).count() == 0


def test_multikey_order_is_lexicographic():
    draw = np.random.default_rng(1)
    keys = [draw.integers(0, 4, 500) for _ in range(5)]
    order = suffix_dedup.multikey_order(keys)
    assert (np.array([k[order] for k in keys]).T == np.array(sorted(zip(*keys)))).all()


def test_pipeline_keeps_one_of_each_and_encodes(spark, tmp_path, docs):
    clean = docs.filter("doc_id is not null and doc_id < 17")
    clean.write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in rows}
    assert len(ids & {0, 1, 2, 3}) == 1 and 9 in ids and not ids & {4, 5, 6, 7, 12}
    assert set(QUERIES) >= {f for f in QUERIES if f.startswith("op")} and len(QUERIES) == 13 and set(ORACLES) <= set(QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "bpe"]


def test_pipeline_of_an_empty_table_and_of_null_ids(spark, tmp_path, nothing, docs):
    nothing.write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    # Good texts without ids, one of them often: one of each stays.
    good = [prose(i, 150) + "." for i in range(30, 36)]
    rows = [(None, t, "en", "a", 0, True, "x", 1, 2) for t in good + good[:1] * 20]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/null/documents.parquet")
    kept = quality.keep_good(spark.read.parquet(f"{tmp_path}/null/documents.parquet")).select("text").distinct().count()
    got = corpus_pipeline.run(spark, f"{tmp_path}/null").collect()
    assert kept and len({r.ids_sha256 for r in got}) == kept and {r.doc_id for r in got} == {None}


def test_very_long_texts_and_clashing_columns(spark):
    """A text of a million characters beside short ones, and columns named as results are."""
    passage = prose(41, 120)
    long = prose(42, 60_000) + " write to someone@example.org " + passage
    rows = spark.createDataFrame(
        [(1, long, "a", 1, "b"), (2, passage, "c", 2, "d"), (3, None, None, None, None)],
        "doc_id long, text string, spans string, n_bytes int, kept string")
    removed = {r.doc_id: r for r in suffix_dedup.suffix_digests(rows).collect()}
    assert removed[2].n_removed == removed[2].n_bytes == len(passage.encode()) and removed[1].n_removed >= len(passage.encode())
    assert removed[3].n_bytes == 0
    found = {r.doc_id: r for r in pii.pii_digests(rows).collect()}
    assert found[1].n_email == 1 and found[2].n_email == 0 and len(found) == 3
    html = f"<html><body><nav>Home</nav><article><p>{long}</p></article><footer>Imprint</footer></body></html>"
    pages = spark.createDataFrame(
        [(1, "http://a.org/1", html, "x", 1), (2, "http://a.org/2", html.replace(long, passage), "y", 2)],
        "page_id long, url string, html string, text string, n_chars int")
    got = {r.page_id: r for r in wrappers.main_text(pages).collect()}
    assert got[1].text == " ".join(long.split()) and got[2].text == passage and got[2].n_chars == len(passage)
