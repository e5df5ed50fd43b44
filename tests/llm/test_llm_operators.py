"""Every operator on awkward rows, and against plain Python or SQL."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tally.llm import (
    bpe,
    components,
    decontaminate,
    exact,
    licenses,
    ngrams,
    quality,
    queries,
    substrings,
    suffixes,
    toxicity,
    urls,
)

SF = "/root/testdata/sf0.001"
rnd = random.Random(7)
LONG = " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 6) for _ in range(30000))
PASSAGE = " ".join(f"word{i}" for i in range(60))

# (doc_id, text): nulls, empty, blanks, ties, repeated rows, one id with two texts, very long.
AWKWARD = [
    (None, None), (None, "no id but words here"), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"),
    (6, "Two words"), (6, "Two words"), (7, "first text of seven"), (7, "second text of seven"),
    (8, LONG), (9, LONG), (10, PASSAGE), (11, "before " + PASSAGE + " after"), (12, PASSAGE + " " + PASSAGE),
    (13, "x\x00y ünïcode ÀÉ <|endoftext|> 日本"), (14, "la " * 100),
]
SCHEMA = "doc_id bigint, text string, keep_id string, n_words string, _id string, found string, signature string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", None, "y", "z", "s") for i, t in AWKWARD]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def benchmark(spark, rows=((1, PASSAGE), (2, "short one"), (3, None), (None, "x y"))):
    return spark.createDataFrame(list(rows), "item_id bigint, text string")


def labels(spark, rows=((4, 0, 1), (6, 1, 0), (6, 1, 1), (None, 1, 1), (8, None, None))):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


def test_empty_tables(spark, nothing):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert exact.exact_groups(nothing).count() == 0
    assert exact.drop_exact(nothing).columns == nothing.columns
    assert ngrams.similar_sets(nothing).count() == 0
    assert ngrams.keep_one(nothing).count() == 0
    assert substrings.remove_repeats(nothing).count() == 0
    assert suffixes.remove_repeated_bytes(nothing).count() == 0
    assert quality.keep_good(nothing).count() == 0
    assert toxicity.score_toxicity(nothing, labels(spark, [(1, 1, 1)]).limit(0)).count() == 0
    assert decontaminate.find_matches(nothing, benchmark(spark).limit(0)).count() == 0
    assert decontaminate.decontaminate(nothing, benchmark(spark)).count() == 0
    assert licenses.scan_licenses(nothing).count() == 0
    assert bpe.round_trip(nothing).count() == 0
    assert urls.judge_urls(pages).count() == 0


def test_exact(docs):
    groups = collections.defaultdict(list)
    for i, t in AWKWARD:
        groups[t or ""].append(i)
    found = exact.exact_groups(docs).collect()
    assert len(found) == len(AWKWARD)
    want = sorted(
        (str(i), str(max((x for x in g if x is not None), default=None)), len(g), hashlib.sha256(t.encode()).hexdigest())
        for t, g in groups.items() for i in g
    )
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in found) == want
    assert sum(r.kept for r in found) == len(groups)
    left = exact.drop_exact(docs)
    assert left.columns == docs.columns
    assert collections.Counter((r.text or "") for r in left.collect()) == {t: 1 for t in groups}


def shingle_set(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[i : i + 5]) for i in range(max(len(found) - 4, 1))} if found else set()


def near_copies():
    """A text with many changed copies, texts that share a passage only, and small texts."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    base, shared = [word() for _ in range(300)], [word() for _ in range(150)]
    out = [" ".join(base)]
    for k in range(40):
        copy = list(base)
        for at in r.sample(range(300), 1 + k % 7):
            copy[at] = word()
        out.append(" ".join(copy))
    out += [" ".join([word() for _ in range(r.randint(20, 150))] + shared) for _ in range(50)]
    small = [word() for _ in range(30)]
    out += [" ".join(small[: r.randint(1, 30)]) for _ in range(60)]
    return list(enumerate(out))


@pytest.mark.parametrize("short_list", [2, 32])
def test_ngram_join(spark, docs, monkeypatch, short_list):
    monkeypatch.setattr(ngrams, "SHORT_LIST", short_list)
    rows = near_copies()
    sets = {i: shingle_set(t) for i, t in rows}
    least = {i: i for i in sets}
    for _ in range(len(sets)):
        before = dict(least)
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
        if before == least:
            break
    found = ngrams.similar_sets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {i: (len(s), least[i]) for i, s in sets.items()}


@pytest.mark.parametrize("short_list", [2, 32])
def test_ngram_links(spark, monkeypatch, short_list):
    """Every pair of linked documents counts: near copies, copies, ids with several texts."""
    monkeypatch.setattr(ngrams, "SHORT_LIST", short_list)
    rows = near_copies()
    rows += [(1000 + i, rows[i][1]) for i in range(0, 60, 7)] + [(3, rows[5][1]), (3, rows[120][1]), (5, rows[9][1]), (None, rows[1][1])]
    sets = collections.defaultdict(set)
    for i, t in rows:
        if i is not None:
            sets[i].add(frozenset(shingle_set(t)))
    link = lambda a, b: bool(a & b) and 100 * len(a & b) >= 80 * len(a | b)
    want = {i: sum(i != j and any(link(a, b) for a in sets[i] for b in sets[j]) for j in sets) for i in sets}
    found = ngrams.similar_sets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.n_links for r in found} == want | {None: 0}


def test_ngram_join_awkward(docs):
    found = {r.doc_id: r for r in ngrams.similar_sets(docs).collect() if r.doc_id is not None}
    assert found.keys() == {i for i, _ in AWKWARD if i is not None}
    assert (found[4].component_id, found[5].component_id, found[9].component_id) == (4, 4, 8)
    assert found[3].component_id == 3 and found[3].n_shingles == 0
    left = ngrams.keep_one(docs)
    assert left.columns == docs.columns and left.filter("doc_id in (5, 9)").count() == 0


def test_ngram_join_shared_ids(spark, monkeypatch):
    """An id with many texts: each set is compared by its own text, each row judged by its own."""
    monkeypatch.setattr(ngrams, "SHORT_LIST", 2)
    rows = [(i % 3 if i % 2 else i + 1000, t) for i, t in near_copies()]
    own = [(i, t) for i, (_, t) in enumerate(rows)]
    alone = {i: r.component_id for i, r in ((r.doc_id, r) for r in ngrams.similar_sets(spark.createDataFrame(own, "doc_id bigint, text string")).collect())}
    least = {}
    for i, t in own:
        if shingle_set(t):
            least[alone[i]] = min(least.get(alone[i], rows[i][0]), rows[i][0])
    want = sorted((d, t) for i, (d, t) in enumerate(rows) if least.get(alone[i], d) == d)
    left = ngrams.keep_one(spark.createDataFrame(rows + rows[:9], "doc_id bigint, text string"))
    assert sorted({(r.doc_id, r.text) for r in left.collect()}) == sorted(set(want))
    lone = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "unlike any other text at all"), (2, "unlike any other text at all")]
    left = ngrams.keep_one(spark.createDataFrame(lone, "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, left)) == [lone[0], lone[2], lone[2]]


def words_kept(rows, window=20):
    seen, out = set(), {}
    for i, text in sorted(rows):
        found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for p in range(len(found) - window + 1):
            key = tuple(found[p : p + window])
            if key in seen:
                gone |= set(range(p, p + window))
            seen.add(key)
        kept = " ".join(x for q, x in enumerate(found) if q not in gone)
        out[i] = (len(found), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("often", [1, 4096])
def test_substrings(spark, docs, monkeypatch, often):
    monkeypatch.setattr(substrings, "SHARD_RUNS", often)
    rows = [(i, t) for i, t in AWKWARD if i is not None and i not in (6, 7)]
    found = substrings.remove_repeats(docs).collect()
    assert len(found) == len(AWKWARD)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found}
    assert {i: got[i] for i, _ in rows} == words_kept(rows)


def bytes_kept(rows, length=200):
    count = collections.Counter()
    raw = {i: (t or "").encode() for i, t in rows}
    for b in raw.values():
        count.update(b[p : p + length] for p in range(len(b) - length + 1))
    out = {}
    for i, b in raw.items():
        mark = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                mark[p : p + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(mark)))
        kept = bytes(x for x, m in zip(b, mark) if not m)
        out[i] = (len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("pieces", [2, 4096])
def test_suffixes(spark, docs, monkeypatch, pieces):
    monkeypatch.setattr(suffixes, "SHARD_PIECES", pieces)
    rows = [(i, t) for i, t in AWKWARD if i is not None and i not in (6, 7, 8, 9)]
    some = docs.filter("doc_id is not null and doc_id not in (6, 7, 8, 9)")
    found = suffixes.remove_repeated_bytes(some).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == bytes_kept(rows)
    assert suffixes.remove_repeated_bytes(docs).count() == len(AWKWARD)


def test_suffix_array():
    data = np.frombuffer(b"bananabandana" + b"banana\x00\x00" + b"aaaaaaaaaaaaaaaaaaaa", np.uint8)
    ends = np.repeat([13, 21, 41], [13, 8, 20])
    order = suffixes.suffix_array(data, ends)
    raw = data.tobytes()
    assert [raw[i : ends[i]] for i in order] == sorted(raw[i : ends[i]] for i in range(41))
    prefix = suffixes.common_prefixes(data, np.array([0, 13, 21]), np.array([13, 21, 41]), order)
    for a, b in zip(order, order[1:]):
        x, y = raw[a : ends[a]], raw[b : ends[b]]
        assert prefix[b] == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


@pytest.mark.parametrize("depth", [7, 12, 28, 40, 1000])
def test_suffix_ranks(depth):
    """The sort stops at ``depth``: what differs only behind it shares a rank."""
    r = random.Random(depth)
    pieces = [bytes(r.choices(b"ab\x00", (6, 2, 1), k=r.randint(1, 60))) for _ in range(40)]
    pieces += [p[3:] + b"!" for p in pieces] + [b"a" * 50, b"a" * 90]
    raw, ends = b"".join(pieces), np.cumsum([len(p) for p in pieces])
    ends = np.repeat(ends, [len(p) for p in pieces])
    order, rank = suffixes.ranked_suffixes(np.frombuffer(raw, np.uint8), ends, depth)
    firsts = [raw[i : min(ends[i], i + depth)] for i in range(len(raw))]
    assert [firsts[i] for i in order] == sorted(firsts)
    first_place = {x: k for k, x in reversed(list(enumerate(sorted(firsts))))}
    assert rank.tolist() == [first_place[x] for x in firsts]


def test_shard_repeats():
    r = random.Random(3)
    text = bytes(r.choices(b"abc", k=400))
    pieces = [text[r.randint(0, 150) : r.randint(190, 400)] + bytes(r.choices(b"xy", k=r.randint(0, 9))) for _ in range(20)]
    shard = suffixes.Shard(pieces, 40)
    count = collections.Counter(p[i : i + 40] for p in pieces for i in range(len(p) - 39))
    want = np.zeros(len(shard.data), bool)
    for k, p in enumerate(pieces):
        for i in range(len(p) - 39):
            want[shard.starts[k] + i] = count[p[i : i + 40]] > 1
    assert want.any() and not want.all() and (shard.repeated() == want).all()
    assert not suffixes.Shard([], 40).repeated().any()


def test_quality(spark, docs):
    held = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = quality.score_quality(held).join(marks, "doc_id").select((F.col("kept") == (F.col("quality") == 1)).cast("int").alias("ok"))
    assert good.agg(F.avg("ok")).first()[0] > 0.95
    assert quality.score_quality(docs).count() == len(AWKWARD)
    assert quality.keep_good(docs).columns == docs.columns


def test_toxicity(spark, docs):
    held = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    index = toxicity.build_index(held, marks)
    found = toxicity.score_toxicity(held, index=index).filter("held_out").join(marks, "doc_id").toPandas()
    rank, toxic = found.score.rank(), found.toxic == 1
    auc = (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.9
    # The block-max search finds what a full scan finds.
    full = np.zeros((len(index.ids), len(index.terms)))
    size = np.diff(index.first)
    term = np.repeat(np.arange(len(size)) % len(index.terms), size)
    full[index.postings, term] = index.weights
    for k in range(0, len(index.ids), 37):
        terms = np.flatnonzero(full[k])
        near, cosines = index.nearest(terms, full[k, terms], 15)
        assert np.allclose(cosines, np.sort(full @ full[k])[::-1][: len(cosines)])
    out = toxicity.score_toxicity(docs, labels(spark)).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r.score <= 1 for r in out)


def test_licenses_by_brute_force(spark):
    """Every window of every text against every template, without bands or preselection."""

    def cut(text):
        return [t for t in re.split(r"[^a-z0-9\u0080-\U0010ffff]+", (text or "").lower()) if t]

    def grams(tokens):
        return {" ".join(tokens[i : i + 3]) for i in range(max(len(tokens) - 3, 0) + 1)}

    templates = []
    for name, body in licenses.TEMPLATES.items():
        tokens = cut(body)
        templates.append((name, max(8, 1 << (len(tokens) - 1).bit_length()), grams(tokens)))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {}
    for row in docs.select("doc_id", "text").collect():
        tokens = cut(row.text)
        shares = {}
        for name, width, template in templates:
            for start in range(0, len(tokens), width):
                window = grams(tokens[start : start + 2 * width])
                shares[name] = max(shares.get(name, 0), len(window & template) / len(template))
        want[row.doc_id] = sorted(name for name, share in shares.items() if share >= 0.8)
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(docs).collect()}
    assert got == want
    assert any(want.values())


def test_licenses(spark):
    body = licenses.TEMPLATES["MIT-notice"]
    rows = [(1, f"aa bb {body} cc"), (2, "x " * 500 + "Released under the MIT License."), (3, None), (3, ""), (None, body), (4, "free of charge")]
    rows.append((5, LONG + " licensed under the apache license version 2 0"))
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(found) == len(rows)
    got = {r.doc_id: r.licenses for r in found}
    assert got == {1: ["MIT-notice"], 2: ["MIT"], 3: [], 4: [], 5: ["Apache-2.0"], None: []}


def test_decontaminate(spark, docs):
    for size in (1 << 20, 8):
        found = decontaminate.judged(decontaminate.find_matches(docs, benchmark(spark), block_bytes=size)).collect()
        got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found}
        assert got[10] == (60, 60, ["1"], True) and got[11] == (62, 60, ["1"], True)
        assert got[1] == (0, 0, [], False) and got[4] == (1, 0, [], False)
        left = decontaminate.decontaminate(docs, benchmark(spark), block_bytes=size)
        assert left.columns == docs.columns
        assert {r.doc_id for r in left.collect()} == {i for i, _ in AWKWARD} - {10, 11, 12}


def test_training_suffix_arrays():
    """Suffixes in order, and longest matches of every item against all pairs of places."""
    r = random.Random(3)
    for _ in range(60):
        letters = r.choice(["ab", "abcdef"])
        texts, items = ([[r.choice(letters) for _ in range(r.choice([0, 1, 3, 30]))] for _ in range(5)] for _ in "xy")
        value = {c: np.uint64(r.getrandbits(64)) for c in letters}
        hashes = np.array([value[c] for t in texts for c in t], np.uint64)
        first = np.cumsum([0, *map(len, texts)])
        array = decontaminate.SuffixArray(hashes, first)
        whole = [[value[c] for c in t[k:]] for t in texts for k in range(len(t))]
        ordered = [whole[i] for i in array.order]
        assert ordered == sorted(whole) and sorted(array.order) == list(range(len(whole)))
        want = set()
        for number, item in enumerate(items):
            least = min(4, len(item))
            for text, offset in zip(texts, first.tolist()):
                for i in range(len(text)):
                    for j in range(len(item)):
                        if i and j and text[i - 1] == item[j - 1]:
                            continue
                        size = 0
                        while i + size < len(text) and j + size < len(item) and text[i + size] == item[j + size]:
                            size += 1
                        if size >= least:
                            want.add((offset + i, number, j, size))
        tests = decontaminate.Benchmark([(k, " ".join(x)) for k, x in enumerate(items)], 4)
        folded = tests.hashes
        at = np.cumsum([0, *map(len, items)])
        known = {c: folded[at[k] + j] for k, x in enumerate(items) for j, c in enumerate(x)}
        shard = np.array([known.get(c, 0) for t in texts for c in t], np.uint64)
        found = list(zip(*(x.tolist() for x in tests.matches(shard, first))))
        assert len(found) == len(set(found)) and set(found) == want


def test_decontaminate_by_row(spark):
    """Rows of null, shared and repeated ids fare the same whatever the size of the blocks."""
    dirty = "before " + PASSAGE
    rows = [(None, dirty), (None, "clean words"), (None, None), (7, dirty), (7, "clean seven"), (7, "clean seven"), (8, dirty), (8, dirty)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = benchmark(spark, [(1, PASSAGE), (2, PASSAGE), (3, "other item")])
    key = lambda r: tuple(map(repr, r))
    for size in (1 << 20, 8):
        left = decontaminate.decontaminate(docs, items, block_bytes=size).collect()
        assert sorted(map(key, left)) == sorted(map(key, [x for x in rows if x[1] != dirty]))
        found = decontaminate.judged(decontaminate.find_matches(docs, items, block_bytes=size)).collect()
        got = sorted(key((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated)) for r in found)
        hit = lambda t: (61, 60, ["1", "2"], True) if t == dirty else (len((t or "").split()), 0, [], False)
        assert got == sorted(key((i, *hit(t))) for i, t in rows)


def test_bpe(spark, docs, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe._vocabulary(None))
    encoder = bpe.WordBpe(bpe._vocabulary(None))
    r = random.Random(5)
    texts = [t or "" for _, t in AWKWARD] + ["ΟΔΟΣ", "İ", "Ⱥ Ⱦ ǅ ª² ½ʰ", "it's we'll 'sx", "\x85\x1c\x0b\xa0", "é", "a" * 3000]
    texts += ["q\u0301\u07fd\u0334", "\U00011935\U00011930 \U00011938", "\u1c89\ua7ce\U00010d50", "a\u088fb\U00012475"]
    kinds = [(32, 127), (1, 0x250), (1, 0x3000), (0x300, 0xD800), (0x10000, 0x33480)]
    texts += ["".join(chr(r.randrange(*r.choice(kinds))) for _ in range(40)) for _ in range(600)]
    # Code points one by one (the large uniform blocks left out), and marks next to others.
    points = [c for c in range(0x1F000) if not (0x3400 <= c < 0x9F00 or 0xAC00 <= c < 0xF900 or 0x17000 <= c < 0x18700)]
    each = ["".join(f"a{chr(c)}b {chr(c)} " for c in points[i : i + 400]) for i in range(0, len(points), 400)]
    each += ["".join(f"q\u0301{chr(c)}\u0334 " for c in points[i : i + 400]) for i in range(0, len(points), 400)]
    for most, texts in ((bpe.MEMO_WORDS, texts + each), (50, texts)):
        monkeypatch.setattr(bpe, "MEMO_WORDS", most)
        mine = [encoder.encode(text) for text in texts]
        for text, ids, back in zip(texts, mine, encoder.decode(mine), strict=True):
            expected = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == expected, ascii(text)
            assert back == library.decode(expected, skip_special_tokens=False)
        encoder.memo, encoder.older = {}, {}
    monkeypatch.setattr(bpe, "DECODED", 100)
    assert list(encoder.decode(mine)) == [library.decode(np.frombuffer(x, "<u4").tolist(), skip_special_tokens=False) for x in mine]
    assert bpe.round_trip(docs).count() == len(AWKWARD)
    assert bpe.decode(bpe.encode(docs)).count() == len(AWKWARD)


def test_bpe_cuts():
    """Merging whole words gives what their fragments give, and no token spans a cut."""
    encoder = bpe.WordBpe(bpe._vocabulary(None))
    r = random.Random(9)
    words = ["".join(r.choice("abcdexyzqjkv019#é日") for _ in range(r.randint(1, 300))).encode() for _ in range(500)]
    n_cut = 0
    for word in words:
        parts = encoder.fragments(word)
        assert b"".join(parts) == word
        n_cut += len(parts) > 1
        apart = [x for p in parts[:-1] for x in encoder._merge(p, False)] + encoder._merge(parts[-1], True)
        assert apart == encoder._merge(word, True)
    assert n_cut > 100


def test_urls(spark):
    link = '<link href="https://a.example.org/es/1" rel="canonical">'
    rows = [
        (1, "http://A.Example.ORG/es/1?x=1", None), (2, "https://other.net/p", link), (3, "http://www.other.net/p#top", ""),
        (4, None, link), (5, "no scheme", None), (6, "http://x.com/de/9", None), (7, "http://x.com/fr", None), (7, "http://x.com/fr", None),
        (8, "http://www.q.net/a?utm_source=b", '<meta http-equiv="refresh" content="0; url=http://x.com/de/9">'),
    ]
    found = urls.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}
    assert len(found) == len(rows)
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == ("other.net", "/p", None, "block") and got[3][3] == "block"
    assert got[4] == ("", "", None, "allow") and got[5] == ("", "", None, "allow")
    assert got[6][2:] == ("com/de/", "block") and got[8][2:] == (None, "block")
    assert got[7][2:] == (None, "allow")


def test_urls_by_brute_force(spark):
    """Chains of redirects and canonical links whose rules disagree, against a plain search."""
    r = random.Random(11)
    hosts = ["a.org", "example.org", "x.example.org", "s.com", "p.net", "q.net", "other.io", "myorg", "n.example.org"]
    paths = ["/es/1", "/en/1", "/en/2", "/fr/x", "/de/y", "/p", "/p/1", "/p/2", "/", ""]
    ruled = [f"http://{h}{p}" for h in hosts for p in paths]
    others = [f"http://p{k}.net/a" for k in range(400)]
    extra = ["?utm_source=z", "#top", "?ref=1&k=2", "?k=2", "", "/"]
    rows = []
    for i in range(480):
        url = r.choice(r.choice([ruled, others, others])) + r.choice(extra)
        if r.random() < 0.2:
            url = url.replace("://", "://www.")
        kind, target = r.random(), r.choice(r.choice([ruled, others, others]))
        html = None
        if kind < 0.25:
            html = f"<p><link rel='canonical' href='{target}'>"
        elif kind < 0.45:
            html = f'<META http-equiv=refresh content="0; url={target}">'
        rows.append((i, url, html, "clash", "clash"))
    rows += [(600, None, None, "", ""), (601, "nothing", "", "", ""), (602, "http://p.net/" + "z" * 100_000, None, "", ""), rows[0]]

    def split(url):
        rest = url.partition("://")[2] if url else ""
        m = re.match(r"([^/?#]*)([^?#]*)(?:\?([^#]*))?", rest)
        return m[1].lower(), m[2], m[3] or ""

    def address(url):
        host, path, query = split(url)
        kept = [x for x in query.split("&") if x and not re.match(r"(utm_[a-z]+|ref)=", x)]
        return "://" + host.removeprefix("www.") + path.removesuffix("/") + ("?" + "&".join(kept) if kept else "")

    def rule(url):
        host, path, _ = split(url)
        fits = [
            (len(h + p), verdict == "allow", h + p, verdict) for verdict, h, p in urls.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        return max(fits)[2:] if fits else (None, None)

    near = collections.defaultdict(set)

    def link(a, b):
        if b != "://":
            near[a].add(b), near[b].add(a)

    for _, url, html, *_ in rows:
        if url:
            link(url, address(url))
            target = re.search(r"(?:href='|url=)([^'\"]*)", html or "")
            if target:
                link(url, target[1]), link(url, address(target[1])), link(target[1], address(target[1]))
    changed = 0
    want = []
    for page, url, *_ in rows:
        seen, todo = {url}, [url]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        own, verdict = rule(url)
        if verdict is None:
            around = {rule(u)[1] for u in seen if u}
            verdict = "block" if "block" in around and "allow" not in around else "allow"
            changed += verdict == "block"
        want.append((page, *split(url)[:2], own or "", verdict))
    found = urls.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string, html string, node string, host string"))
    got = [(x.page_id, x.host, x.path, x.rule or "", x.verdict) for x in found.collect()]
    assert sorted(got) == sorted(want)
    assert changed > 5


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 101), (None, 3)] + [(200, 200 + i) for i in range(1, 60)]
    found = components.components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()
    want = {i: 0 for i in range(51)} | {100: 100, 101: 100} | {200 + i: 200 for i in range(60)}
    assert {r.node: r.component for r in found} == want and len(found) == len(want)


WITH_SQL = [name for name, (_, sql) in queries.QUERIES.items() if sql]


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    query, sql = queries.QUERIES[name]
    found = query(spark, SF)
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(repr, map(tuple, found.select(columns).collect()))) == sorted(map(repr, cursor.fetchall()))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, out, SF)
        assert kept.columns == docs.columns, name
        out = kept.cache()
    ids = {r.doc_id for r in out.select("doc_id").collect()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == ids
    texts = [r.text for r in out.collect()]
    assert len(set(texts)) == len(texts)


def test_pipeline_stages_by_brute_force(spark):
    """What each stage after the classifier keeps of its own input, in plain Python."""
    from tokenizers import Tokenizer

    stages = dict(corpus_pipeline.STAGES)
    rows = lambda frame: sorted((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect())
    docs = stages["quality classifier"](spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).cache()

    before = rows(docs)
    last = {t or "": i for i, t in before}
    docs = stages["exact dedup"](spark, docs, SF).cache()
    assert rows(docs) == [(i, t) for i, t in before if last[t or ""] == i]

    before = rows(docs)
    sets = {i: shingle_set(t) for i, t in before}
    least = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if sets[a] and a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    docs = stages["n-gram Jaccard join"](spark, docs, SF).cache()
    assert rows(docs) == [(i, t) for i, t in before if least[i] == i]

    before = rows(docs)
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        item = cut(r.text)
        windows |= {tuple(item[p : p + 13]) for p in range(max(len(item) - 12, 1))} - {()}

    def dirty(text):
        found = cut(text)
        hit = {p + k for n in {len(x) for x in windows} for p in range(len(found) - n + 1) if tuple(found[p : p + n]) in windows for k in range(n)}
        return bool(hit) and 20 * len(hit) >= len(found)

    docs = stages["benchmark decontamination"](spark, docs, SF).cache()
    assert rows(docs) == [(i, t) for i, t in before if not dirty(t)]

    library = Tokenizer.from_file(bpe._vocabulary(None))
    want = {}
    for i, t in rows(docs):
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    out = stages["BPE encoding and decoding"](spark, docs, SF).collect()
    assert len(out) == len(want) and {r.doc_id: (r.n_tokens, r.ids_sha256) for r in out} == want
    assert sorted(want) == sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect())
