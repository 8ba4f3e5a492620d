"""Every corpus operator against a plain Python version on awkward documents, and on empty tables."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import collision_search, column_dedup, fuzzy_lines, language, max_score, mixing, near_copies, packing, range_coder, url_filter
from tidemark.llm.links import components
from tidemark.llm.tokens import encoder


@pytest.fixture(scope="module")
def rows():
    return brute.awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, brute.DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], brute.DOCS)


def got(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


# ---------------------------------------------------------------- tokens, packing, range coder


def test_cached_encoding_equals_the_library():
    texts = ["Don't.'s I.'re It'S", "a<|endoftext|>b", "É.É x̌.a İ.K ǅ. ß;", "12.5a $a.b", "\u2003wide\u00a0space\x85x", None, "", "x" * 500 + ".", "<|STARTOFTEXT|>"]
    one = encoder()
    for _ in range(2):  # the second time from memory
        flat, offsets = one.encode(pa.array(texts))
        for i, t in enumerate(texts):
            assert flat[offsets[i] : offsets[i + 1]].tolist() == brute.tokens(t, one.model)


def test_packing(docs, rows, empty):
    model, found = encoder().model, packing.pack(docs, capacity=256).collect()
    want = []
    for r in rows:
        ids = brute.tokens(r[1], model) + [1]
        want += [(r[0], p, s, len(ids[s : s + 256]), brute.crc(ids[s : s + 256])) for p, s in enumerate(range(0, len(ids), 256))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(want)
    sequences: dict[int, list] = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= brute.best_fit_decreasing([w[3] for w in want], 256)
    assert packing.pack(empty).count() == 0


@pytest.mark.parametrize("lengths", [[7], [1] * 5000, [1500] * 333, list(range(1, 4097)), [4096] * 3 + [2048] * 5 + [2049]])
def test_pack_plan_is_gapless_and_near_the_bound(lengths):
    values, n = np.unique(lengths, return_counts=True)
    plan = packing.pack_plan(dict(zip(values.tolist(), n.tolist())), 4096)
    length = np.repeat(values, n)
    rank = np.concatenate([np.arange(k) for k in n])
    sequence, offset = packing.place(plan, length, rank)
    order = np.lexsort((offset, sequence))
    same = sequence[order][1:] == sequence[order][:-1]
    assert (offset[order][1:][same] == (offset + length)[order][:-1][same]).all() and (offset[order][1:][~same] == 0).all()
    assert (offset + length).max() <= 4096 and len(set(sequence)) == plan["sequences"][0]
    if max(lengths) < 1000 or len(values) > 100:
        assert len(set(sequence)) <= math.ceil(sum(lengths) / 4096) * 1.01 + 1


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000, 40000])
def test_range_coder_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 49408).astype(np.uint32)
    lanes, body = range_coder.encode_ids(ids, 49408)
    assert (range_coder.decode_ids(body, lanes, n, 49408) == ids).all()
    assert n < 5000 or len(body) < 2 * n


def test_damaged_block_is_found():
    block = range_coder.write_block([5, None], np.array([2, 1]), np.array([9, 2, 2], np.uint32), 49408)
    table, ids = range_coder.read_block(block)
    assert table["id"].tolist() == [5, 0] and table["null"].tolist() == [0, 1] and ids.tolist() == [9, 2, 2]
    for bad in (block[:-1] + bytes([block[-1] ^ 1]), b"x" + block[1:]):
        with pytest.raises(ValueError):
            range_coder.read_block(bad)


def test_token_blocks(docs, rows, empty):
    model, want, at = encoder().model, [], 0
    for r in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or "")):
        ids = brute.tokens(r[1], model) + [2]
        want.append((r[0], at, len(ids), brute.crc(ids)))
        at += len(ids)
    assert got(range_coder.round_trip(docs), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want)
    assert range_coder.round_trip(empty).count() == 0


# ---------------------------------------------------------------- passages, lines, near copies


@pytest.mark.parametrize("group", [column_dedup.GROUP, 2])
def test_passages(docs, rows, group):
    found = column_dedup.remove_repeats(docs, group)
    assert got(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.removed(rows)


def test_passages_of_no_rows_and_without_ids(spark, empty):
    assert column_dedup.remove_repeats(empty).count() == 0
    text = "a passage of more than fifty bytes that two documents share"
    two = spark.createDataFrame([(None, text), (4, text)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in column_dedup.remove_repeats(two).collect()} == {None: len(text), 4: 0}


def test_lines(docs, rows):
    want = brute.deduped_lines(rows)
    for r in fuzzy_lines.dedup_lines(docs).collect():
        assert (r.n_lines, r.n_removed, r.text) == want[r.doc_id], r.doc_id
        assert (r.size, r.gone, r.key) == (1, 3, 5)


def test_lines_of_no_rows(empty):
    assert fuzzy_lines.dedup_lines(empty).count() == 0


@pytest.mark.parametrize("words", [2, 5])
def test_near_copies(docs, rows, words):
    found = near_copies.near_copies(docs, words)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()} == brute.near_copies(rows, words)
    assert found.count() == len(rows)


def test_near_copies_of_no_rows_and_without_ids(spark, empty):
    assert near_copies.near_copies(empty).count() == 0
    two = spark.createDataFrame([(None, "a b c d e f"), (8, "a b c d e f"), (None, "x y z")], "doc_id long, text string")
    found = [(r.doc_id, r.component_id, r.kept) for r in near_copies.near_copies(two, 2).collect()]
    assert sorted(found, key=str) == sorted([(None, 8, False), (8, 8, True), (None, None, False)], key=str)


def test_components_of_long_chains(spark):
    rng = random.Random(3)
    ids = rng.sample(range(10_000), 300)
    chain = [(min(a, b), max(a, b)) for a, b in zip(ids[:200], ids[1:200])] + [(min(a, b), max(a, b)) for a, b in zip(ids[200:], ids[201:])]
    found = dict(got(components(spark.createDataFrame(chain, "a long, b long")), "id", "component"))
    assert found == {i: min(ids[:200]) for i in ids[:200]} | {i: min(ids[200:]) for i in ids[200:]}


# ---------------------------------------------------------------- mixing


def test_mixing(docs, rows, empty):
    found = mixing.mix(docs.withColumn("target", F.lit("clash")))
    got_rows = sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in found.collect()), key=str)
    assert got_rows == brute.mixed(rows)
    assert mixing.mix(empty).count() == 0


def test_mixing_single_document(spark):
    one = spark.createDataFrame([(1, "a b c d e f g h i j", "s")], "doc_id long, text string, source string")
    assert got(mixing.mix(one), "size", "target", "taken") == [(10, 15.0, 15)]


# ---------------------------------------------------------------- vectors


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(16)]) for i in range(400)]
    rows += [(50, rows[50][1]), (2007, rows[50][1]), (1000, None), (1001, [float("nan")] * 16), (1002, [None] + [1.0] * 15),
             (1003, [float("inf")] * 16), (1004, [0.0] * 16), (1050, [0.0] * 16), (None, rows[3][1])]
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<float>, label int, rank int, score int"), rows


def _best(rows, usable, score):
    rows = [(i, [float(np.float32(x)) if x is not None else None for x in v]) for i, v in rows if v is not None]
    rows = [(i, np.array(v)) for i, v in rows if None not in v and np.isfinite(np.array(v, float)).all() and usable(v)]
    out = []
    for k, (i, v) in enumerate(rows):
        if i is not None and i % 50 == 0:
            found = sorted(((-score(v, w), j is None, j) for m, (j, w) in enumerate(rows) if m != k))[:5]
            out += [(i, rank, j, -s) for rank, (s, _, j) in enumerate(found, 1)]
    return out


def test_max_score(vectors):
    df, rows = vectors
    want = _best(rows, lambda v: True, lambda a, b: int(np.floor(256 * a) @ np.floor(256 * b)))
    found = [(r.query_id, r["rank"], r.vec_id, r.score) for r in max_score.top_scores(df).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_max_score_of_huge_weights():
    x = np.array([[1e17, 1.0], [-1e17, 2.0], [3.0, 4.0]])
    for rows, scores in max_score._cell(x, x, 1):
        assert len(rows) == len(scores) and np.abs(scores).max() <= 2**63 - 1


def test_collision_search(vectors):
    df, rows = vectors
    cosine = lambda a, b: float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b))
    want = _best(rows, lambda v: any(v), cosine)
    found = [(r.query_id, r["rank"], r.vec_id, r.score) for r in collision_search.nearest(df).collect()]
    assert len(found) == len(want)
    hits = {(q, j) for q, _, j, _ in found} & {(q, j) for q, _, j, _ in want}
    assert len(hits) >= 0.9 * len({(q, j) for q, _, j, _ in want})
    true = {i: np.array(v, np.float32).astype(float) for i, v in rows[:402]}
    assert all(abs(s - cosine(true[q], true[j])) < 1e-12 for q, _, j, s in found if j is not None)


def test_few_or_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    for search in (max_score.top_scores, collision_search.nearest):
        assert search(none).count() == 0
        assert [(r.query_id, r.vec_id) for r in search(few).orderBy("rank").collect()] == [(0, 3), (0, 1)]


# ---------------------------------------------------------------- urls and languages


def _url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    path = rest[end:]
    stop = min([path.index(c) for c in "?#" if c in path] + [len(path)])
    return rest[:end].translate(brute.LOWER), path[:stop]


def _rule(host, path):
    best = None
    for name, says in url_filter.RULES:
        domain, _, rest = name.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest) and (best is None or len(name) > len(best[0])):
            best = (name, says)
    return best or (None, None)


URLS = [None, "", "no scheme", "http://", "http://NET/", "https://a.net", "https://a.Net/x?y#z", "http://example.net/en/1", "http://xexample.net/en/1",
        "http://example.net/en", "http://www.example.com/de/9", "http://ORG/fr/", "http://a.org/fr/x", "http://a.org?/fr/", "x://y://z/w", "http://É.net/ü",
        "http://casino-win.example.com/", "http://free-bets.example.org/en/1", "http://thest.example.com/en/7", "http://m.rending.example.org/de/44"]


def test_url_filter(spark):
    df = spark.createDataFrame([(i, u, "html", 1.0, "clash") for i, u in enumerate(URLS + URLS[3:6])],
                               "page_id long, url string, html string, verdict double, host string")
    found = {r.page_id: r for r in url_filter.classify(df).collect()}
    assert len(found) == len(URLS) + 3
    for i, u in enumerate(URLS):
        host, path = _url(u)
        rule, says = _rule(host, path)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        assert found[i].verdict == says or says is None and found[i].verdict in ("allow", "block")
    assert [found[i].verdict for i in range(16, 20)] == ["block", "block", "allow", "allow"]
    assert url_filter.classify(df.limit(0)).count() == 0


@pytest.mark.parametrize(("labels", "verdict"), [([], "allow"), ([("http://x/", "block")], "block")])
def test_url_filter_of_few_labels(spark, labels, verdict):
    df = spark.createDataFrame([(1, "http://quiet.example/")], "page_id long, url string")
    table = spark.createDataFrame(labels, "url string, verdict string")
    assert url_filter.classify(df, labelled=table).collect()[0].verdict == verdict


def test_language(spark, empty):
    rng = random.Random(2)
    words = {"en": ["the", "thing", "with", "other", "there"], "de": ["der", "und", "nicht", "schön", "über"], "fr": ["les", "être", "avec", "très", "où"]}
    rows = [(i, " ".join(rng.choices(words[x], k=rng.randint(3, 30))) + ".", x, 0.5, True) for i, x in enumerate(["en", "de", "fr"] * 40)]
    rows += [(200, None, "en", 0.5, True), (201, "", "en", 0.5, True), (202, "12 !?", "de", 0.5, True), (203, "жук", None, 0.5, True),
             (204, "nichts schöner", None, 0.5, True), (None, "the other", "en", 0.5, True), rows[4]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, held_out boolean")
    found = language.identify(df).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    import zlib

    for i, text, lang, *_ in rows:
        r = by_id[i]
        assert r.held_out == (zlib.crc32(("" if i is None else str(i)).encode()) % 4 == 2) and 0 <= r.score <= 1
        if i is not None and i < 200:
            assert r.lang_pred == lang
    assert [by_id[i].lang_pred for i in (200, 201, 202, 204)] == ["und", "und", "und", "de"]
    assert 0 < by_id[203].score < 0.6 and by_id[203].lang_pred in words  # unseen letters: word edges only
    assert language.identify(empty).count() == 0
    unlabelled = language.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}
