"""Collocations, ranked search and the quality classifier against brute force and held-out accuracy, on small tables."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from orderloom.llm import collocations, lexical_search, quality_classifier
from orderloom.llm.words import span_hashes, spans

DOCS = "doc_id long, text string, lang string, phrase string, rank string, score string, _text string, row int"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def corpus():
    """Few words, so that phrases repeat and tie; marks, blanks of all kinds, null, empty and long texts, repeated rows, null languages and ids."""
    rnd = random.Random(9)
    names = ["a", "B", "ab", "é", "ÉÀ", "the", "The", "x" * 700, "longer-than-eight-bytes", "10", "日本"]
    texts = []
    for _ in range(150):
        parts = [rnd.choice(names[:6] if rnd.random() < 0.6 else names) + rnd.choice([" ", " ", " ", "\t ", ". ", ", ", "\n", "\x0b", "! ?"]) for _ in range(rnd.randint(1, 40))]
        texts.append("".join(parts))
    texts += [None, "", " \t ", ".,;", "a b", "a b", "  a  b  ", " ".join(rnd.choice(names) for _ in range(4000)), "one word two", "a b. " * 30]
    rows = [(i, t, ["en", "de", None, "und", ""][i % 5], "p", "r", "s", "t", 1) for i, t in enumerate(texts)]
    return [*rows, *rows[:5], (None, "the a b", "en", None, None, None, None, None), (None, "the a b", "en", None, None, None, None, None)]


def counts(corpus):
    found, words = Counter(), Counter()
    for row in corpus:
        lang = "und" if row[2] is None else row[2]
        for piece in re.split("[.,;:!?\n-\r]", lowered(row[1])):
            w = re.findall("[^ \t]+", piece)
            words[lang] += len(w)
            found.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    return found, words


def best_phrases(corpus, least, share, first):
    f, n = counts(corpus)
    frequent = {(lang, p): a for (lang, p), a in f.items() if a >= least and len(p) > 1}
    kept = []
    for (lang, p), a in frequent.items():
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        longer = [b for (other, q), b in frequent.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if not any(100 * b >= share * a for b in longer):
            kept.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out, at = set(), Counter()
    for lang, score, a, phrase, left, right in sorted(kept):
        at[lang] += 1
        if at[lang] <= first:
            out.add((lang, at[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return out


@pytest.mark.parametrize(("least", "share", "first", "size"), [(10, 50, 2000, 4 << 20), (2, 50, 30, 900), (3, 100, 7, 1)])
def test_collocations(spark, corpus, monkeypatch, least, share, first, size):
    docs = spark.createDataFrame(corpus, DOCS).repartition(3)
    monkeypatch.setattr(collocations, "PART", 4000)
    monkeypatch.setattr(collocations.frequent_phrases, "__defaults__", ("text", "lang", 10, 3, size))
    got = collocations.collocations(docs, least=least, share=share, first=first)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {kind for name, kind in got.dtypes if name not in ("lang", "phrase")} == {"bigint"}
    rows = got.collect()
    assert len(rows) == len(set(rows)) and {tuple(r) for r in rows} == best_phrases(corpus, least, share, first)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")).count() == 0


def test_counts_beyond_64_bits(spark):
    """a * a * 1000000 and l * r pass 64 bits; the score must not."""
    a, left, right = 3_000_000_007, 3_000_000_019, 7_000_000_001
    query = f"select cast(cast(1000000 as decimal(38,0)) * cast(cast({a} as decimal(38,0)) * {a}L as decimal(38,0)) as decimal(38,0)) div cast(cast({left} as decimal(38,0)) * {right}L as decimal(38,0))"
    assert spark.sql(query).first()[0] == 1_000_000 * a * a // (left * right)


@pytest.mark.parametrize("capacity", [1, 7, 50, 10_000])
def test_summary_keeps_what_is_frequent(capacity):
    rnd = np.random.default_rng(capacity)
    summary, true, mass = collocations.Summary(capacity), Counter(), 0
    for _ in range(40):
        keys, seen = np.unique(rnd.zipf(1.3, 500).astype(np.uint32), return_counts=True)
        summary.merge(keys, seen)
        true.update(dict(zip(keys.tolist(), seen.tolist(), strict=True)))
        mass += int(seen.sum())
    kept = set(summary.survivors(200).tolist())
    assert summary.keys.size <= capacity and summary.lost <= mass / (capacity + 1)
    assert {k for k, c in true.items() if c >= 200} <= kept or summary.lost >= 200
    for key, count in zip(summary.keys.tolist(), summary.counts.tolist(), strict=True):
        assert true[key] - summary.lost <= count <= true[key]


def test_slices_count_each_start_once(monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 5)
    text = b"a b a b c. d e a b a\tb c a b " * 3
    found = Counter()
    for g in collocations._grams(text, np.uint64(3), 3):
        for i, count in enumerate(g.counts.tolist()):
            found[tuple(text[slice(*g.places[w[i]])] for w in g.words)] += count
    want = Counter()
    for piece in text.split(b"."):
        w = piece.split()
        want.update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    assert found == want


def test_span_hashes_follow_the_bytes():
    body = b"abcdefgh abcdefgh\0 abcdefghi abcdefgh " + b"y" * 511 + b" " + b"y" * 512 + b" " + b"y" * 513 + b" " + b"y" * 513
    inside = np.array([b != 32 for b in range(256)])
    starts, ends = spans(np.frombuffer(body, np.uint8), inside)
    hashes = span_hashes(body, starts, ends)
    words = [body[a:b] for a, b in zip(starts, ends, strict=True)]
    assert words == body.split(b" ")
    assert len(set(hashes.tolist())) == len(set(words)) and hashes[0] == hashes[3] and hashes[-1] == hashes[-2]


def ranked(corpus, items, first=20):
    term = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    docs = [(row[0], Counter(term.findall(lowered(row[1])))) for row in corpus]
    docs = [(key, tf, sum(tf.values())) for key, tf in docs if tf]
    big_n, big_l = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, tf, _ in docs for t in tf)
    out = Counter()
    for item, text in set(items):
        scores = []
        for key, tf, n in docs:
            m = 75 + 25 * n * big_n // big_l
            score = 0
            for t in term.findall(lowered(text)):
                if t in tf:
                    score += math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out.update((item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(scores)[:first], 1))
    return out


@pytest.mark.parametrize(("docs_in_block", "slab", "terms"), [(8192, 64 << 20, 1 << 18), (3, 1, 1), (2, 5000, 4)])
def test_lexical_search(spark, corpus, monkeypatch, docs_in_block, slab, terms):
    for name, value in (("DOCS", docs_in_block), ("SLAB", slab), ("QUERY_TERMS", terms), ("TEXTS", 500)):
        monkeypatch.setattr(lexical_search, name, value)
    items = [(1, "the a é"), (2, "THE the the 10, x" + "x" * 699), (3, "日本 nowhere"), (3, "ab"), (3, "ab"), (4, None), (5, ""), (6, "nowhere"), (None, "b a")]
    index = lexical_search.build(spark.createDataFrame(corpus, DOCS).repartition(4))
    got = lexical_search.search(spark, index, spark.createDataFrame(items, "item_id long, text string"))
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    want = ranked(corpus, items)
    assert Counter(map(tuple, got.collect())) == want and {i for i, *_ in want} == {1, 2, 3, None}


def test_lexical_search_of_nothing(spark, corpus):
    items = spark.createDataFrame([(1, "the a")], "item_id long, text string")
    for rows in ([], [(1, None, *[None] * 6), (2, " .", *[None] * 6)]):
        index = lexical_search.build(spark.createDataFrame(rows, DOCS))
        assert index.documents == 0 and lexical_search.search(spark, index, items).count() == 0
    index = lexical_search.build(spark.createDataFrame(corpus, DOCS))
    assert lexical_search.search(spark, index, items.limit(0)).count() == 0
    # Keys of other types do as well.
    named = lexical_search.build(spark.createDataFrame([("b", "the"), ("a", "the"), (None, "a")], "doc_id string, text string"))
    assert [r["doc_id"] for r in lexical_search.search(spark, named, items).orderBy("rank").collect()] == [None, "a", "b"]


@pytest.fixture(scope="module")
def judged():
    """Good texts of invented words, and three kinds of bad ones."""
    rnd = random.Random(3)
    syllables = ["ba", "re", "ti", "lo", "mé", "nu", "sch", "ka"]

    def word():
        return "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))

    rows = []
    for i in range(300):
        body = [word() for _ in range(rnd.randint(5, 60))]
        bad = i % 5 == 0
        if bad:
            body = [[w + "###" for w in body], [w.upper() + "!!" for w in body], [body[0]] * len(body)][i // 5 % 3]
        rows.append((i, " ".join(body), 0 if bad else 1))
    return rows


def test_quality_classifier(spark, judged):
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in judged], "doc_id long, text string, quality_score string")
    labels = spark.createDataFrame([(i, q) for i, _, q in judged if i % 4] + [(None, 1), (3, None), (10_000, 0)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels)
    scored = {r["doc_id"]: r["quality_score"] for r in quality_classifier.score(docs, model).collect()}
    right = [(scored[i] >= 0.3) == (q == 1) for i, _, q in judged if i % 4 == 0]
    assert sum(right) / len(right) > 0.95 and all(0 <= s <= 1 for s in scored.values())
    # The same sample in other splits gives the same model.
    again = quality_classifier.fit(docs.repartition(7), labels.repartition(5))
    assert np.array_equal(model.places, again.places) and np.allclose(model.weights, again.weights) and model.slope == pytest.approx(again.slope)


def test_quality_classifier_bound_follows_the_hash(spark, judged):
    labels = spark.createDataFrame([(i, q) for i, _, q in judged], "doc_id long, quality int")
    picked = [{r["_key"] for r in quality_classifier._sample(labels.repartition(n), "doc_id", "quality", 40).collect()} for n in (1, 6)]
    assert len(picked[0]) == 40 and picked[0] == picked[1]


def test_quality_classifier_edge_rows(spark, judged):
    labels = spark.createDataFrame([(i, q) for i, _, q in judged], "doc_id long, quality int")
    docs = spark.createDataFrame([(i, t) for i, t, _ in judged], "doc_id long, text string")
    model = quality_classifier.fit(docs, labels)
    odd = [(1, None, 1), (1, None, 1), (None, "", 2), (5, " \n", 3), (6, "é", 4), (7, "ba re " * 300_000, 5), (7, "ba re " * 300_000, 5)]
    scored = quality_classifier.score(spark.createDataFrame(odd, "doc_id long, text string, _text int"), model, into="s")
    assert scored.columns == ["doc_id", "text", "_text", "s"]
    values = {}
    for r in scored.collect():
        values.setdefault((r["doc_id"], (r["text"] or "")[:9]), set()).add(r["s"])
    assert all(len(v) == 1 for v in values.values()) and values[1, ""] == values[None, ""]
    for none in (docs.limit(0), docs):
        empty = quality_classifier.fit(none, labels.where("quality = 1") if none is docs else labels)
        shares = {r["s"] for r in quality_classifier.score(docs, empty, into="s").collect()}
        assert len(shares) == 1 and (shares == {0.5}) == (none is not docs)
    assert quality_classifier.score(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("block", [1 << 20, 64])
def test_quality_features(monkeypatch, block):
    """The same set whatever the block, and the runs that define it."""
    monkeypatch.setattr(quality_classifier, "BLOCK", block)
    seen = np.zeros(1 << quality_classifier.BITS, bool)
    text = ("Ein  Satz\nein Satz. " * 20 + "é!").encode()
    found = quality_classifier.features(text, seen)
    assert not seen.any() and np.array_equal(found, np.unique(found))
    monkeypatch.setattr(quality_classifier, "BLOCK", 1 << 20)
    assert np.array_equal(found, quality_classifier.features(text, seen))
    squeezed = re.sub(rb"[ \t-\r]+", b" ", text)
    runs = {squeezed[i : i + n] for n in range(1, 5) for i in range(len(squeezed) - n + 1)}
    own = np.unique([quality_classifier._place(np.array([int.from_bytes(r, "big")], np.uint64), len(r) << 40)[0] for r in runs])
    assert np.isin(own, found).all()


def test_dual_coordinate_descent_meets_its_optimum():
    """At the optimum no dual variable wants to move: slopes are 0 inside and not negative at 0; checked by the primal gradient."""
    rnd = np.random.default_rng(1)
    rows = [np.unique(rnd.integers(0, 40, 12)).astype(np.int32) for _ in range(80)]
    good = np.array([(r < 12).sum() >= 4 for r in rows])
    places, weights = quality_classifier._support_vectors(rows, good, 1000, passes=2000, enough=1e-9)
    scale, w = weights[1][:-1], np.append(weights[0][:-1] / weights[1][:-1], weights[0][-1])
    x = np.zeros((80, places.size))
    for i, row in enumerate(rows):
        own = np.isin(places[:-1], row)
        x[i, :-1][own] = scale[own] / np.sqrt((scale[own] ** 2).sum())
        x[i, -1] = 1
    y, cost = np.where(good, 1.0, -1.0), np.where(good, 1.0, np.sqrt(good.sum() / (~good).sum()))
    gap = np.maximum(1 - y * (x @ w), 0)
    assert np.abs(w - 2 * x.T @ (cost * y * gap)).max() < 1e-5
