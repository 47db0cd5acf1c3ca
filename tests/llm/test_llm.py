"""The training-data operators against brute force, exact round trips and held-out accuracy, on small tables."""

import base64
import hashlib
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from orderloom.llm import bpe, embedding_dedup, jaccard_join, packing, quality_rules, suffix_dedup, token_output, tokens, toxicity, url_filters, warc  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, repeats, empty, null, repeated rows and a long text."""
    rnd = random.Random(5)
    passage, base = words(rnd, 90), [words(rnd, rnd.choice([3, 12, 60, 200])) for _ in range(40)]
    texts = [*base, *base[:10], None, "", "  \n\t", "one", "One two", "one TWO", words(rnd, 6000), "x" * 700, "ab" * 300]
    for text in base[20:35]:
        parts = text.split()
        parts[rnd.randrange(len(parts))] = "changed"
        texts.append(" ".join(parts))
    texts += [f"{words(rnd, 20)} {passage} {words(rnd, 20)}" for _ in range(8)] + ["idiot " * 3 + "fine\nfine\nfine", "é" * 400]
    return list(enumerate(texts)) + [(0, texts[0]), (50, None)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 2}", len(t or "")) for i, t in corpus]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text, n):
    found = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[i : i + n]) for i in range(max(len(found) - n + 1, 1))} if found else set()


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_jaccard_components(docs, corpus, n, percent):
    sets = [(i, shingles(t, n)) for i, t in corpus]
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (_, a) in enumerate(sets):
        for y, (_, b) in enumerate(sets[:x]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[top(x)] = top(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        least[top(x)] = min(i, least.get(top(x), i))
    want = Counter((i, len(a), least[top(x)]) for x, (i, a) in enumerate(sets))
    got = jaccard_join.jaccard_components(docs.withColumn("node", docs.doc_id).withColumn("rank", docs.text), words=n, percent=percent)
    assert Counter(tuple(r) for r in got.collect()) == want


def test_jaccard_tiles_and_signatures(spark, monkeypatch):
    """A block larger than a tile, and sets at the threshold with every size."""
    monkeypatch.setattr(jaccard_join, "TILE", 4)
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*base, f"x{i}", f"y{rnd.randrange(9)}"])) for i in range(40)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words=1, percent=90)
    assert {r.component_id for r in got.collect()} == {0}
    for percent in (50, 80, 90):
        for n in range(1, 130):
            a = np.unique(np.array([rnd.getrandbits(64) for _ in range(n)], dtype=np.uint64))
            for less in range(n):
                b = a[less:]
                if 100 * b.size < percent * n:
                    break
                assert not less or set(jaccard_join.signatures(a, percent)) & set(jaccard_join.signatures(b, percent))


@pytest.mark.parametrize("width", [200, 64, 8])
def test_suffix_dedup(docs, corpus, width):
    data = [(i, (t or "").encode()) for i, t in corpus]
    seen = Counter(d[p : p + width] for _, d in data for p in range(len(d) - width + 1))
    want = Counter()
    for i, d in data:
        gone = np.zeros(len(d) + 1, int)
        for p in range(len(d) - width + 1):
            if seen[d[p : p + width]] > 1:
                gone[p] += 1
                gone[p + width] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[i, len(d), int(gone.sum()), spans, bytes(np.frombuffer(d, np.uint8)[~gone])] += 1
    got = suffix_dedup.suffix_dedup(docs.withColumn("spans", docs.doc_id), width=width).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == want


def test_suffix_windows_of_very_common_grams(docs, monkeypatch):
    plain = suffix_dedup.suffix_dedup(docs).select("doc_id", "n_removed", "kept").collect()
    monkeypatch.setattr(suffix_dedup, "MANY", 1)
    assert Counter(plain) == Counter(suffix_dedup.suffix_dedup(docs).select("doc_id", "n_removed", "kept").collect())


@pytest.mark.parametrize(("cell", "pivots", "levels"), [(16, 32, 1), (6, 2, 3)])
def test_near_duplicate_vectors(spark, monkeypatch, cell, pivots, levels):
    monkeypatch.setattr(embedding_dedup, "CELL", cell)
    monkeypatch.setattr(embedding_dedup, "PIVOTS", pivots)
    seen, walked = [], embedding_dedup._near_cells
    monkeypatch.setattr(embedding_dedup, "_near_cells", lambda found, chord: seen.append(len(found)) or walked(found, chord))
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=(60, 16))
    near = base[rnd.integers(0, 60, 60)] + rnd.normal(size=(60, 16)) * 0.05
    rows = [(i, [float(x) for x in v], int(i % 2)) for i, v in enumerate(np.concatenate([base, near, base[:5]]))]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] + [1.0] * 15]
    rows += [(200 + i, v, 0) for i, v in enumerate(odd)] + [(300, rows[0][1], None)]
    # Vectors of other lengths link among themselves alone; copies of one vector are one point that no pivots part.
    rows += [(400, rows[0][1][:15], 0), (401, rows[0][1][:15], 0), (402, [*rows[0][1], 0.0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as node")
    links, root = Counter(), {r[0]: r[0] for r in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, v, a in rows[:125]:
        for j, w, b in rows[:i]:
            if a == b and i < 200 and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                links[i] += 1
                links[j] += 1
                p, q = sorted((top(i), top(j)))
                root[q] = p
    links[400], links[401], root[401] = 1, 1, 400
    want = {(i, links[i], top(i), top(i) == i) for i, _, _ in rows}
    assert links and {tuple(r) for r in embedding_dedup.near_duplicates(table).collect()} == want
    assert seen and min(seen) >= levels
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


def test_far_cells_never_meet(spark, monkeypatch):
    """Points along a circle: pairs of cells grow with the points, not with their square."""
    monkeypatch.setattr(embedding_dedup, "CELL", 16)
    monkeypatch.setattr(embedding_dedup, "PIVOTS", 8)
    share = {}
    for points in (300, 1800):
        angle = np.random.default_rng(5).uniform(0, 2 * np.pi, points)
        nodes = [(f"n{i}", 1, [float(np.cos(x)), float(np.sin(x))], 1) for i, x in enumerate(angle)]
        cells, levels = embedding_dedup._levels(spark.createDataFrame(nodes, "node string, label int, unit array<double>, copies int"))
        assert cells.count() == points and len(levels) > 1 and cells.groupBy("cell").count().where("count > 32").count() == 0
        many = cells.select("cell").distinct().count()
        share[points] = embedding_dedup._near_cells(levels, 0.001).count() / (many * (many + 1) / 2)
    assert share[1800] < share[300] / 3


def test_packing(spark, docs, corpus):
    rnd = random.Random(4)
    for capacity in (10, 64, 1024):
        for _ in range(8):
            want = {rnd.randint(1, capacity): rnd.randint(1, 200) for _ in range(rnd.randint(1, 150))}
            plan, got, full = packing.plan(want, capacity), Counter(), {}
            for length, first, last, sequence, each, base in plan.runs:
                assert first == got[length]
                got[length] = last
                for j in range(last - first):
                    full.setdefault(sequence + j // each, []).append((base + j % each * length, length))
            assert got == want and sorted(full) == list(range(plan.sequences))
            for places in full.values():
                places.sort()
                assert all(a + b == c for (a, b), (c, _) in zip(places, places[1:], strict=False)) and sum(places[-1]) <= capacity
    ranks = tokens.ranks_of(spark, public_tokenizers.path("byte_bpe_50k.json"))
    pieces = tokens.token_pieces(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, 64)
    packed = packing.pack(pieces.withColumn("mark", pieces.doc_id), ["doc_id", "piece", "start", "ids"], 64)
    joined = {r.sequence_id: (r.length, bytes(r.ids)) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        length, ids = joined[r.sequence_id]
        assert length <= 64 and ids[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    total = sum(n for n, _ in joined.values())
    assert len(joined) <= total / 64 * 1.1 + 2
    assert packing.pack(pieces.limit(0), ["doc_id", "piece", "start", "ids"], 64).count() == 0


def fewest(lengths, capacity):
    """The least number of sequences, by trying every place for each length, longest first."""
    best = len(lengths)

    def put(i, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if i == len(lengths):
            best = len(gaps)
            return
        for j, gap in enumerate(gaps):
            if gap >= lengths[i] and gap not in gaps[:j]:
                put(i + 1, [*gaps[:j], gap - lengths[i], *gaps[j + 1 :]])
        put(i + 1, [*gaps, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    put(0, [])
    return best


def test_packing_is_near_the_least(docs):
    rnd = random.Random(8)
    for _ in range(150):
        capacity = rnd.choice([10, 20, 1024])
        lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 9))]
        got = packing.plan(Counter(lengths), capacity).sequences
        assert fewest(lengths, capacity) <= got <= fewest(lengths, capacity) + (len(lengths) > 6)
    for seed in range(4):
        lengths = Counter(min(int(np.random.default_rng([seed, i]).lognormal(6, 1)) + 1, 1024) for i in range(3000))
        alone = packing.Plan(1024)
        for length in sorted(lengths, reverse=True):
            alone.best_fit(length, lengths[length])
        bound = -(-sum(length * n for length, n in lengths.items()) // 1024)
        got = packing.plan(lengths).sequences
        assert bound <= got <= min(alone.sequences, int(bound * 1.005) + 1)


def test_tokens_agree_with_the_library(spark, docs, corpus):
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ranks = tokens.ranks_of(spark, public_tokenizers.path("byte_bpe_50k.json"))
    got = Counter()
    for r in tokens.token_pieces(docs, ranks, public_tokenizers.PATTERN, 100).collect():
        got[r.doc_id, r.piece, r.start, r.length, bytes(r.ids)] += 1
    want = Counter()
    for i, text in corpus:
        ids, at, piece = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], 0, 0
        while at < len(ids):
            to = len(ids) - (len(ids) - at - 1) // 100 * 100
            want[i, piece, at, to - at, np.array(ids[at:to], "<u4").tobytes()] += 1
            at, piece = to, piece + 1
    assert got == want


def test_added_tokens_in_texts(spark, tmp_path):
    path, end = public_tokenizers.path("byte_bpe_50k.json"), "<|endoftext|>"
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(path)
    texts = [f"a{end}b", end, f"{end}{end}", f" {end} \n {end}  é", f"one  {end}  two  ", "<|endoftext|", "<|ENDOFTEXT|>", f"<|endof{end}text|>", "plain", f"{'x ' * 300}{end}" * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got: dict[int, list[int]] = {}
    for r in sorted(tokens.token_pieces(docs, tokens.ranks_of(spark, path), public_tokenizers.PATTERN, 100).collect(), key=lambda r: (r.doc_id, r.start)):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert got == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    assert got[0] == [64, 50256, 65, 2]
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    for change in ([{"lstrip": True}], [{"normalized": True}], [{}, {"content": f"{end}2", "id": 50257}]):
        odd = spec | {"added_tokens": [spec["added_tokens"][0] | c for c in change]}
        (tmp_path / "odd.json").write_text(json.dumps(odd))
        with pytest.raises(ValueError, match="added token"):
            tokens.ranks_of(spark, str(tmp_path / "odd.json"))


def test_token_shards(spark, docs, tmp_path):
    ranks = tokens.ranks_of(spark, public_tokenizers.path("byte_bpe_50k.json"))
    pieces = tokens.token_pieces(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, 32, width=2)
    index = token_output.write(pieces, str(tmp_path / "a"), 7, 32, ["doc_id", "piece"], shards=3).collect()
    again = token_output.write(pieces, str(tmp_path / "a"), 7, 32, ["doc_id", "piece"], shards=3).collect()
    assert Counter(index) == Counter(again) and sorted(r.slot for r in index) == list(range(len(index)))
    back = {r.slot: bytes(r.ids) for r in token_output.read(spark, str(tmp_path / "a")).collect()}
    want = Counter((r.doc_id, r.piece, bytes(r.ids)) for r in pieces.collect())
    assert Counter((r.doc_id, r.piece, back[r.slot]) for r in index) == want
    late = token_output.read(spark, str(tmp_path / "a"), from_slot=40).collect()
    assert {r.slot: bytes(r.ids) for r in late} == {s: x for s, x in back.items() if s >= 40}
    for r in index:
        with open(tmp_path / "a" / "shards" / "run=2" / f"shard-{r.shard:06d}.bin", "rb") as file:
            file.seek(r.byte_offset)
            assert int.from_bytes(file.read(4), "little") == r.length
    for total in (1, 2, 5, 100, 1025):
        assert sorted(token_output.permute(np.arange(total), total, 9).tolist()) == list(range(total))
    assert token_output.write(pieces.limit(0), str(tmp_path / "b"), 7, 32, ["doc_id"], shards=2).count() == 0


def test_a_shard_folder_is_used_again(spark, docs, tmp_path, monkeypatch):
    """Other splits give the same order, another key and other rows theirs; a broken run is never read; old runs go."""
    ranks = tokens.ranks_of(spark, public_tokenizers.path("byte_bpe_50k.json"))
    # A null id and null tokens are rows like others.
    rows = tokens.token_pieces(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, 32, width=2).select("doc_id", "piece", "ids")
    rows = spark.createDataFrame([*rows.collect(), (None, 0, None), (None, 0, b"\1\0")], rows.schema)
    folder = str(tmp_path / "again")

    def written(table, key, shards=3):
        index = token_output.write(table, folder, key, 32, ["doc_id", "piece"], shards=shards).collect()
        back = {r.slot: bytes(r.ids) for r in token_output.read(spark, folder).collect()}
        assert sorted(back) == sorted(r.slot for r in index) == list(range(table.count()))
        assert Counter((r.doc_id, r.piece, back[r.slot]) for r in index) == Counter((r.doc_id, r.piece, bytes(r.ids or b"")) for r in table.collect())
        return [back[slot] for slot in sorted(back)]

    first = written(rows.repartition(2), 7)
    assert written(rows.repartition(9), 7) == first and written(rows.repartition(9), 7, shards=5) == first
    other = written(rows, 8)
    assert other != first and Counter(other) == Counter(first)
    written(rows.where("doc_id % 2 = 0"), 8)
    with pytest.raises(Exception, match="does not fit"):
        token_output.write(rows, folder, 7, 2, ["doc_id", "piece"], shards=3)
    assert token_output.read(spark, folder).count() == rows.where("doc_id % 2 = 0").count()
    assert written(rows, 7) == first
    assert len(list((tmp_path / "again" / "shards").iterdir())) <= 3
    with pytest.raises(FileNotFoundError):
        token_output.read(spark, str(tmp_path / "never"))


def test_bpe_round_trip(spark, docs, corpus, nothing):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.round_trip(docs.withColumn("ids", docs.doc_id), ranks, public_tokenizers.PATTERN).collect()
    texts = Counter((i, tuple(known.encode_ordinary(t or "")), (t or "").encode()) for i, t in corpus)
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got) == texts
    own, rnd = bpe.Encoder(ranks, public_tokenizers.PATTERN), random.Random(1)
    for _ in range(400):
        alphabet = rnd.choice(["ab", "éü ab", "日本語 ", "  \n\t", "0123", "the ing", "\x1c\x85\xa0 x"])
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(80)))
        assert list(own.ids(text)) == known.encode_ordinary(text)
    assert len(own.ids("a" * 200_000)) and bpe.round_trip(nothing, ranks, public_tokenizers.PATTERN).count() == 0


def test_quality_measures(docs, corpus, nothing):
    want = Counter()
    for i, text in corpus:
        text = text or ""
        found = re.findall("[^\x20\x09-\x0d]+", text)
        runs = Counter(tuple(found[k : k + 5]) for k in range(len(found) - 4))
        hit = {k + j for k in range(len(found) - 4) if runs[tuple(found[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if x.strip("\x20\t\n\x0b\x0c\r")]
        failed = len(found) < 10 or 100 * len(hit) > 20 * len(found)
        want[i, len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed] += 1
    got = quality_rules.quality_rules(docs.withColumn("n_words", docs.doc_id)).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed) and any(r.kept for r in got)
    assert quality_rules.quality_rules(nothing).count() == 0


def test_quality_fences_reject_outliers(spark):
    rnd = random.Random(8)
    rows = [(i, words(rnd, 50), "en", f"s{i % 3}", 0) for i in range(60)]
    rows += [(100, " ".join(f"{w}###" for w in words(rnd, 50).split()), "en", "s0", 0), (101, words(rnd, 50), None, None, 0)]
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert not kept.pop(100) and all(kept.values())


def test_url_filter(spark):
    urls = [f"http://{a}.example.{t}/{p}/{i}" for i in range(12) for a in ("www", "m") for t in ("net", "com", "org") for p in ("en", "de", "fr")]
    odd = [None, "", "no scheme", "http://", "HTTP://A.NET", "http://A.Example.NET/en/x?y#z", "x://net/", "http://b.net?q", "ftp://org/fr/a://b/c", "http://xnet/"]
    rows = list(enumerate([*urls, *odd, *urls[:3]]))
    table = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "1 as score")
    got = {r.page_id: r for r in url_filters.url_filter(table).collect()}
    for i, url in rows:
        rest = (url or "").partition("://")[2]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fit = [x for x in url_filters.RULES if (host == x[0].split("/")[0] or host.endswith("." + x[0].split("/")[0])) and path.startswith(x[0][x[0].index("/") :])]
        best = max(fit, key=lambda x: len(x[0]), default=None)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best and best[0])
        assert got[i].verdict == best[1] if best else got[i].verdict in ("allow", "block")
    decided = [r for r in got.values() if r.rule]
    assert np.mean([(r.score >= 0.5) == (r.verdict == "block") for r in decided]) > 0.9
    assert url_filters.url_filter(table.limit(0)).count() == 0


def test_warc(spark, tmp_path):
    rnd = random.Random(6)
    bodies = [words(rnd, 30) for _ in range(20)]
    rows = [(i, f"http://a/{i} é" if i % 4 else None, bodies[i % 13] if i % 5 else None) for i in range(40)] + [(3, "http://a/3", bodies[3]), (None, "http://n/%20", "null key"), (99, "http://a", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as kind")
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        first[data] = min(first.get(data, i), i) if i is not None else first.get(data)
    for folder, roll in (("a", 500), ("b", 1 << 20)):
        manifest = warc.write(pages, str(tmp_path / folder), roll_bytes=roll, tasks=3).collect()
        for m in manifest:
            assert hashlib.sha256((tmp_path / folder / m.file).read_bytes()).hexdigest() == m.file_sha256
        got = warc.read(spark, str(tmp_path / folder)).collect()
        assert Counter((r.key, r.url) for r in got) == Counter((i, u) for i, u, _ in rows)
        leaders = Counter()
        for r in got:
            data = next((h or "").encode() for i, u, h in rows if (i, u) == (r.key, r.url))
            assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
            if r.record_type == "response":
                leaders[data] += 1
                assert r.key == first[data] and bytes(r.payload) == data and r.refers_to is None
            else:
                assert r.refers_to == first[data] and r.payload is None
        assert set(leaders.values()) == {1} and set(leaders) == set(first)
    assert len(list((tmp_path / "a").glob("*.warc.gz"))) > len(list((tmp_path / "b").glob("*.warc.gz")))
    small = warc.write(pages, str(tmp_path / "c"), least_bytes=1 << 20)
    assert small.count() and {r.record_type for r in warc.read(spark, str(tmp_path / "c")).collect()} == {"response"}
    assert warc.write(pages.limit(0), str(tmp_path / "d")).count() == 0 and warc.read(spark, str(tmp_path / "d")).count() == 0


def test_warc_large_keys(spark, tmp_path):
    low = (1 << 62) + 1
    # Neighbours that a double cannot tell apart; a payload met thrice, one met twice, one under a null key only, one shared with a null key.
    rows = [(low + i, f"http://a/{i}", body) for i, body in enumerate(["x", "y", "x", "z", "y", "x", "w"])]
    rows += [(None, "http://n/0", "null only"), (None, "http://n/1", "z"), (-low, "http://a/low", "v"), (-low - 2, "http://a/lower", "v")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    first: dict[str, int | None] = {}
    for i, _, body in rows:
        first[body] = i if first.get(body) is None else first[body] if i is None else min(i, first[body])
    manifest = warc.write(pages, str(tmp_path), tasks=1).collect()
    assert [(m.first_key, m.records) for m in manifest] == [(None, len(rows))]
    want = {(i, u, *(("response", None, body.encode()) if i == first[body] else ("revisit", first[body], None))) for i, u, body in rows}
    assert {(r.key, r.url, r.record_type, r.refers_to, r.payload and bytes(r.payload)) for r in warc.read(spark, str(tmp_path)).collect()} == want


def test_toxicity_held_out(spark, nothing):
    rnd = random.Random(9)
    bad = ["idiot", "scum", "loser"]
    rows = []
    for i in range(600):
        parts = words(rnd, rnd.choice([8, 60, 300])).split()
        if i % 4 == 0:
            parts.insert(rnd.randrange(len(parts)), rnd.choice(bad))
        rows.append((i, " ".join(parts), "en", "s", 0))
    rows += [(1000, None, "en", "s", 0), (1001, "", None, None, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    got = {r.doc_id: r for r in toxicity.score(docs.select("*", toxicity.held_out().alias("held_out"), docs.doc_id.alias("toxicity")), model).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.toxicity <= 1 for i, r in got.items())
    assert got[1000].toxicity == got[1001].toxicity
    assert np.mean([(got[i].toxicity >= 0.5) == (i % 4 == 0) for i in range(600) if got[i].held_out]) > 0.95
    empty = toxicity.fit(nothing, labels)
    assert toxicity.score(docs, empty).count() == len(rows) and toxicity.score(nothing, model).count() == 0


def test_one_document_of_each_group(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    rnd = random.Random(12)
    base = [words(rnd, 60) for _ in range(6)]
    near = [f"{text} more" for text in base]
    rows = [(1, base[0]), (1, near[0]), (1, base[0]), (1, base[1])]  # an id with two near copies, one of them twice, and with another text
    rows += [(0, near[1]), (5, base[2]), (5, near[2].replace("a", "A")), (5, base[2].replace("a", "A"))]  # a group headed by another id; two texts of one set
    rows += [(None, base[3]), (None, near[3]), (None, base[4]), (7, near[4]), (None, base[5]), (None, ""), (None, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    out = pipeline.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    low = {i: min((t for j, t in rows if j == i and t and t.lower().startswith(base[b])), key=lambda t: hashlib.sha256(t.encode()).hexdigest()) for i, b in ((1, 0), (5, 2), (None, 3))}
    want = [*low.items(), (0, near[1]), (7, near[4]), (None, base[5]), (None, ""), (None, None), (8, "")]
    assert got == Counter(want)


def test_pipeline_keeps_columns_of_any_name(spark, docs, tmp_path):
    """Names that the operators use inside, or give to their results, are ordinary columns of the input."""
    pipeline = pytest.importorskip("corpus_pipeline")
    names = ["n_words", "kept", "spans", "_id", "_hash", "_row", "_toxicity", "toxicity", "node", "key", "carried", "a.b", "n_bytes", "_text", "_words", "measure", "hash"]
    table = docs.select("*", *[pipeline.F.concat_ws(":", pipeline.F.lit(n), pipeline.F.col("doc_id").cast("string")).alias(n) for n in names])
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0), (2, 0), (3, 0), (12, 0), (65, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = plain = spark.read.parquet(f"{tmp_path}/documents.parquet")
    plain = plain.select(*docs.columns)
    for step, stage in pipeline.STAGES[:-1]:
        kept, plain = stage(spark, kept, str(tmp_path)), stage(spark, plain, str(tmp_path))
        assert kept.columns == table.columns, step
        kept.write.parquet(f"{tmp_path}/{step}")
        plain.write.parquet(f"{tmp_path}/{step}-plain")
        kept, plain = spark.read.parquet(f"{tmp_path}/{step}"), spark.read.parquet(f"{tmp_path}/{step}-plain")
        rows = kept.collect()
        assert Counter(map(tuple, kept.select(*docs.columns).collect())) == Counter(map(tuple, plain.collect()))
        assert all(r[n] == f"{n}:{r['doc_id']}" for r in rows for n in names), step


def test_jaccard_with_shared_and_null_ids(spark):
    """Keys that say nothing: the groups are those of the texts; a third of all rows is one row."""
    rnd = random.Random(4)
    base = [words(rnd, 40) for _ in range(6)]
    near = [" ".join([*b.split()[:-1], "changed"]) for b in base]
    table = spark.createDataFrame([(None, t) for t in base + near] + [(1, base[0])] * 8, "doc_id long, text string")
    got = jaccard_join.jaccard_components(table, words=3, percent=80).collect()
    assert len(got) == 20 and Counter(r.component_id for r in got) == {1: 10, None: 10}
    firsts = jaccard_join.jaccard_firsts(table, words=3, percent=80).collect()
    assert len(firsts) == 6 and sum(r.doc_id == 1 for r in firsts) == 1


def test_pipeline_stages(spark, docs, nothing, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    for name, table in (("some", docs), ("none", nothing)):
        folder = f"{tmp_path}/{name}"
        table.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
        kept = spark.read.parquet(f"{folder}/documents.parquet")
        for step, stage in pipeline.STAGES[:-1]:
            out = stage(spark, kept, folder)
            assert out.columns == docs.columns, step
            out.write.parquet(f"{folder}/{step}")
            kept = spark.read.parquet(f"{folder}/{step}")
        packed = pipeline.STAGES[-1][1](spark, kept, folder)
        assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in kept.collect()}
        assert pipeline.run(spark, folder).count() == packed.count()


def test_toxicity_of_texts_longer_than_a_block(monkeypatch):
    """Blocks overlap, so a long text has the features it would have in one piece."""
    rnd = random.Random(6)
    text = words(rnd, 300) + " idiot é " + words(rnd, 300)
    at = np.zeros(1 << toxicity.BITS, np.int32)
    whole = np.sort(toxicity.features(text, at))
    for block in (50, 64, 777):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        assert np.array_equal(np.sort(toxicity.features(text, at)), whole)
