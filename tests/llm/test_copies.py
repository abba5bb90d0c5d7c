"""Near copies, repeated passages, chunks, search: against brute force and on odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sheafwork.llm import chunk_dedup, ngram_join, suffix_dedup, topk
from sheafwork.llm.components import components
from sheafwork.llm.words import batch_words

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)


def words(rng, n):
    return [f"w{rng.randrange(400)}" for _ in range(n)]


def copies(seed: int, groups: int, each: int, n: int) -> list[tuple[int, str]]:
    """Groups of near copies: each copy has some words changed, dropped or added."""
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        base = words(rng, rng.randrange(1, n))
        for _ in range(each):
            own = list(base)
            for _ in range(rng.randrange(0, max(2, len(own) // 25))):
                at = rng.randrange(len(own))
                own[at : at + rng.randrange(2)] = words(rng, rng.randrange(3))
                own = own or ["x"]
            rows.append((len(rows), " ".join(own)))
    rng.shuffle(rows)
    return rows


def brute_components(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in w]
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def components_found(df, n, percent):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.joined(df, n, percent).collect()}


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80), (2, 50)])
def test_join_agrees_with_brute_force(spark, n, percent):
    rows = copies(n, 40, 6, 120) + [(1000, "A b C"), (1001, "a B c"), (1002, "a b"), (1003, ""), (1004, None), (1005, " ")]
    assert components_found(table(spark, rows), n, percent) == brute_components(rows, n, percent)


def test_join_over_many_blocks(spark, monkeypatch):
    """A group cut into many blocks, few pivots, so that blocks have to be compared with each other."""
    rows = copies(9, 3, 60, 90)
    monkeypatch.setattr(ngram_join, "BLOCK", 500)
    monkeypatch.setattr(ngram_join, "PIVOTS", 1)
    assert components_found(table(spark, rows), 4, 85) == brute_components(rows, 4, 85)


def test_every_search_merges_its_short_lists_in_a_heap(monkeypatch):
    """Whatever the weight of a probe, and however long the lists."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 200).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, 185, replace=False), rng.integers(0, 2**63, 6).astype(np.uint64)])) for _ in range(60)]
    nodes, merges, searches = np.arange(60), [], []
    merged, search = ngram_join.merged, ngram_join.Block.search
    monkeypatch.setattr(ngram_join, "merged", lambda lists, least: merges.append(least) or merged(lists, least))
    monkeypatch.setattr(ngram_join.Block, "search", lambda *given: searches.append(given) or search(*given))
    linked = [[100 * len(a := np.intersect1d(s, t)) >= 85 * (len(s) + len(t) - len(a)) for t in sets] for s in sets]
    expected = np.arange(60)
    for _ in range(60):
        expected = np.array([min(expected[row]) for row in linked])
    for weight in (10.0, 1.0, 0.01):
        monkeypatch.setattr(ngram_join, "PROBE_WEIGHT", weight)
        assert ngram_join.linked_classes(nodes, sets, 85).tolist() == expected.tolist()
    assert len(merges) == len(searches)


def test_join_finds_links_of_every_text_of_an_id(spark):
    a, b = (" ".join(f"{w}{k}" for k in range(30)) for w in "ab")
    rows = [(1, a), (1, b), (2, b + " more"), (3, a)]
    for own in (rows, rows[::-1]):
        found = ngram_join.joined(table(spark, own)).select("doc_id", "component_id").distinct()
        assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 1), (3, 1)]


def test_join_of_odd_rows(spark):
    rows = [(7, "a b c d e"), (7, "a b c d e"), (3, "a b c d e"), (None, "a b c d e"), (8, "x " * 50_000)]
    df = table(spark, rows).withColumn("node", F.lit("clash")).withColumn("component_id", F.lit(0))
    got = Counter(tuple(r) for r in ngram_join.joined(df).collect())
    assert got == Counter([(7, 2, 3), (7, 2, 3), (3, 2, 3), (None, 2, None), (8, 1, 8)])
    assert ngram_join.joined(df.limit(0)).count() == 0


def test_routing_meets_every_linked_pair():
    """Any two sets within the bound share a routing key."""
    rng = np.random.default_rng(3)
    routing = ngram_join.Routing(85)
    for size in [*range(1, 40), 100, 317, 1000]:
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            drop = rng.integers(0, max(1, size * 15 // 100) + 1)
            b = np.unique(np.concatenate([rng.choice(a, size - drop, replace=False), rng.integers(0, 2**64, rng.integers(0, 1 + size * 8 // 100), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both) and both < len(a) + len(b) - both:
                assert np.intersect1d(routing.keys(a), routing.keys(b)).size, (size, drop)


@pytest.mark.parametrize("name_bits", [40, 8])
def test_only_sets_with_shingles_in_others_may_link(spark, monkeypatch, name_bits):
    """With the whole of the hashes as the sample: those with enough of their shingles in other sets, however often and
    in however many tasks a set comes. Sets whose names are equal pass."""
    rng = random.Random(6)
    rows = copies(8, 15, 4, 80) + [(1000 + k, " ".join(words(rng, 40))) for k in range(150)]
    # Two halves of other texts: no link, but every shingle but those in the middle is in another set.
    rows += [(2000, " ".join([*rows[0][1].split(), *rows[1][1].split()])), (2001, None), (2002, " "), (2003, "a")]
    rows += [(3000 + i, t) for i, t in rows if t]
    monkeypatch.setattr(ngram_join, "SAMPLED", 100)
    monkeypatch.setattr(ngram_join, "NAME_BITS", name_bits)
    own = {}
    for _, text in rows:
        for s in ngram_join.shingle_sets(pa.array([text], pa.string()), 4):
            if len(s):
                own[ngram_join.digest(s)] = s
    counts = Counter(x for s in own.values() for x in s.tolist())
    expected = {d for d, s in own.items() if 100 * sum(counts[x] > 1 for x in s.tolist()) >= 85 * len(s)}
    assert 10 < len(expected) < len(own) - 100
    for tasks in (1, 7):
        found = [r["node"] for r in ngram_join.able_nodes(table(spark, rows).repartition(tasks), 4, 85).collect()]
        assert len(found) == len({*found}) and expected <= {*found}
        assert {*found} == expected if name_bits == 40 else {*found} <= {*own}


def test_documents_that_cannot_link_take_no_part_in_the_search(spark, monkeypatch):
    """A line that all share, and words that come again and again, tied unrelated documents into one group."""
    rng = random.Random(7)
    line = words(rng, 10)
    rows = [(i, " ".join([*(f"v{rng.randrange(5000)}" for _ in range(90)), *line])) for i in range(400)]
    rows += [(1000 + i, f"{rows[i][1]} {line[0]}") for i in range(12)]
    searched, candidate_edges = [], ngram_join.candidate_edges
    monkeypatch.setattr(ngram_join, "candidate_edges", lambda docs, *given: searched.append(docs) or candidate_edges(docs, *given))
    found = components_found(table(spark, rows), 4, 85)
    assert found == brute_components(rows, 4, 85)
    ids = {r["doc_id"] for r in searched[0].collect()}
    # The sample of a short text may be small by chance; few of those pass.
    assert {*range(12), *range(1000, 1012)} <= ids and len(ids) < 60


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, k) for k in range(101, 140)] + [(200, 201), (5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def planted(seed=2, docs=60):
    """Random texts, of which some share a passage of 50 to 80 words."""
    rng, rows, held = random.Random(seed), [], defaultdict(list)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    passages = [[word() for _ in range(rng.randrange(50, 80))] for _ in range(6)]
    for i in range(docs):
        own = [word() for _ in range(rng.randrange(0, 200))]
        if i % 3 == 0:
            at, p = rng.randrange(len(own) + 1), rng.randrange(len(passages))
            own[at:at] = passages[p]
            held[p].append((i, at, at + len(passages[p])))
        rows.append((i, " ".join(own)))
    return rows, held


def test_repeated_passages_are_found_whole_and_nothing_else(spark):
    rows, held = planted()
    found = defaultdict(set)
    for r in suffix_dedup.repeated_spans(table(spark, rows)).collect():
        for s in r["spans"]:
            found[r["doc_id"]].update(range(s["start"], s["end"]))
    expected = defaultdict(set)
    for places in held.values():
        for i, a, b in sorted(places)[1:]:
            expected[i].update(range(a, b))
    assert {i: v for i, v in found.items()} == {i: v for i, v in expected.items()}


def test_cut_texts_keep_originals_and_clean_texts(spark):
    rows, held = planted()
    out = {r["doc_id"]: r["text"] for r in suffix_dedup.without_repeats(table(spark, rows)).collect()}
    repeated = {i for places in held.values() for i, *_ in sorted(places)[1:]}
    for i, text in rows:
        if i not in repeated:
            assert out[i] == text
    for places in held.values():
        for i, a, b in sorted(places)[1:]:
            left = WORD.findall(rows[i][1])
            rest = left[:a] + left[b:]
            assert WORD.findall(out.get(i, "")) == rest


def test_suffixes_of_odd_rows(spark):
    long = " ".join(f"q{k}" for k in range(30_000))
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [
        (1, None), (2, ""), (3, passage), (3, passage), (None, passage), (4, f"x {passage} y"), (5, long), (6, f"a {long}"),
        (7, f"{passage} z {passage}"), (8, "r " * 300),
    ]
    df = table(spark, rows).withColumn("mark", F.lit(1)).withColumn("spans", F.lit("s")).withColumn("_spans2", F.lit(0))
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in suffix_dedup.repeated_spans(df).collect()}
    assert spans[4] == [(1, 61)] and spans[6] == [(1, 30_001)] and spans[7] == [(0, 60), (61, 121)]
    assert set(spans) <= {4, 6, 7, 8}
    kept = suffix_dedup.without_repeats(df)
    texts = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert texts[(3, passage)] == 2 and texts[(None, passage)] == 1 and texts[(1, None)] == 1 and texts[(2, "")] == 1
    assert texts[(4, "x y")] == 1 and texts[(5, long)] == 1 and kept.columns == df.columns
    assert suffix_dedup.without_repeats(df.limit(0)).count() == 0


def test_chunks_put_texts_together_again():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdé日 \n") for _ in range(rng.randrange(3000))) for _ in range(30)] + ["", "x", "é" * 700]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    for text, borders in zip(texts, chunk_dedup.cuts(data, offsets)):
        own = data.tobytes()
        assert b"".join(own[a:b] for a, b in zip(borders, borders[1:])).decode() == text
        assert all(b - a <= chunk_dedup.LARGEST + 3 for a, b in zip(borders, borders[1:]))
        for a, b in zip(borders, borders[1:]):
            own[a:b].decode()


def test_chunks_agree_with_brute_force(spark):
    rows, held = planted(4)
    rows += [(90, None), (91, ""), (92, rows[3][1]), (92, rows[3][1]), (None, rows[3][1])]
    seen, first = {}, {}
    expected = defaultdict(set)
    for i, text in sorted((r for r in set(rows) if r[0] is not None and r[1]), key=lambda r: r[0]):
        data = text.encode()
        (borders,) = chunk_dedup.cuts(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        own = []
        for a, b in zip(borders, borders[1:]):
            if data[a:b] in seen:
                if own and own[-1][1] == a:
                    own[-1][1] = b
                else:
                    own.append([a, b])
            seen.setdefault(data[a:b], (i, a))
        spans = [tuple(s) for s in own if s[1] - s[0] >= chunk_dedup.LEAST]
        if spans:
            expected[i] = spans
    df = table(spark, rows).withColumn("digest", F.lit(1))
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in chunk_dedup.repeated_spans(df).collect()}
    assert got == dict(expected)
    later = {i for places in held.values() for i, *_ in sorted(places)[1:]}
    assert later <= set(got) and set(got) <= later | {92}
    assert chunk_dedup.repeated_spans(df.limit(0)).count() == 0


def brute_topk(rows, is_query, k):
    vectors = {}
    out = set()
    usable = [(i, np.floor(256 * np.array(v, float))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for i, v in usable:
        if is_query(i):
            near = sorted((-int(v @ w), j) for j, w in usable if j != i and len(w) == len(v))[:k]
            out |= {(i, n, j, -s) for n, (s, j) in enumerate(near, 1)}
    return out


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_search_agrees_with_brute_force(spark, monkeypatch, spread):
    rng = np.random.default_rng(8)
    lengths = np.exp(spread * rng.normal(size=300))
    data = rng.normal(size=(300, 8)) * lengths[:, None]
    data[100:160] = data[100]
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(data)]
    rows += [(300, None), (301, []), (302, [float("nan")] * 8), (303, [None] + [1.0] * 7), (304, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(i, [1.0, float(i)]) for i in range(310, 316)] + [(350, [0.0] * 8), (360, [-1.0] * 3)]
    monkeypatch.setattr(topk, "BUCKET", 40)
    monkeypatch.setattr(topk, "QUERIES", 7)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("block", F.lit("clash"))
    got = {tuple(r) for r in topk.search(df, F.col("vec_id") % 5 == 0).collect()}
    assert got == brute_topk(rows, lambda i: i % 5 == 0, 5)
    assert topk.search(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_words_are_cut_as_the_pattern_does():
    import pyarrow as pa

    texts = ["a bb\tccc", None, "", " x", "y ", "é é z\x0bq", "A a", "w" * 5000 + " " + "w" * 5001]
    hashes, starts = batch_words(pa.array(texts), lower=True)
    counts = [len(WORD.findall(t or "")) for t in texts]
    assert np.diff(starts).tolist() == counts
    named = defaultdict(set)
    for t, a in zip(texts, starts):
        for k, w in enumerate(WORD.findall((t or "").replace("A", "a"))):
            named[w].add(int(hashes[a + k]))
    assert all(len(v) == 1 for v in named.values()) and len({min(v) for v in named.values()}) == len(named)
