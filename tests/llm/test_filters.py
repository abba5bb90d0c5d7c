"""Quality rules, language ID, language-model scoring, tokens: against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from sheafwork.llm import bpe, kneser_ney, langid, quality
from sheafwork.llm.queries import QUERIES, ranks_path

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile("[^\\x20\\x09-\\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    (1, "a b c d e f g h i j k l m n o p q r s t", "en", "x", 1),
    (2, None, None, None, None),
    (3, "", "en", "x", 0),
    (4, " \t\n\x0b\x0c\r ", "en", None, 7),
    (5, "#$ l1\nl1\n\n l1\nl1", "en", "y", 3),
    (5, "#$ l1\nl1\n\n l1\nl1", "en", "y", 3),
    (None, "One two three", "en", "x", 5),
    (6, "one two three four five six seven eight " * 3000, "en", "x", 5),
    (7, "123 456 !", "en", "x", 5),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def pair_bucket(a: str, b: str) -> int:
    seed = 42
    for w in (a, b):
        h = xxhash.xxh64_intdigest(w.encode(), seed=42)
        seed = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed=seed)
    return seed & (quality.BUCKETS - 1)


def base_counts(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_agrees_with_brute_force(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    trusted = {r["doc_id"] for r in labels.filter("quality = 1 AND toxic = 0").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    raw, good = Counter(), Counter()
    pairs = {}
    for doc_id, text in texts.items():
        words = WORD.findall(text or "")
        pairs[doc_id] = [pair_bucket(a, b) for a, b in zip(words, words[1:])]
        raw.update(pairs[doc_id])
        if doc_id in trusted:
            good.update(pairs[doc_id])
    n_raw, n_good, size = sum(raw.values()), sum(good.values()), quality.BUCKETS
    ratio = [
        round((math.log((good[b] + 1) / (n_good + size)) - math.log((raw[b] + 1) / (n_raw + size))) * quality.SCALE)
        for b in range(size)
    ]
    found = quality.judged(docs, labels).collect()
    assert len(found) == len(texts)
    for r in found:
        counts = base_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        own = pairs[r["doc_id"]]
        score = sum(ratio[b] for b in own) / len(own) / quality.SCALE if own else None
        assert r["base_failed"] == failed
        assert (r["score"] is None) == (score is None) and (score is None or abs(r["score"] - score) < 1e-4)
        if score is None or abs(score - quality.THRESHOLD) > 1e-4:
            assert r["kept"] == (not failed and score is not None and score >= quality.THRESHOLD)


def test_quality_keeps_good_and_drops_bad(spark):
    """Documents that pass the base rules; held-out trusted ones are not in the trusted counts."""
    sf_dir = SF_DIR.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    labels = labels.withColumn("held", quality.held_out(F.col("doc_id")))
    rows = QUERIES["op1_quality_rules"](spark, sf_dir).filter("NOT base_failed").join(labels, "doc_id").collect()
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    good = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0 and r["held"]]
    assert len(bad) >= 10 and len(good) >= 30
    assert sum(bad) / len(bad) < 0.2 and sum(good) / len(good) > 0.95


def test_quality_threshold_of_held_out_scores(spark):
    scores = [(i, False, i / 100 + 0.001) for i in range(200)] + [(500, True, -9.0), (501, False, None), (502, False, -5.0)]
    scored = spark.createDataFrame(scores, "doc_id bigint, base_failed boolean, score double")
    held = spark.createDataFrame([(i,) for i in [*range(200), 500, 501]], "doc_id bigint")
    found = quality.held_out_threshold(scored, held).first()["threshold"]
    assert sum(s < found for _, _, s in scores[:200]) == 2 and scores[2][2] - found < 1 / quality.STEPS
    assert quality.held_out_threshold(scored, held.limit(0)).first()["threshold"] == quality.THRESHOLD


def test_quality_of_odd_rows(spark, odd):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (None, 1, 0), (6, 1, None)], "doc_id bigint, quality int, toxic int"
    )
    got = Counter(
        (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        for r in quality.judged(odd.withColumn("bucket", F.lit(1)).withColumn("score", F.lit("x")), labels).collect()
    )
    assert got == Counter((r[0], *base_counts(r[1])) for r in ODD)
    assert {r["doc_id"] for r in quality.trusted_ids(labels).collect()} == {6}
    assert quality.judged(odd.limit(0), labels.limit(0)).count() == 0
    assert quality.judged(odd, labels.limit(0)).count() == len(ODD)


def test_language_on_held_out_documents(spark, docs):
    found = QUERIES["op3_language_id"](spark, SF_DIR.replace("0.001", "0.01"))
    truth = spark.read.parquet(SF_DIR.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert held and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert sum(r["rejected"] for r in rows) / len(rows) < 0.02
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(spark, docs, odd):
    model = langid.train(docs)
    out = langid.identified(odd.withColumn("score", F.lit("kept? no")).withColumn("Lang", F.lit(1)).drop("lang"), model)
    found = {(r["doc_id"], (r["text"] or "")[:5]): r for r in out.collect()}
    assert out.count() == len(ODD)
    for key in ((2, ""), (3, ""), (4, " \t\n\x0b\x0c"), (7, "123 4")):
        assert (found[key]["lang_pred"], found[key]["score"], found[key]["rejected"]) == ("und", 0.0, True)
    assert found[(6, "one t")]["lang_pred"] in model.languages
    nothing = langid.train(odd.limit(0))
    assert {r["lang_pred"] for r in langid.identified(odd, nothing).collect()} == {"und"}
    assert langid.identified(odd.limit(0), model).count() == 0
    again = langid.train(docs.repartition(3))
    assert np.array_equal(again.table, model.table) and again.temperature == model.temperature


def test_folded_table_equals_a_forward_pass():
    """The table of log odds gives what mean embedding, weights and bias give."""
    rng = np.random.default_rng(1)
    embeddings, weights, bias = rng.normal(size=(langid.BUCKETS, 5)), rng.normal(size=(5, 3)), rng.normal(size=3)
    model = langid.Model(["a", "b", "c"], embeddings @ weights, bias, 1.7)
    texts = ["One two", "drei vier fünf", "x", "x" * 3000, "123 ?"]
    for k, text in enumerate(texts):
        data = re.sub(b"[ \\t-\\r]", b" ", text.lower().encode())
        grams = []
        for size, factor in zip(langid.SIZES, langid._HASHES):
            for at in range(len(data) - size + 1):
                gram = data[at : at + size]
                if b" " in gram[1:-1] or gram[:1] == gram[-1:] == b" ":
                    continue
                h = ((int.from_bytes(gram, "big") ^ size) * factor) & 0xFFFFFFFF
                grams.append(((h ^ (h >> 15)) >> 17) & 0x7FFF)
        z = ((embeddings[grams].mean(axis=0) @ weights if grams else 0) + bias) / 1.7
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        found, score, _ = model.predict(pa.array(texts))
        letters = any(map(str.isalpha, text))
        assert found[k] == ("abc"[p.argmax()] if letters else "und")
        assert score[k] == pytest.approx(p.max() if letters else 0.0, abs=1e-9)


def test_temperature_calibrates():
    """Of logits scaled up threefold, the fitted temperature finds the scale again."""
    rng = np.random.default_rng(2)
    z = rng.normal(size=(4000, 3))
    target = np.array([rng.choice(3, p=p) for p in langid.softmax(z)])
    assert langid.temperature(3 * z, target) == pytest.approx(3, rel=0.15)
    p = langid.softmax(3 * z / langid.temperature(3 * z, target))
    sure = p.max(axis=1) > 0.7
    assert (p.argmax(axis=1) == target)[sure].mean() == pytest.approx(p.max(axis=1)[sure].mean(), abs=0.04)


def test_sample_is_bounded_and_exact(spark):
    rows = [(f"text {i % 90}", f"l{i % 3}") for i in range(900)] + [("copy", "l0")] * 500 + [("rare", "zz"), (None, "l0"), ("x", None)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = langid.sample(docs, per_language=20, languages=3).collect()
    assert Counter(r["lang"] for r in found) == {"l0": 20, "l1": 20, "l2": 20}
    for lang in ("l0", "l1", "l2"):
        texts = {t for t, own in rows if own == lang and t is not None}
        least = sorted(texts, key=lambda t: np.uint64(xxhash.xxh64_intdigest(t.encode(), seed=42)).astype(np.int64))[:20]
        assert {r["text"] for r in found if r["lang"] == lang} == set(least)


def brute_kneser_ney(train: list[str], texts: list[str]) -> list[float]:
    tokens = lambda t: [*WORD.findall(t.translate(LOWER)), None]
    pairs, words = Counter(), Counter()
    for t in train:
        own = tokens(t)
        words.update(own)
        pairs.update(zip([0, *own[:-1]], own))
    before = Counter(w for _, w in pairs)
    low = kneser_ney._discounts([sum(v == k for v in before.values()) for k in (1, 2, 3, 4)])
    high = kneser_ney._discounts([sum(v == k for v in pairs.values()) for k in (1, 2, 3, 4)])
    total, size = len(pairs), len(words)
    rest = sum(low[min(v, 3)] for v in before.values()) / total if total else 1.0
    p0 = lambda w: max(before[w] - low[min(before[w], 3)], 0) / max(total, 1) + rest / (size + 1)
    sums, taken = Counter(), Counter()
    for (v, _), c in pairs.items():
        sums[v] += c
        taken[v] += high[min(c, 3)]

    def p(v, w):
        c = pairs[v, w]
        return (max(c - high[min(c, 3)], 0) + taken[v] * p0(w)) / sums[v] if sums[v] else p0(w)

    if words:  # the probabilities of all words and of one never seen add up to 1
        for v in [0, *list(words)[:5]]:
            assert abs(sum(p(v, w) for w in words) + p(v, "\x00 never") - 1) < 1e-9
    return [sum(math.log10(p(v, w)) for v, w in zip([0, *tokens(t)[:-1]], tokens(t))) for t in texts]


def test_kneser_ney_agrees_with_brute_force(spark, docs, odd):
    for table in (docs, odd):
        rows = [(r["doc_id"], r["text"] or "") for r in table.collect()]
        keep = lambda i: i is None or i % 3 != 0
        train = table.filter("doc_id IS NULL OR doc_id % 3 <> 0")
        expected = brute_kneser_ney([t for i, t in rows if keep(i)], [t for _, t in rows])
        out = kneser_ney.scored(table.withColumn("score", F.lit("replaced")), kneser_ney.train(train)).collect()
        got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in out))
        want = sorted((i is None, i or 0, s) for (i, _), s in zip(rows, expected))
        assert len(got) == len(want)
        for a, b in zip(got, want):
            assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9)


def test_kneser_ney_without_training(spark, odd):
    model = kneser_ney.train(odd.limit(0))
    rows = kneser_ney.scored(odd, model).collect()
    assert all(r["score"] == pytest.approx(0) and r["n_known"] == 0 for r in rows)
    assert kneser_ney.scored(odd.limit(0), model).count() == 0


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path(), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    "", "don't we'll I'm 'tis ''s  x\n\n y \t z   a's", "  lead", "trail  ", "日本語テキスト １２３ ½ 12ab", "a" * 300,
    " '' 'S it's-they've'd", "\r\n\r\n x", "<|endoftext|> hi", "é̀ combining​ zero", "x" * 500 + "ab" * 300,
    "🙂🙂 ok's", "\x1c\x1d a\x1f b", "'", "a'", "' s", "'re", "'r e'v", "　  z", "a b",
]


def test_bpe_agrees_with_the_library(tiktoken_encoding):
    coder = bpe.Coder(ranks_path())
    out = coder.rows(pa.array(range(len(TEXTS))), pa.array(TEXTS)).to_pydict()
    for text, ids, n, decoded in zip(TEXTS, out["ids"], out["n_tokens"], out["decoded"]):
        expected = tiktoken_encoding.encode_ordinary(text)
        assert ids == ",".join(map(str, expected)) and n == len(expected) and decoded == text.encode()


def long_pieces(n: int) -> list[str]:
    rng = random.Random(n)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    return ["".join(rng.choices(letters, k=n)), "=" * n, "x" * (n - 1) + "the" * 40, "".join(rng.choices("日本語テキスト文字", k=2000))]


@pytest.mark.parametrize("n", [20_000, 200_000])
def test_bpe_of_very_long_pieces(tiktoken_encoding, n):
    coder = bpe.Coder(ranks_path())
    for text in long_pieces(n):
        (ids,) = coder.rows(pa.array([0]), pa.array([text])).to_pydict()["ids"]
        assert ids == ",".join(map(str, tiktoken_encoding.encode_ordinary(text)))


def test_bpe_of_very_long_pieces_of_few_letters(tiktoken_encoding):
    rng = random.Random(3)
    texts = ["".join(rng.choices(rng.sample("abcdehinorst=-", 3), k=rng.randrange(1, 900))) for _ in range(400)]
    found = bpe.Coder(ranks_path()).rows(pa.array(range(len(texts))), pa.array(texts)).to_pydict()["ids"]
    assert found == [",".join(map(str, tiktoken_encoding.encode_ordinary(t))) for t in texts]


def test_bpe_of_tables(spark, docs, odd, tiktoken_encoding, monkeypatch):
    out = {r["doc_id"]: r for r in QUERIES["op4_byte_bpe"](spark, SF_DIR).collect()}
    sha = lambda data: hashlib.sha256(data).hexdigest()
    for r in docs.collect():
        ids = ",".join(map(str, tiktoken_encoding.encode_ordinary(r["text"])))
        assert out[r["doc_id"]]["ids_sha256"] == sha(ids.encode())
        assert out[r["doc_id"]]["decoded_sha256"] == sha(r["text"].encode())
    rows = bpe.encoded(odd.withColumn("ids", F.lit(1)).filter("doc_id IS NULL OR doc_id <> 6"), ranks_path()).collect()
    assert Counter(bytes(r["decoded"]) for r in rows) == Counter((t or "").encode() for i, t, *_ in ODD if i != 6)
    assert bpe.encoded(odd.limit(0), ranks_path()).count() == 0
    # A task that forgets its pieces all the time gives the same.
    coder = bpe.Coder(ranks_path())
    monkeypatch.setattr(bpe, "REMEMBERED", 0)
    again = [coder.rows(pa.array([i]), pa.array([t])).to_pydict()["ids"][0] for i, t in enumerate(TEXTS)]
    assert again == [",".join(map(str, tiktoken_encoding.encode_ordinary(t))) for t in TEXTS]
