"""Language identification, language-model scoring, quality rules and toxicity."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignlens.llm import kneser_ney, langid, quality, toxicity
from campaignlens.llm.common import Workspace, in_fold
from tests.llm.conftest import ROWS

DATA = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def small(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_language_of_held_out_texts(corpus):
    training = corpus.filter(~in_fold(F.col("doc_id"), 4, 2))
    found = langid.identify(corpus, langid.train(training)).join(corpus.select("doc_id", "lang"), "doc_id")
    held = found.filter("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in held)


def test_language_of_odd_documents(corpus, odd_docs, no_docs):
    model = langid.train(corpus)
    rows = langid.identify(odd_docs, model).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if r["doc_id"] in (3, 4, 5, 7):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
    kept = langid.kept_documents(odd_docs, model)
    assert kept.columns == odd_docs.columns and not {3, 4, 5, 7} & {r["doc_id"] for r in kept.collect()}
    assert langid.identify(no_docs, model).count() == 0
    untrained = langid.identify(odd_docs, langid.train(no_docs)).collect()
    assert {r["lang_pred"] for r in untrained} == {"und"}


def brute_bigrams(texts: list[str | None]):
    c, pairs = Counter(), Counter()
    for t in texts:
        tokens = [*small(t), "</s>"]
        c.update(tokens)
        pairs.update(zip(["<s>", *tokens[:-1]], tokens))
    continuation, context, kinds = Counter(w for _, w in pairs), Counter(), defaultdict(lambda: [0, 0, 0])
    for (u, _), n in pairs.items():
        context[u] += n
        kinds[u][min(n, 3) - 1] += 1
    d2 = kneser_ney.discounts([sum(v == k for v in pairs.values()) for k in (1, 2, 3, 4)])
    d1 = kneser_ney.discounts([sum(v == k for v in continuation.values()) for k in (1, 2, 3, 4)])
    mass = sum(d1[min(n, 3) - 1] for n in continuation.values()) / len(pairs)

    def p(u, w):
        low = (max(continuation[w] - (0, *d1)[min(continuation[w], 3)], 0)) / len(pairs) + mass / (len(c) + 1)
        if not context[u]:
            return low
        direct = max(pairs[u, w] - (0, *d2)[min(pairs[u, w], 3)], 0) / context[u]
        return direct + sum(a * b for a, b in zip(d2, kinds[u])) / context[u] * low

    return c, p


def test_kneser_ney_against_brute_force(corpus, odd_docs, spark):
    docs = corpus.select("doc_id", "text").limit(150).union(odd_docs.select("doc_id", "text"))
    texts = [r["text"] for r in docs.collect()]
    training = docs.filter("doc_id % 3 <> 1 or doc_id is null")
    c, p = brute_bigrams([r["text"] for r in training.collect()])
    model = kneser_ney.train(training, Workspace(spark), pairs_per_shard=3000)
    assert model.pair_shards > 3 and model.tokens == sum(c.values()) and model.types == len(c)
    assert sum(p("the", w) for w in c) + p("the", "unseen") == pytest.approx(1)
    got = Counter((r["n_tokens"], r["n_known"], round(r["base_score"], 4), round(r["score"], 4)) for r in kneser_ney.score(docs, model).collect())
    expected: Counter = Counter()
    n, v = sum(c.values()), len(c)
    for t in texts:
        tokens = [*small(t), "</s>"]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        score = sum(math.log10(p(u, w)) for u, w in zip(["<s>", *tokens[:-1]], tokens))
        expected[len(tokens), sum(c[w] > 0 for w in tokens), round(base, 4), round(score, 4)] += 1
    assert sum((got - expected).values()) <= 1  # a last digit may round the other way


def test_kneser_ney_without_training(odd_docs, no_docs, spark):
    model = kneser_ney.train(no_docs, Workspace(spark))
    rows = kneser_ney.score(odd_docs, model).collect()
    assert len(rows) == len(ROWS) and all(r["score"] == 0 and r["n_known"] == 0 for r in rows)
    assert kneser_ney.score(no_docs, model).count() == 0


def plain_surface(text: str | None) -> tuple:
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_surface_counts(corpus, odd_docs):
    texts = [r["text"] for r in corpus.limit(200).collect()] + [t for _, t, *_ in ROWS]
    for text in texts:
        data = (text or "").encode()
        assert quality.surface(data, data.split()) == plain_surface(text)


def test_character_model_adds_up_to_one(spark, odd_docs):
    docs = spark.createDataFrame([(1, "abc abd abc bcd bcd bcd abcab"), (2, "dab cab abc")], "doc_id long, text string")
    model = quality.train(docs, Workspace(spark), order=3)
    # all words of up to two letters and their rest add up: P(first letter) over the alphabet and the unknown bytes
    first = {b for t in ("abc", "bcd", "dab", "cab") for b in t}
    prefix = {}
    for letter in sorted(first):
        word = letter.encode()
        prefix[letter] = word_prefix(model, word)
    end = word_prefix(model, b" ")
    unknown = word_prefix(model, b"z")
    assert sum(prefix.values()) + end + unknown == pytest.approx(1, abs=1e-6)


def word_prefix(model, byte: bytes) -> float:
    """Probability of a byte after the opening boundary: a longer word's over that of its rest."""
    lengths, codes, number = next(quality._grams([byte], model.order))
    p = 1.0 / (model.types + 1)
    for n in range(1, int(lengths[0]) + 1):
        gram = codes[:1] & np.uint64((1 << (8 * n)) - 1)
        (count,) = quality._looked_up(f"{model.location}/grams{n}", gram, ("count",), model.shards[n - 1])
        total, *kinds = quality._looked_up(f"{model.location}/contexts{n}", gram >> np.uint64(8), ("total", "once", "twice", "more"), model.shards[n - 1])
        d = model.discounts[n - 1]
        if total[0]:
            p = float(kneser_ney.discounted(count, d)[0] / total[0] + sum(a * k[0] for a, k in zip(d, kinds)) / total[0] * p)
    return p


def plain_perplexities(texts: list[str], order: int) -> list[float]:
    """Kneser-Ney over bytes of words with dictionaries, text by text."""
    raw: dict = defaultdict(Counter)

    def grams(word: bytes):
        framed = b" " + word + b" "
        for i in range(1, len(framed)):
            n = min(i + 1, order)
            yield framed[i + 1 - n : i + 1]

    for text in texts:
        for word in text.encode().lower().split():
            for gram in grams(word):
                raw[len(gram)][gram] += 1
    levels = {order: Counter(raw[order])}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(gram[1:] for gram in levels[n + 1]) + raw[n]
    kinds, totals, cuts = {}, {}, {}
    for n, level in levels.items():
        cuts[n] = kneser_ney.discounts([sum(c == k for c in level.values()) for k in range(1, 5)])
        totals[n], kinds[n] = Counter(), defaultdict(lambda: [0, 0, 0])
        for gram, c in level.items():
            totals[n][gram[:-1]] += c
            kinds[n][gram[:-1]][min(c, 3) - 1] += 1

    def probability(gram: bytes) -> float:
        p = 1 / (len(levels[1]) + 1)
        for n in range(1, len(gram) + 1):
            part = gram[-n:]
            total, c, d = totals[n][part[:-1]], levels[n][part], cuts[n]
            if total:
                mass = sum(a * k for a, k in zip(d, kinds[n][part[:-1]], strict=True)) / total
                p = (c - d[min(c, 3) - 1] if c else 0) / total + mass * p
        return p

    out = []
    for text in texts:
        words = text.encode().lower().split()
        logs = [np.log10(probability(g)) for w in words for g in grams(w)]
        out.append(-sum(logs) / (sum(map(len, words)) + len(words)))
    return out


@pytest.mark.parametrize("order", [2, 5])
def test_perplexity_equals_a_plain_model(spark, order):
    texts = [r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit("x"))
    model = quality.train(docs, Workspace(spark), order)
    found = {r["doc_id"]: r["log_perplexity"] for r in quality.measured(docs, model).collect()}
    assert [found[i] for i in range(40)] == pytest.approx(plain_perplexities(texts, order), rel=1e-9)
    other = spark.createDataFrame([(1, "zzqy words neverseen " + texts[0])], "doc_id long, text string").withColumn("lang", F.lit("x"))
    assert quality.measured(other, model).first()["log_perplexity"] > found[0]


def test_quality_keeps_clean_and_drops_junk(spark, corpus, odd_docs, no_docs):
    judged = quality.judged(corpus)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = judged.filter("not base_failed").join(labels, "doc_id").collect()
    kept = lambda q: np.mean([r["kept"] for r in rows if r["quality"] == q])
    assert kept(1) > 0.98 and kept(0) < 0.7
    odd = {r["doc_id"]: r for r in quality.judged(odd_docs).collect()}
    assert odd[3]["base_failed"] and not odd[3]["kept"] and odd[4]["n_words"] == 0
    assert quality.judged(no_docs).count() == 0


def test_copies_do_not_move_the_limits(spark):
    values = [(0.5 + i / 1000, i) for i in range(101)]
    rows = [(*v, 100, 0, "en") for v in values + [(0.55, 50)] * 200]  # two thirds are one text
    rows += [(0.7, 7, 100, 0, "de")] * 5  # a language of one text
    metrics = spark.createDataFrame(rows, "log_perplexity double, text_hash long, n_words long, n_repeat_words long, lang string")
    limits = {r["band_lang"]: r for r in quality.bands(metrics).collect()}
    assert limits["en"]["low"] < 0.5 and limits["en"]["high"] > 0.6
    assert limits["de"]["low"] < 0.7 < limits["de"]["high"]


def test_toxicity_gradients():
    texts = [f"some plain words here number {i} and more of them" for i in range(20)]
    texts += [f"you awful nasty thing number {i} go away now" for i in range(20)]
    net = toxicity.fit([t.encode() for t in texts], [0] * 20 + [1] * 20, epochs=1)
    for k in net.parameters:
        net.parameters[k] = net.parameters[k].astype(np.float64)
    words = [toxicity._normal(texts[i].encode().split())[: 4 + i % 5] for i in (0, 5, 21, 30)]
    labels = np.array([0.0, 1.0, 1.0, 0.0])

    def loss() -> float:
        total = 0.0
        for ws, y in zip(words, labels):
            row = np.minimum(np.arange(toxicity.WINDOW), len(ws) - 1)[None]
            mask = (np.arange(toxicity.WINDOW) < len(ws))[None]
            p = float(toxicity.window_scores(net, net.projected(ws), row, mask)[0])
            total -= math.log(p if y else 1 - p)
        return total / len(words)

    gradients = toxicity._gradients(net, words, labels)
    for name, gradient in gradients.items():
        place = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        values, step = net.parameters[name], 2e-2
        values[place] += step
        above = loss()
        values[place] -= 2 * step
        below = loss()
        values[place] += step
        assert (above - below) / (2 * step) == pytest.approx(float(gradient[place]), rel=0.05, abs=2e-4), name


def test_windows_overlap_and_cover():
    places, mask, text = toxicity.window_index(np.array([0, 1, 32, 33, 100]))
    start = np.cumsum([0, 0, 1, 32, 33])
    for i, n in enumerate([0, 1, 32, 33, 100]):
        covered = {int(x) - start[i] for x in places[text == i][mask[text == i]]}
        assert covered == set(range(n))


def test_toxicity_of_held_out_texts(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = in_fold(F.col("doc_id"), 3, 1)
    sample = toxicity.training_sample(docs, labels.filter(~held), per_class=500)
    network = toxicity.fit(*sample, epochs=4)
    rows = toxicity.scored(docs.filter(held), network).join(labels, "doc_id").collect()
    toxic = np.array([r["toxic"] for r in rows])
    score = np.array([r["score"] for r in rows])
    assert (score[toxic == 1][:, None] > score[toxic == 0][None]).mean() > 0.95
    odd = {r["doc_id"]: r["score"] for r in toxicity.scored(odd_docs, network).collect()}
    assert odd[3] == odd[4] == odd[5] == 0.0 and all(0 <= s <= 1 for s in odd.values())
    assert toxicity.scored(no_docs, network).count() == 0
    assert toxicity.fit(*toxicity.training_sample(no_docs, labels)) is None
    assert {r["score"] for r in toxicity.scored(odd_docs, None).collect()} == {0.0}
