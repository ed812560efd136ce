"""External shuffle, source mixing and personal data."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from campaignlens.llm import mixing, pii, sharding
from tests.llm.conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def test_shuffle_is_a_permutation_with_equal_shards(odd_docs):
    shuffled, rows = sharding.shuffled_records(odd_docs, bucket_bytes=20_000)
    assert rows == len(ROWS) and shuffled.select("bucket").distinct().count() > 1
    placed = sharding.assign_shards(shuffled, rows, 4).collect()
    slots = defaultdict(list)
    for r in placed:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    key = lambda r: (r["doc_id"], zlib.crc32((r["text"] or "").encode()))
    assert Counter(key(r["record"]) for r in placed) == Counter((i, zlib.crc32((t or "").encode())) for i, t, *_ in ROWS)


def test_shuffle_repeats_itself_and_differs_by_seed(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))

    def order(seed):
        shuffled, rows = sharding.shuffled_records(docs, seed, bucket_rows=100)
        return [r[0] for r in sharding.assign_shards(shuffled, rows, 3).orderBy("shard", "slot").select("record.doc_id").collect()]

    assert order(1) == order(1) != order(2)
    assert sorted(order(1)) == list(range(500))


def test_written_shards_hold_all_records(odd_docs, tmp_path):
    shuffled, rows = sharding.shuffled_records(odd_docs.drop("bucket"))
    sharding.write_shards(sharding.assign_shards(shuffled, rows, 3), str(tmp_path / "out"))
    back = odd_docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(ROWS) and {r[0] for r in back.select("shard").distinct().collect()} == {0, 1, 2}


def test_shuffle_of_nothing(no_docs):
    shuffled, rows = sharding.shuffled_records(no_docs)
    assert rows == 0 and sharding.assign_shards(shuffled, rows).count() == 0


def fill(sizes: dict, weights=(5, 2, 1), cap=3) -> dict:
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        open_names = [s for s in names if s not in capped]
        rest = total - sum(cap * sizes[s] for s in capped)
        level = rest / sum(weight[s] for s in open_names) if open_names else 0
        over = {s for s in open_names if level * weight[s] > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= over


def sainte_lague(targets: dict, house: int, limit: dict) -> dict:
    seats = dict.fromkeys(targets, 0)
    for _ in range(house):
        best = max((s for s in targets if seats[s] < limit[s]), key=lambda s: targets[s] / (2 * seats[s] + 1))
        seats[best] += 1
    return seats


def test_targets_and_quotas_against_plain_rules(spark):
    sizes = {"a": 1000, "b": 40, "c": 5003, "d": 7, "e": 900, "f": 0, None: 300}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    targeted = mixing.targets(rows)
    expected = fill(sizes)
    assert {r["source"]: r["target"] for r in targeted.collect()} == pytest.approx(expected)
    quotas = defaultdict(int)
    for r in mixing.quotas(targeted, block_tokens=16).collect():
        assert r["quota"] >= 0
        quotas[r["source"]] += r["quota"]
    house = (2 * sum(sizes.values()) + 16) // 32
    assert quotas == sainte_lague(expected, house, {s: 3 * -(-n // 16) for s, n in sizes.items()})


def test_mix_of_odd_documents(odd_docs):
    mixed = mixing.mix(odd_docs).collect()
    sizes = Counter((i, s, len(WORD.findall(t or ""))) for i, t, _, s in ROWS)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in mixed) == sizes
    taken, target = Counter(), {}
    for r in mixed:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 48 for s, t in target.items())
    again = mixing.mix(odd_docs.repartition(5)).collect()
    plain = lambda rows: Counter((r["doc_id"], r["source"], r["size"], r["taken"]) for r in rows)
    assert plain(mixed) == plain(again)


def test_mixed_documents_hold_the_words_taken(odd_docs):
    taken = Counter()
    for r in mixing.mix(odd_docs).collect():
        taken[r["doc_id"]] += r["taken"]
    out = mixing.mixed_documents(odd_docs)
    assert out.columns == odd_docs.columns
    words = Counter()
    for r in out.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert {k: v for k, v in taken.items() if v} == dict(words)


def test_mix_of_nothing(no_docs):
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text: str) -> list[tuple]:
    found = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), order, m.end(), kind))
    return sorted(found)


TRICKY = [
    "a@b.c_d@e.f a@b.c.d@e.f x@y 1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.1.1",
    "4111 1111-1111 1111 4111111111111111x 12345678901234567890123 1 2  4111 1111 1111 1111  5",
    "+1+22 33 444 5555 +123 +12 345.678.901.234 ü+49 30 1234567é a@b-c.de a@1.2.3.4",
    "9" * 5000 + " " + "a" * 5000 + "@" + "b.c" * 100,
]


def test_base_spans_are_those_of_the_plain_patterns(spark, odd_docs):
    texts = TRICKY + [t for _, t, *_ in ROWS]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.found(docs).select("doc_id", pii.listing(F.filter("candidates", lambda c: c["base"])).alias("base"), pii.listing(F.col("spans")).alias("all"))
    for r in found.collect():
        expected = [f"{k}:{s}:{e}" for s, _, e, k in base_spans(texts[r["doc_id"]] or "")]
        assert r["base"] == ",".join(expected)
        assert set(expected) <= set(r["all"].split(",")) | {""}


def test_digest_of_no_spans_and_redaction(odd_docs):
    out = pii.redacted_documents(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == len(ROWS)
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[11] == "mail me at <EMAIL> or <PHONE>, card <CARD>, host <IP>"
    assert texts[3] is None and texts[10] == "x" * 60_000
    empty = pii.found(odd_docs.filter("doc_id = 3")).select(F.sha2(pii.listing(F.col("spans")).cast("binary"), 256)).first()[0]
    assert empty == hashlib.sha256(b"").hexdigest()


def test_personal_data_of_nothing(no_docs):
    assert pii.found(no_docs).count() == 0
