"""Near-duplicates by SimHash and shingle sets: groups connected by Jaccard similarity of at least ``SIMILARITY``.

Candidates come from two searches, and whole sets of 64-bit shingle hashes decide on all of them. The operator of
:mod:`campaignlens.llm.simhash`, on shingles of this module's width, links fingerprints within its radius. A pair at similarity
0.8 differs in ten of 64 bits on average, which no radius that can be searched covers; so those that share one of ``BANDS`` keys of
``BAND_ROWS`` minimum hashes and whose sketches agree are candidates too: a pair at similarity 0.8 shares no key with
probability (1 - 0.8**5)**25 = 5e-5, more similar ones less. Keys with many sets are worked off in rounds: in each, a growing
hashed share of a key's sets, its hubs, meets all others that aren't connected to it yet. Keys whose sets ``_ROUNDS`` rounds leave
apart form crowds, those with a set in common the same one. A crowd is compared by differences: every set is stated once, as its
difference from one set of the crowd, the centre, and only sets meet whose differences have an element in common early enough in
order of frequency (a positional prefix filter, which loses no pair).

Defined results: a text with fewer words than a shingle is one shingle, a null or empty text the empty set; equal sets
are one group; rows without an id lose to those with one; an empty table gives an empty result.

Scale: equal sets collapse before anything is compared. Only texts of candidates move, once per pair that isn't
ruled out by sizes and sketches; a hub's text moves once per ``_SALT_ROWS`` members. Crowded keys are salted, so that one group
may hold any share of the rows. Sets that are alike in many places but too far apart don't all meet: only those that differ
from the centre in the same places do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from campaignlens.llm import simhash
from campaignlens.llm.common import Workspace, text_bytes
from campaignlens.llm.kneser_ney import WordHashes, pair_hash
from campaignlens.llm.simhash import components

SHINGLE_WORDS = 5
SIMILARITY = (4, 5)
BANDS = 25
BAND_ROWS = 5
#: Places of two sketches that must agree before whole sets are compared.
LEAST_AGREEING = 80
_FIRST_SHARE = 1
_GROWTH = 16
_ROUNDS = 1
_SMALL_KEY = 4
_SALT_ROWS = 512
#: Of so many differences one is counted to put elements in order; frequent ones are in one of so many of those, or in more.
_COUNTED = 4
_OFTEN = 64
_AT_ONCE = 2048
_HASHES = WordHashes()
_RNG = np.random.default_rng(42)
_FLIP, _TIMES = (_RNG.integers(0, 2**64, BANDS * BAND_ROWS, dtype=np.uint64)[:, None] | np.uint64(1) for _ in range(2))


def shingle_set(text: bytes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` lower-cased words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    code = np.full(n, width, np.uint64)
    for k in range(width):
        code = pair_hash(code, hashes[k : k + n])
    return np.unique(code)


def least_hashes(shingles: np.ndarray) -> np.ndarray:
    """The minimum of every hash function over a non-empty set."""
    least = np.full(BANDS * BAND_ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), _AT_ONCE):
        np.minimum(least, ((shingles[at : at + _AT_ONCE] ^ _FLIP) * _TIMES).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key per band of minimum hashes."""
    rows = least.reshape(BANDS, BAND_ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(BAND_ROWS):
        key = pair_hash(key, rows[:, k])
    return key.view(np.int64)


def sketch(least: np.ndarray) -> bytes:
    """The low byte of every minimum hash; the high ones are small in all of them."""
    return (least & np.uint64(0xFF)).astype(np.uint8).tobytes()


def signed(docs: DataFrame) -> DataFrame:
    """The documents (all columns) with ``fp``, the hash of the shingle set, its ``set_size``, band ``keys`` and ``sketch``, and the SimHash ``bits``; an empty set has no keys."""
    import pyarrow as pa
    import xxhash

    at = docs.columns.index("text")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, sizes, keys, sketches, bits = [], [], [], [], []
            for text in text_bytes(batch.column(at)):
                found = shingle_set(text)
                prints.append(xxhash.xxh64_intdigest(found.tobytes(), 42))
                sizes.append(len(found))
                least = least_hashes(found)
                keys.append(band_keys(least) if len(found) else np.empty(0, np.int64))
                sketches.append(sketch(least))
                bits.append(simhash.fingerprint(text, SHINGLE_WORDS))
            made = [pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            made += [pa.array(sketches, pa.binary()), pa.array(np.array(bits, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], schema.names)

    added = [T.StructField("fp", T.LongType()), T.StructField("set_size", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))]
    added += [T.StructField("sketch", T.BinaryType()), T.StructField("bits", T.LongType())]
    schema = T.StructType([*docs.schema.fields, *added])
    return docs.mapInArrow(sign, schema)


def _dealt(pairs: DataFrame, texts: DataFrame, workspace: Workspace) -> DataFrame:
    """``(a, b, text)``: a hub's text, where ``a`` is null, comes before those of the pairs ``(a, b)`` in which it is ``b``.

    A text moves once per pair in which it is ``a`` and once per ``_SALT_ROWS`` or so pairs in which it is ``b``. Where each of
    them goes is stored first: a table of numbers alone, which Spark sends to the texts as long as it may be broadcast.
    """
    salts = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / _SALT_ROWS).cast("int").alias("salts"))
    salt = F.pmod(F.xxhash64("a", F.lit(5)), "salts").cast("int").alias("salt")
    members = pairs.join(salts, "b").select(F.col("a").alias("fp"), "a", "b", salt)
    every = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    hubs = salts.select(F.col("b").alias("fp"), F.lit(None).cast("long").alias("a"), "b", every)
    moves = workspace.table(members.union(hubs), "moves")
    both = texts.join(moves, "fp").select("a", "b", "salt", "text")
    return both.repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first()).select("a", "b", "text")


def _with_hubs(batch, hub: list) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Members of a batch of :func:`_dealt` with their hub and both shingle sets; ``hub`` is the last one before the batch, then after it."""
    members, hubs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    for member, other, text in zip(members, hubs, text_bytes(batch.column(2)), strict=True):
        if member is None:
            hub[:] = other, shingle_set(text)
            continue
        if other != hub[0]:
            raise ValueError("a hub's text must come before its members")
        yield member, other, shingle_set(text), hub[1]


def _similar(common: int, one: int, two: int) -> bool:
    return common * SIMILARITY[1] >= SIMILARITY[0] * (one + two - common)


def verified(pairs: DataFrame, texts: DataFrame, workspace: Workspace) -> DataFrame:
    """The pairs ``(a, b)`` whose whole shingle sets are similar enough; ``texts`` holds one text per ``fp``."""
    import pyarrow as pa

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = [None, None]
        for batch in batches:
            a, b = [], []
            for member, other, found, hub_set in _with_hubs(batch, hub):
                if _similar(len(np.intersect1d(found, hub_set, assume_unique=True)), len(found), len(hub_set)):
                    a.append(member)
                    b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return _dealt(pairs, texts, workspace).mapInArrow(compare, "a long, b long")


def _differences(pairs: DataFrame, texts: DataFrame, workspace: Workspace) -> DataFrame:
    """The pairs with ``n``, the size of the set ``a``, the ``elements`` that only one of the sets has, and whether they are ``near``."""
    import pyarrow as pa

    schema = "a long, b long, n long, elements array<long>, near boolean"

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = [None, None]
        for batch in batches:
            rows = []
            for member, other, found, hub_set in _with_hubs(batch, hub):
                apart = np.setxor1d(found, hub_set, assume_unique=True)
                common = (len(found) + len(hub_set) - len(apart)) // 2
                rows.append((member, other, len(found), apart.view(np.int64), _similar(common, len(found), len(hub_set))))
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_()
            columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n", "elements", "near"])

    return _dealt(pairs, texts, workspace).mapInArrow(differ, schema)


def _centred(links: DataFrame, met: DataFrame, workspace: Workspace) -> DataFrame:
    """Sets ``a`` connected by pairs ``met`` and the centre ``b`` of their crowd: the set with most ``links`` to it, as its differences are short."""
    linked = components(met, workspace)
    crowds = linked.union(linked.select(F.col("root").alias("fp"), "root").distinct())
    liked = links.groupBy(F.col("b").alias("fp")).agg(F.count(F.lit(1)).alias("times"))
    rank = F.struct(F.coalesce("times", F.lit(0)), "fp")
    centres = crowds.join(liked, "fp", "left").groupBy("root").agg(F.max_by("fp", rank).alias("b"))
    return crowds.join(centres, "root").filter("fp != b").select(F.col("fp").alias("a"), "b")


def _first_elements(differences: DataFrame) -> DataFrame:
    """Elements ``e`` that may be the first common one of a difference and another, with ``left``, how many there are from there to the end.

    Of sets with s elements in only one of them, differences of d elements have d - s in common at least, and s is at most
    (x + y) / 9 with y <= 5 x / 4: the first common one is among the first x / 4 + 1. That holds for any order. Elements that are
    frequent go last; how frequent is counted in some of the differences, which is enough for an order.
    """
    t, u = SIMILARITY
    sure, least = u + t, u - t
    counted = differences.filter(F.pmod(F.xxhash64("a", F.lit(11)), F.lit(_COUNTED)) == 0).select("b", "elements")
    sizes = counted.groupBy("b").agg(F.count(F.lit(1)).alias("m"))
    times = counted.select("b", F.explode("elements").alias("e")).groupBy("b", "e").agg(F.count(F.lit(1)).alias("times"))
    often = times.join(sizes, "b").filter(F.col("times") * _OFTEN >= F.col("m"))
    often = often.groupBy("b").agg(F.sort_array(F.collect_list(F.struct("times", "e")))["e"].alias("often"))
    known = differences.join(often, "b", "left").withColumn("often", F.coalesce("often", F.array().cast("array<long>")))
    ordered = F.concat(F.array_sort(F.array_except("elements", "often")), F.array_intersect("often", "elements"))
    first = F.slice(ordered, F.lit(1), F.expr(f"cast(n * {least * (t + u)} div {t * sure} + 1 as int)"))
    each = known.select("a", "b", "n", F.size("elements").alias("d"), F.posexplode(first).alias("at", "e"))
    return each.withColumn("left", F.col("d") - F.col("at")).drop("at")


def _by_differences(differences: DataFrame, rooted: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """Pairs ``(a, b)`` of sets with the same centre that aren't connected yet and may be similar.

    Sets of x and y elements with s elements in only one of them are similar if 9 s <= x + y, and s is the size of both
    differences without twice their common elements. If the first common one has ``left`` elements from there to the end, no more
    than the lesser ``left`` are common. (If none need be, both are near the centre.)
    """
    workspace = workspace or Workspace(differences.sparkSession)
    t, u = SIMILARITY
    sure, least = u + t, u - t  # similar: sure * s <= least * (x + y)
    each = workspace.table(_first_elements(differences), "elements")
    times = each.groupBy("b", "e").agg(F.count(F.lit(1)).alias("times"), F.min("d").alias("d_least")).filter("times > 1")
    # no partner is closer to the centre than d_least, nor larger than n * u / t
    near = 2 * t * sure * F.col("left") >= t * sure * (F.col("d") + F.col("d_least")) - least * (t + u) * F.col("n")
    each = each.join(times, ["b", "e"]).filter(near).join(rooted.withColumnRenamed("fp", "a"), "a", "left")
    each = workspace.table(each.select("a", "b", "e", "n", "d", "left", F.coalesce("root", "a").alias("root")), "shared")
    one, two = (each.select("b", "e", *[F.col(c).alias(f"{c}_{k}") for c in ("a", "n", "d", "root", "left")]) for k in (1, 2))
    sizes = F.least("n_1", "n_2") * u >= F.greatest("n_1", "n_2") * t
    enough = 2 * sure * F.least("left_1", "left_2") >= sure * (F.col("d_1") + F.col("d_2")) - least * (F.col("n_1") + F.col("n_2"))
    met = one.join(two, ["b", "e"]).filter((F.col("a_1") < F.col("a_2")) & (F.col("root_1") != F.col("root_2")) & sizes & enough)
    return met.select(F.col("a_1").alias("a"), F.col("a_2").alias("b")).distinct()


def _by_simhash(holders: DataFrame, workspace: Workspace) -> DataFrame:
    """Pairs ``(a, b)`` of sets by the SimHash operator: of equal fingerprints the smallest set, of linked ones those, and each other one with its smallest."""
    printed = holders.filter("set_size > 0").select("fp", "bits")
    distinct = workspace.table(printed.groupBy("bits").agg(F.min("fp").alias("least")), "fingerprints")
    linked = simhash.links(distinct.select(F.col("bits").alias("fp")), distinct.count())
    linked = linked.join(distinct.toDF("a", "one"), "a").join(distinct.toDF("b", "two"), "b").select(F.col("one").alias("a"), F.col("two").alias("b"))
    equal = printed.join(distinct, "bits").filter("fp != least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    return linked.union(equal)


def _meetings(live: DataFrame, done: Column, share: Column) -> DataFrame:
    """Pairs ``(a, b)`` of the sets whose place is in ``[done, share)``, the hubs ``b``, with all others of their key.

    Two hubs meet once; of the two, the one with the greater place is ``a``.
    """
    salts = F.ceil(F.col("m") / _SALT_ROWS).cast("int")
    members = live.withColumn("salt", F.pmod(F.xxhash64("fp", F.lit(3)), salts).cast("int"))
    hubs = live.filter((F.col("place") >= done) & (F.col("place") < share)).select(
        "band", "key", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
        *[F.col(c).alias(f"hub_{c}") for c in ("fp", "set_size", "root", "place")],
    )
    sizes = F.least("set_size", "hub_set_size") * SIMILARITY[1] >= F.greatest("set_size", "hub_set_size") * SIMILARITY[0]
    # members that were hubs earlier have met this hub
    new = (F.col("place") >= done) & (F.col("hub_place") < F.col("place"))
    met = members.join(hubs, ["band", "key", "salt"]).filter((F.col("root") != F.col("hub_root")) & sizes & new)
    return met.select(F.col("fp").alias("a"), F.col("hub_fp").alias("b")).distinct()


def _promising(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs whose sketches agree in ``LEAST_AGREEING`` places or more.

    At similarity 0.8 a pair agrees in 100 of 125 places on average, with a deviation of 4.5, and in fewer than that with probability 1e-5.
    """
    import pyarrow as pa

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (2, 3))
            yield batch.filter(pa.array((one == two).sum(axis=1) >= LEAST_AGREEING, pa.bool_())).select(["a", "b"])

    joined = pairs.join(sketches.toDF("a", "one"), "a").join(sketches.toDF("b", "two"), "b")
    return joined.select("a", "b", "one", "two").mapInArrow(alike, "a long, b long")


def groups(stored: DataFrame, workspace: Workspace) -> DataFrame:
    """``(fp, root)`` of every set of a stored table of :func:`signed` rows that is connected to a smaller one."""
    firsts = stored.groupBy("fp").agg(F.min("row_number").alias("row_number"))
    holders = workspace.table(
        stored.select("fp", "set_size", "keys", "sketch", "bits", "row_number").join(firsts, ["fp", "row_number"], "left_semi"), "sets"
    )
    keyed = holders.select("fp", "set_size", F.posexplode("keys").alias("band", "key"))
    shared = keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    # the same place in every key, so that a group's keys choose the same sets and pairs repeat
    place = F.pmod(F.xxhash64("fp", F.lit(17)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    live = workspace.table(keyed.join(shared, ["band", "key"]).withColumn("place", place), "keys")
    printed = workspace.table(_by_simhash(holders, workspace), "printed")
    some = live.select("fp").union(printed.select("a")).union(printed.select("b")).distinct()
    candidates = workspace.table(holders.select("fp", "row_number", "sketch").join(some, "fp"), "candidates")
    sketches = candidates.select("fp", "sketch")
    texts = stored.select("fp", "row_number", F.col("record.text").cast("string").alias("text"))
    # a table of numbers alone has a known, small size: Spark moves it to the texts as long as it may be broadcast
    wanted = workspace.table(candidates.select("row_number"), "wanted")
    texts = workspace.table(texts.join(wanted, "row_number", "left_semi").select("fp", "text"), "texts")
    at, links, met = live.withColumn("root", F.col("fp")), None, printed
    done, sets = F.lit(0.0), float(_FIRST_SHARE)
    for _ in range(_ROUNDS):
        share = F.when(F.col("m") <= F.greatest(F.lit(2 * sets), F.lit(float(_SMALL_KEY))), 1.0).otherwise(F.lit(sets) / F.col("m"))
        pairs = _promising(_meetings(at, done, share), sketches)
        pairs = workspace.table(pairs if met is None else pairs.union(met).distinct(), "pairs")
        found = verified(pairs, texts, workspace)
        links, met = workspace.table(found if links is None else links.union(found), "verified"), None
        rooted = workspace.table(components(links, workspace), "rooted")
        done, sets = share, sets * _GROWTH
        at = live.filter(done < 1.0).join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        apart = at.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        live = workspace.table(at.join(apart.filter("low < high"), ["band", "key"], "left_semi"), "keys")
        if live.isEmpty():
            return rooted
        at, live = live, live.drop("root")
    firsts = live.groupBy("band", "key").agg(F.min_by("fp", "place").alias("b"))
    met = live.select("band", "key", F.col("fp").alias("a")).join(firsts, ["band", "key"]).filter("a != b").select("a", "b").distinct()
    members = workspace.table(_centred(links, met, workspace), "members")
    differences = workspace.table(_differences(members, texts, workspace), "differences")
    met = workspace.table(_by_differences(differences, rooted, workspace), "met")
    pairs = workspace.table(_promising(met, sketches), "pairs")
    links = links.union(differences.filter("near").select("a", "b")).union(verified(pairs, texts, workspace))
    return workspace.table(components(workspace.table(links, "verified"), workspace), "rooted")


def one_per_group(docs: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """The documents without near-duplicates: of each group the first row with the smallest id stays."""
    workspace = workspace or Workspace(docs.sparkSession)
    record = F.struct(*[docs[c] for c in docs.columns]).alias("record")
    numbered = docs.select("text", "doc_id", F.monotonically_increasing_id().alias("row_number"), record)
    stored = workspace.table(signed(numbered).drop("text"), "shingled")
    rooted = groups(stored, workspace)
    members = stored.select("fp", "doc_id", "row_number").join(rooted, "fp", "left")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "row_number")
    winners = members.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min(rank).alias("rank"))
    winners = workspace.table(winners.select(F.col("rank.row_number").alias("winner")), "winners")
    # fewer rows go than stay, so their numbers may be broadcast longer
    losers = stored.select("row_number").join(winners, F.col("row_number") == F.col("winner"), "left_anti")
    losers = workspace.table(losers.select(F.col("row_number").alias("loser")), "losers")
    return stored.join(losers, F.col("row_number") == F.col("loser"), "left_anti").select("record.*")
