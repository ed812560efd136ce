"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of training texts. A text is cut into short
chunks, every chunk is compressed with every dictionary, and the language of the smallest total wins. A text
whose two best totals are too close is marked as rejected.

Defined results: null texts and texts without a letter are ``und`` with score 0 and rejected; equal totals go
are decided word by word, and if
equal again go to the language with more training text and are rejected; no training rows make every text ``und``; repeated
rows are scored alike; an empty table gives an empty result; other columns are ignored.

Scale: training reads a bounded sample of snippets per language (``snippets`` and ``dictionary_bytes``, drawn by
seeded hash over all training rows); that is all that is broadcast. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from campaignlens.llm.common import in_fold

SNIPPETS = 256
SNIPPET_CHARS = 384
DICTIONARY_BYTES = 96 << 10
CHUNK_BYTES = 2048
LEVEL = 6
MIN_MARGIN = 0.003
UNKNOWN = "und"

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Dictionaries:
    """Raw dictionary content by language, most frequent language first."""

    languages: tuple[str, ...]
    contents: tuple[bytes, ...]


def train(
    training: DataFrame, snippets: int = SNIPPETS, snippet_chars: int = SNIPPET_CHARS, size: int = DICTIONARY_BYTES
) -> Dictionaries:
    """Dictionaries from ``(doc_id, text, lang)``: about ``snippets`` snippets of each language.

    Two counts per language give the share of rows that a seeded hash lets through, so no language's
    rows are gathered or sorted to draw the sample.
    """
    rows = training.filter(F.col("lang").isNotNull() & (F.char_length("text") > 0))
    counts = {r["lang"]: (r["n"], r["chars"]) for r in rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text")).alias("chars")).collect()}
    if not counts:
        return Dictionaries((), ())
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("snippet")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = F.create_map(*[x for lang, (n, _) in counts.items() for x in (F.lit(lang), F.lit(min(1.0, snippets / n)))])
    start = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("start")), F.greatest(F.char_length("text") - snippet_chars, F.lit(1)))
    drawn = rows.filter(draw < share[F.col("lang")]).select(
        "lang", F.substring(F.col("text"), (start + 1).cast("int"), F.lit(snippet_chars)).alias("text"), draw.alias("draw")
    )
    texts: dict[str, list] = {}
    for r in drawn.collect():
        texts.setdefault(r["lang"], []).append((r["draw"], r["text"]))
    order = sorted(texts, key=lambda lang: (-counts[lang][1], lang))
    contents = [b"\n".join(t.lower().encode() for _, t in sorted(texts[lang]))[-size:] for lang in order]
    return Dictionaries(tuple(order), tuple(contents))


_COMPRESSORS: dict = {}


def _compressors(dictionaries: Dictionaries, level: int) -> list:
    import zstandard

    key = (hash(dictionaries), level)
    if key not in _COMPRESSORS:
        _COMPRESSORS.clear()
        made = []
        for content in dictionaries.contents:
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            made.append(zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=False, write_dict_id=False))
        _COMPRESSORS[key] = made
    return _COMPRESSORS[key]


def compressed_sizes(text: bytes, compressors: list, chunk: int = CHUNK_BYTES) -> list[int]:
    """Total compressed size of the whole text under every dictionary, chunk by chunk."""
    parts = [text[i : i + chunk] for i in range(0, len(text), chunk)] or [b""]
    return [sum(len(c.compress(part)) for part in parts) for c in compressors]


def _two_best(sizes: list[int]) -> tuple[list[int], float]:
    """Languages by size (ties to the more frequent one), and the relative margin of the best."""
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
    return order, (sizes[order[1]] - sizes[order[0]]) / max(sizes[order[1]], 1)


def _judge(dictionaries: Dictionaries, min_margin: float, level: int):
    """Judge of one text: language, score and rejection."""

    def decide(text: bytes) -> tuple[str, float, bool]:
        compressors = _compressors(dictionaries, level)
        if len(compressors) == 1:
            return dictionaries.languages[0], 1.0, False
        order, margin = _two_best(compressed_sizes(text, compressors))
        if not margin:  # whole bytes can't tell such texts apart: add up their words
            words = [b" " + w + b" " for w in text.split()]
            totals = [sum(len(c.compress(w)) for w in words) for c in compressors]
            order, margin = _two_best(totals)
        return dictionaries.languages[order[0]], min(1.0, 2 * margin), margin <= min_margin

    def judge(text: str | None, letters: bool) -> tuple[str, float, bool]:
        if not letters or not dictionaries.languages:
            return UNKNOWN, 0.0, True
        return decide(b" " + text.lower().encode() + b" ")

    return judge


def _letters() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__has_letters")


def identify(
    docs: DataFrame, dictionaries: Dictionaries, min_margin: float = MIN_MARGIN, level: int = LEVEL
) -> DataFrame:
    """Language, score and rejection of every whole text of ``(doc_id, text)``."""
    import pyarrow as pa

    judge = _judge(dictionaries, min_margin, level)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(t.as_py(), k.as_py()) for t, k in zip(batch.column(2), batch.column(3), strict=True)]
            columns = zip(*found, strict=True) if found else ((), (), ())
            made = [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.float64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], SCHEMA.names)

    held_out = in_fold(F.col("doc_id"), 4, 2).alias("held_out")
    return docs.select("doc_id", held_out, "text", _letters()).mapInArrow(predict, SCHEMA)


def kept_documents(
    docs: DataFrame, dictionaries: Dictionaries, min_margin: float = MIN_MARGIN, level: int = LEVEL
) -> DataFrame:
    """The documents that aren't rejected, all columns, with the identified language in ``lang``."""
    import pyarrow as pa

    judge = _judge(dictionaries, min_margin, level)
    names = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, letters = batch.column(names.index("text")), batch.column(len(names))
            found = [judge(t.as_py(), k.as_py()) for t, k in zip(texts, letters, strict=True)]
            columns = [batch.column(i) for i in range(len(names))]
            columns[names.index("lang")] = pa.array([f[0] for f in found], pa.string())
            kept = pa.RecordBatch.from_arrays(columns, names)
            yield kept.filter(pa.array([not f[2] for f in found], pa.bool_()))

    return docs.select("*", _letters()).mapInArrow(keep, docs.schema)
