"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

Documents become token ids plus one separator. Only documents longer than the capacity are cut. The
pieces are dealt evenly over tasks; each task packs its pieces, longest first, by bounded-space
best fit: a fixed number of sequences is open, a bitset has bit ``f`` set while an open sequence has
``f`` free places, and the lowest set bit from the piece's length on is the best fit. When
all places are taken and nothing fits, the fullest open sequence closes.

Defined results: a null or empty text is one piece with the separator alone; repeated rows and ids
are packed as they come; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from campaignlens.llm.common import Workspace, text_bytes

CAPACITY = 2048
OPEN_SEQUENCES = 32768
PIECES_PER_TASK = 65536
TOKENIZER = "word_bpe_49k.json"
SEPARATOR = 0

_CACHED_CHUNKS = 1_000_000
_CACHED_BYTES = 64

PIECE_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)
IDS = T.StructField("ids", T.BinaryType())
PLACE = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins that byte-level vocabularies use for bytes: those that print stand for themselves,
    the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class ChunkIds(dict):
    """Token ids (little-endian, 32 bits) of chunks between ASCII white space, remembered per worker.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of its chunks. Special
    tokens that are spelled out in a text count as themselves, as the library has it; they have no white space in them.
    Case doesn't matter to it and punctuation is cut off words, so most new chunks are known words
    plus a mark. A new word of letters below U+0130, which has one normal form and one lower-case form, needs the
    library's BPE model only; every other chunk takes the library's whole path.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        path = tokenizer if os.path.isabs(tokenizer) else public_tokenizers.path(tokenizer)
        self.whole = Tokenizer.from_file(path)
        # the short cuts hold for lower-casing vocabularies with word ends and dropped white space
        self.by_word = self.whole.encode("Ab. ", add_special_tokens=False).ids == [
            i for part in ("ab", ".") for i in self.whole.encode(part, add_special_tokens=False).ids
        ] and getattr(self.whole.model, "end_of_word_suffix", None) is not None
        self.bpe = self.whole.model.tokenize
        self.letters = _byte_letters()

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self._encode(chunk)
        if len(chunk) <= _CACHED_BYTES:
            if len(self) >= _CACHED_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids

    def _encode(self, chunk: bytes) -> bytes:
        if self.by_word and len(chunk) <= _CACHED_BYTES:
            if chunk[-1] in b".,!?;:|" and len(chunk) > 1 and chunk[-2:-1].isalnum():
                return self[chunk[:-1]] + self[chunk[-1:]]
            if chunk.isalpha():  # ASCII letters
                small = chunk.lower()
                if small != chunk:
                    return self[small]
                return np.array([t.id for t in self.bpe(chunk.decode())], dtype="<u4").tobytes()
            word = chunk.decode("utf-8", "replace")
            if word.isalpha() and max(word) < "\u0130":
                stand_in = word.lower().encode().decode("latin-1").translate(self.letters)
                return np.array([t.id for t in self.bpe(stand_in)], dtype="<u4").tobytes()
        encoded = self.whole.encode_batch_fast([chunk.decode("utf-8", "replace")], add_special_tokens=False)[0]
        return np.array(encoded.ids, dtype="<u4").tobytes()

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


_TOKENIZERS: dict[str, ChunkIds] = {}


def tokenized_pieces(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, keep_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: place in the document, CRC-32 and, if wanted, the ids as binary."""
    import pyarrow as pa

    end = np.array([SEPARATOR], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _TOKENIZERS.get(tokenizer) or _TOKENIZERS.setdefault(tokenizer, ChunkIds(tokenizer))
        width = 4 * capacity
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                ids = chunks.ids(text) + end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else b""))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = [*PIECE_SCHEMA.names, "ids"]
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            wanted = 6 if keep_ids else 5
            yield pa.RecordBatch.from_arrays(made[:wanted], names[:wanted])

    schema = T.StructType([*PIECE_SCHEMA.fields, *([IDS] if keep_ids else [])])
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(cut, schema)


class BestFit:
    """Bounded-space best fit over sequences of one capacity."""

    def __init__(self, capacity: int, open_limit: int):
        self.capacity, self.open_limit = capacity, open_limit
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0
        self.open = 0
        self.made = 0

    def _take(self, free: int) -> int:
        found = self.by_free[free]
        number = found.pop()
        if not found:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """Sequence number and offset of a piece."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.open_limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - free


def pack_pieces(
    pieces: DataFrame,
    n_pieces: int,
    capacity: int = CAPACITY,
    open_sequences: int = OPEN_SEQUENCES,
    pieces_per_task: int = PIECES_PER_TASK,
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a stored table of pieces; ``n_pieces`` sizes the tasks."""
    import pyarrow as pa
    from pyspark import TaskContext

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        lengths = table.column("length").to_numpy()
        order = np.argsort(-lengths, kind="stable")
        fit = BestFit(capacity, open_sequences)
        placed = np.array([fit.place(n) for n in lengths[order].tolist()], dtype=np.int64).reshape(-1, 2)
        result = np.empty_like(placed)
        result[order] = placed
        first = TaskContext.get().partitionId() << 32
        table = table.append_column("sequence_id", pa.array(result[:, 0] + first))
        table = table.append_column("offset", pa.array(result[:, 1]))
        yield from table.to_batches(max_chunksize=16384)

    schema = T.StructType([*pieces.schema.fields, *PLACE])
    tasks = max(1, -(-n_pieces // pieces_per_task))
    return pieces.repartition(tasks).mapInArrow(pack, schema)


def packed(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    keep_ids: bool = False,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Tokenizes, cuts and packs documents: one row per piece with its sequence and offset.

    With ``keep_ids`` tasks hold the ids too and are dealt a quarter of the pieces.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    pieces = workspace.table(tokenized_pieces(docs, capacity, tokenizer, keep_ids), "pieces")
    per_task = PIECES_PER_TASK // 4 if keep_ids else PIECES_PER_TASK
    return pack_pieces(pieces, pieces.count(), capacity, OPEN_SEQUENCES, per_task)


def sequences(placed: DataFrame) -> DataFrame:
    """Packed sequences (ids as one binary) with the documents in them, from pieces with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.expr("aggregate(parts, cast('' as binary), (whole, part) -> concat(whole, part.ids))").alias("ids"),
        F.expr("transform(parts, p -> struct(p.doc_id, p.piece, p.offset, p.length))").alias("documents"),
    )
