"""Token ids in binary shards with Elias-Fano document boundaries (operator 11).

A data set is a folder of shard files and one manifest. A shard holds the ids
of consecutive documents, one after the other, in two or four bytes each
(little-endian), then the Elias-Fano coded ends of its documents, their coded
doc_ids, and a footer of fixed size. The manifest lists the shards in doc_id
order with their numbers of documents and tokens; it is written last and moved
into place, so a reader sees a whole data set or none, whatever tasks or
executors were lost on the way.

``token_shards`` is a Spark data source: ``df.write.format("token_shards")``
takes doc_id and the bytes of ids, or with the option ``vocabulary`` doc_id and
text, which it encodes; ``spark.read.format("token_shards")`` reads. ``Shard`` reads single documents of
one file by select, without reading the ids before them.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

from cartwise.llm import elias_fano, tokens
from cartwise.llm.common import BATCH_ROWS, byte_slices, hand_back_memory

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = b"EFTOK001"
MANIFEST = "_manifest.json"
_FOOTER = "<BQQQQQ8s"  # bytes an id, documents, null doc_ids, tokens, bytes of the ends, bytes of the doc_ids, magic
SHARD_TEXT = 32 << 20  # bytes of text (about) in a shard
_BLOCK_DOCS, _BLOCK_BYTES = 4096, 4 << 20  # of documents read, of text encoded, at once
_MOST_PIECES = 400_000  # pieces of text whose ids a task remembers

# The pieces that the vocabulary's own pattern finds, for the characters of tokens._KNOWN. Words stand first,
# as the most frequent ones; no other alternative begins as they do.
_PIECE = re.compile(
    " ?[{L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+".format(
        L=tokens._LETTER, N=tokens._NUMBER, S=tokens._SPACE
    )
)


class PieceEncoder:
    """Texts to the bytes of their ids. The tokenizer library encodes every distinct piece once.

    A piece (a word with the space before it, a number, signs, white space) is
    what the vocabulary never merges across. Texts with characters outside the
    Latin blocks, or with a special token's string, go to the library whole.
    """

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer

        self.library, self.kind = Tokenizer.from_file(path), f"<u{width}"
        if self.library.get_vocab_size() > 1 << 8 * width:
            raise ValueError(f"ids of this vocabulary do not fit {width} bytes")
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.known = _Pieces(self.library.model.tokenize, "H" if width == 2 else "I")

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > _MOST_PIECES:
            self.known.clear()
        plain = [bool(tokens._KNOWN.fullmatch(t)) and not self.special.search(t) for t in texts]
        others = self.library.encode_batch_fast([t for t, ok in zip(texts, plain, strict=True) if not ok], add_special_tokens=False)
        rest, of, find = iter(others), self.known.__getitem__, _PIECE.findall
        return [
            b"".join(map(of, find(t))) if ok else np.array(next(rest).ids, self.kind).tobytes()
            for t, ok in zip(texts, plain, strict=True)
        ]


class _Pieces(dict):
    """The bytes of a piece's ids; a new piece goes to the library's model, its bytes shown as letters."""

    def __init__(self, merge, kind: str):
        self.merge, self.kind = merge, kind
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(tokens._byte_letters())})

    def __missing__(self, piece: str) -> bytes:
        ids = [t.id for t in self.merge(piece.encode().decode("latin-1").translate(self.letters))]
        coded = self[piece] = struct.pack(f"<{len(ids)}{self.kind}", *ids)
        return coded


def write_token_shards(
    docs: DataFrame, doc_id: str, text: str, vocabulary: str, path: str, end: int = 2, width: int = 2,
    shard_text: int = SHARD_TEXT,
) -> None:
    """Encode ``text`` and write the ids, each document closed by ``end``, in ascending doc_id order.

    A null or empty text is the closing id alone; a null doc_id comes first and
    stays null; rows with equal doc_ids are ordered by a hash of their texts,
    and equal rows are written each. An empty table gives a data set without
    shards. Other columns are not read.

    Whole texts are shuffled once, by ranges of (doc_id, hash, row number), so
    one doc_id with most of the rows is spread over shards as well; a task
    encodes and writes its range as it comes, in blocks.
    """
    docs.sparkSession.dataSource.register(TokenShards)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # The row number only cuts ranges; it is the same when a task is run again.
    order = ["doc_id", "_hash", "_row"]
    ranged = (
        rows.withColumn("_hash", F.xxhash64("text"))
        .withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(max(1, -(-size // shard_text)), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )

    sink = ranged.write.format("token_shards").mode("append")
    sink = sink.options(width=str(width), vocabulary=vocabulary, end=str(end))
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(BATCH_ROWS))  # whole texts beside the executor's heap
    try:
        sink.save(path)
    finally:
        conf.set(key, before)


def read_token_shards(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """Documents of a data set: doc_id, start (ids of all documents before), n_tokens, ids (uint32, little-endian; null if not wanted)."""
    spark.dataSource.register(TokenShards)
    return spark.read.format("token_shards").option("ids", str(ids).lower()).load(path)


# --- files -----------------------------------------------------------------------


class Shard:
    """One shard file. Opening it reads the coded boundaries, not the ids."""

    def __init__(self, fs: pa.fs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size() - struct.calcsize(_FOOTER)
        footer = self.file.read_at(struct.calcsize(_FOOTER), size)
        self.width, self.n_docs, self.n_null, self.n_tokens, ends, names, magic = struct.unpack(_FOOTER, footer)
        if magic != MAGIC:
            raise ValueError(f"not a token shard: {path}")
        coded = self.file.read_at(ends + names, size - ends - names)
        self.ends, self.names = elias_fano.Sequence(coded[:ends]), elias_fano.Sequence(coded[ends:])

    def __enter__(self) -> Shard:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def bounds(self, i: int, j: int) -> np.ndarray:
        """Where documents i..j-1 begin in the shard, and where the last of them ends."""
        if i:
            return self.ends.range(i - 1, j)
        return np.concatenate([[0], self.ends.range(0, j)])

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids start..end-1 of the shard."""
        raw = self.file.read_at((end - start) * self.width, len(MAGIC) + start * self.width)
        return np.frombuffer(raw, f"<u{self.width}")

    def document(self, i: int) -> np.ndarray:
        return self.ids(*map(int, self.bounds(i, i + 1)))

    def document_at(self, token: int) -> int:
        """The document that holds the shard's id number ``token``."""
        return self.ends.rank(token)

    def doc_ids(self, i: int, j: int) -> np.ndarray:
        """doc_ids of documents i..j-1; those of the first ``n_null`` documents are null (shown as 0)."""
        nulls = np.zeros(max(0, min(j, self.n_null) - i), np.int64)
        return np.concatenate([nulls, self.names.range(max(i - self.n_null, 0), max(j - self.n_null, 0))])


def open_manifest(path: str) -> tuple[pa.fs.FileSystem, str, list[dict]]:
    """File system, folder and shards (file, documents, tokens) of a finished data set."""
    fs, folder = pa.fs.FileSystem.from_uri(path)
    with fs.open_input_stream(f"{folder}/{MANIFEST}") as f:
        return fs, folder, json.loads(f.read())["shards"]


@dataclass
class _Written(WriterCommitMessage):
    order: int
    file: str
    documents: int
    tokens: int
    first: int | None  # smallest and largest doc_id; null if there is none
    last: int | None
    nulls: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, width: int, overwrite: bool, vocabulary: str | None, end: int):
        self.path, self.width, self.overwrite, self.vocabulary, self.end = path, width, overwrite, vocabulary, end

    def _encoded(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
        """doc_ids and the bytes of their ids, some megabytes at once."""
        if self.vocabulary is None:
            for batch in batches:
                yield batch["doc_id"], [v.as_buffer() for v in batch["ids"]]
            return
        encoder, close = PieceEncoder(self.vocabulary, self.width), self.end.to_bytes(self.width, "little")
        for batch in batches:
            for part in byte_slices(batch, "text", _BLOCK_BYTES):
                yield part["doc_id"], [ids + close for ids in encoder.encode(part["text"].to_pylist())]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        order = TaskContext.get().partitionId()
        fs, folder = pa.fs.FileSystem.from_uri(self.path)
        fs.create_dir(folder, recursive=True)
        # A name of its own for every attempt: a repeated task never writes into another's file.
        name = f"shard-{order:06d}-{uuid.uuid4().hex}.tok"
        lengths, names, nulls = [], [], 0
        out = None
        for keys, ids in self._encoded(iterator):
            if not ids:
                continue
            if out is None:
                out = fs.open_output_stream(f"{folder}/{name}")
                out.write(MAGIC)
            out.write(b"".join(ids))
            lengths.append(np.array([len(i) for i in ids], np.int64) // self.width)
            nulls += keys.null_count
            names.append(keys.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
        hand_back_memory()
        if out is None:
            return _Written(order, "", 0, 0, None, None, 0)
        ends, keys = np.cumsum(np.concatenate(lengths)), np.concatenate(names)
        coded = elias_fano.encode(ends), elias_fano.encode(keys)  # refuses doc_ids that do not ascend
        out.write(coded[0] + coded[1])
        out.write(struct.pack(_FOOTER, self.width, len(ends), nulls, int(ends[-1]), len(coded[0]), len(coded[1]), MAGIC))
        out.close()
        edge = (int(keys[0]), int(keys[-1])) if len(keys) else (None, None)
        return _Written(order, name, len(ends), int(ends[-1]), *edge, nulls)

    def commit(self, messages: list[_Written | None]) -> None:
        done = sorted((m for m in messages if m is not None and m.file), key=lambda m: m.order)
        last = None
        for m in done:
            if last is not None and (m.nulls or m.first < last):
                raise ValueError("shards must be ranges of ascending doc_ids")
            last = m.last if m.last is not None else last
        fs, folder = pa.fs.FileSystem.from_uri(self.path)
        fs.create_dir(folder, recursive=True)
        final, old = f"{folder}/{MANIFEST}", []
        if fs.get_file_info(final).type != pa.fs.FileType.NotFound:
            if not self.overwrite:
                raise ValueError(f"{self.path} holds a data set already")
            old = [s["file"] for s in open_manifest(self.path)[2]]
        shards = [{"file": m.file, "documents": m.documents, "tokens": m.tokens} for m in done]
        passing = f"{folder}/_{uuid.uuid4().hex}"
        with fs.open_output_stream(passing) as f:
            f.write(json.dumps({"width": self.width, "shards": shards}).encode())
        fs.move(passing, final)
        for name in old:
            fs.delete_file(f"{folder}/{name}")

    def abort(self, messages: list[_Written | None]) -> None:
        """Deletes the files of finished tasks; without a manifest nothing reads them anyway."""
        fs, folder = pa.fs.FileSystem.from_uri(self.path)
        for m in messages:
            if m is not None and m.file:
                fs.delete_file(f"{folder}/{m.file}")


class _Reader(DataSourceReader):
    def __init__(self, path: str, with_ids: bool):
        self.path, self.with_ids = path, with_ids

    def partitions(self) -> list[InputPartition]:
        before, found = 0, []
        for shard in open_manifest(self.path)[2]:
            found.append(InputPartition((shard["file"], before)))
            before += shard["tokens"]
        return found or [InputPartition(("", 0))]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        file, before = partition.value
        if not file:
            return
        fs, folder = pa.fs.FileSystem.from_uri(self.path)
        with Shard(fs, f"{folder}/{file}") as shard:
            for i in range(0, shard.n_docs, _BLOCK_DOCS):
                j = min(i + _BLOCK_DOCS, shard.n_docs)
                bounds, names = shard.bounds(i, j), shard.doc_ids(i, j)
                null = np.arange(i, j) < shard.n_null
                # Within the block: as many documents at once as some megabytes hold.
                block = (bounds[1:] - bounds[0]) * shard.width // _BLOCK_BYTES
                edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), j - i]
                for a, b in zip(edges, edges[1:]):
                    part = bounds[a : b + 1]
                    arrays = [pa.array(names[a:b], mask=null[a:b]), pa.array(before + part[:-1]), pa.array(np.diff(part))]
                    if self.with_ids:
                        ids = shard.ids(int(part[0]), int(part[-1])).astype("<u4")
                        own = ((part - part[0]) * 4).astype("<i8")
                        arrays.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(own), pa.py_buffer(ids)]).cast(pa.binary()))
                    else:
                        arrays.append(pa.nulls(b - a, pa.binary()))
                    yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids"])


class TokenShards(DataSource):
    """The data source ``token_shards``; options ``width``, ``vocabulary`` and ``end`` (writing) and ``ids`` (reading)."""

    @classmethod
    def name(cls) -> str:
        return "token_shards"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self.options.get("ids", "true") == "true")

    def writer(self, schema, overwrite: bool) -> _Writer:
        given = self.options
        return _Writer(
            given["path"], int(given.get("width", "2")), overwrite, given.get("vocabulary"), int(given.get("end", "2"))
        )
