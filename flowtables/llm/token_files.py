"""Token ids in compressed segments with one shared dictionary.

A *token table* is a folder with two Parquet tables:

``dictionary``
    one row: ``dictionary_hash`` (sha256, hex), ``dictionary`` (bytes; empty if the
    sample was too small to train one).
``segments``
    rows of about ``SEGMENT_BYTES``: ``part`` (range of ids), ``segment`` (number in
    the part), ``first_id``, ``last_id``, ``n_tokens``, ``dictionary_hash``, the
    offset index ``doc_ids``, ``offsets``, ``lengths``, ``starts`` (tokens of the
    part before the document), and ``frames``: the documents' zstandard frames
    one after the other.  Each frame holds one document's ids as little-endian
    unsigned 32-bit integers and can be read alone.

Parts follow each other in ascending document id, null first; so do segments in a
part and documents in a segment.  Parquet's own statistics of ``first_id`` and
``last_id`` lead to the segment of a document.  Spark's committer makes half-written
files of lost executors vanish, on any file system that Spark knows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.taskcontext import TaskContext

from flowtables.plans.sizes import scratch_path

#: Bytes of frames after which a segment is closed; a longer document is one segment.
SEGMENT_BYTES = 256 << 10
#: The dictionary is trained on this many documents of at most this many bytes: those
#: of least hash.  It only bears on the size of the frames.
SAMPLE_DOCUMENTS = 400
SAMPLE_TEXT_BYTES = 16 << 10
DICTIONARY_BYTES = 64 << 10
#: Known pieces of text that a Python worker keeps; beyond that it starts anew.
KNOWN_PIECES = 600_000

SEGMENTS = (
    "part int, segment int, first_id long, last_id long, n_tokens long, dictionary_hash string, "
    "doc_ids array<long>, offsets array<long>, lengths array<long>, starts array<long>, frames binary"
)

#: Fixed values of byte-level vocabularies: bytes that stand for themselves; the others
#: follow from U+0100 on, in order.
SELF_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Fixed value: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: What can follow letters inside a piece and is one token of the pattern.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class _Fallback(Exception):
    """The text must be encoded in one go."""


class Encoder:
    """Ids of whole texts as bytes, by the ``tokenizers`` library.

    Text before a space that is followed by no white space is a boundary of the
    vocabulary's pattern, so pieces between single spaces can be encoded alone, and
    each is encoded once while it is remembered.  Texts with other runs of spaces,
    or with special tokens, are encoded whole.  Both give the ids of
    ``encode(text, add_special_tokens=False)``.  Vocabularies that are not byte-level
    BPE with the standard pattern are always encoded whole.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.model = self.tokenizer.model
        said = __import__("json").loads(vocabulary)
        before, model = said.get("pre_tokenizer") or {}, said["model"]
        self.by_piece = (
            said.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and model.get("type") == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
            and not any(x.get("lstrip") or x.get("rstrip") or x.get("normalized") for x in said["added_tokens"])
        )
        self.special = [x["content"] for x in said["added_tokens"]]
        others = [b for b in range(256) if b not in set(SELF_BYTES)]
        self.letters = {b: chr(b) for b in SELF_BYTES} | {b: chr(0x100 + i) for i, b in enumerate(others)}
        self.split = regex.compile(PATTERN).findall
        self.tokens: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = _Pieces(self)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def token(self, part: str) -> bytes:
        """Ids of what the pattern takes as one."""
        ids = self.tokens.get(part)
        if ids is None:
            letters = part.encode().decode("latin-1").translate(self.letters)
            ids = self.tokens[part] = np.array([t.id for t in self.model.tokenize(letters)], "<u4").tobytes()
        return ids

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_piece or any(x in text for x in self.special):
            return self.whole(text)
        if len(self.pieces) > KNOWN_PIECES:
            self.pieces.clear()
            self.tokens.clear()
        first, *rest = text.split(" ")
        try:
            known = self.pieces.__getitem__
            return b"".join([*map(self.token, self.split(first)), *map(known, rest)])
        except _Fallback:
            return self.whole(text)


class _Pieces(dict):
    """Ids of a piece with the space before it."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        encoder = self.encoder
        if not piece or piece[0].isspace():
            raise _Fallback
        word = piece.rstrip(MARKS)
        if word.isalpha():
            ids = encoder.token(" " + word) + (encoder.token(piece[len(word) :]) if len(word) < len(piece) else b"")
        else:
            ids = b"".join(map(encoder.token, encoder.split(" " + piece)))
        self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def train_dictionary(docs: DataFrame, doc_id: str, text: str, vocabulary, end_id: int) -> bytes:
    """A zstandard dictionary from a bounded sample of id arrays; empty if the sample
    is too small for one."""
    bounded = docs.select(doc_id, text).where(F.octet_length(text).between(1, SAMPLE_TEXT_BYTES))
    sample = bounded.orderBy(F.xxhash64(doc_id, text)).limit(SAMPLE_DOCUMENTS).select(F.col(text).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        for batch in batches:
            ids = [encoder(t) + np.array([end_id], "<u4").tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"ids": pa.array(ids, pa.binary())})

    samples = sorted(r.ids for r in sample.mapInArrow(encode, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(s) for s in samples]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    level: int = 1,
) -> None:
    """Encode every whole text (null: empty), with ``end_id`` after it, into a token
    table at ``path``.  ``vocabulary_path`` is a file of the ``tokenizers`` library on
    the driver, sent once to each executor (a vocabulary is a few MB).

    One shuffle puts documents into ranges of their id; each range is encoded where it
    is written.  Rows of equal id are all kept, by text; a null id sorts first.  An
    empty table gives a table without segments.  Other columns are not read.
    """
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    trained = train_dictionary(docs, doc_id, text, vocabulary, end_id)
    digest = hashlib.sha256(trained).hexdigest()
    spark.createDataFrame([(digest, trained)], "dictionary_hash string, dictionary binary").coalesce(1).write.parquet(
        f"{path}/dictionary"
    )
    shared = spark.sparkContext.broadcast(trained)
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(vocabulary.value), TaskContext.get().partitionId()
        known = zstandard.ZstdCompressionDict(shared.value) if shared.value else None
        # a frame's size of content is in its head: reading needs no bound
        compress = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=False).compress
        segment, rows, frames, size, before, tokens = 0, [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            ids, offsets, lengths, starts = map(list, zip(*rows))
            at = [x for x in ids if x is not None]
            one = {
                "part": part, "segment": segment, "first_id": min(at, default=None), "last_id": max(at, default=None),
                "n_tokens": tokens - before, "dictionary_hash": digest, "doc_ids": ids, "offsets": offsets,
                "lengths": lengths, "starts": starts, "frames": b"".join(frames),
            }
            return pa.RecordBatch.from_pylist([one], schema=_arrow_segments())

        for batch in batches:
            for key, body in zip(batch["id"].to_pylist(), batch["text"]):
                ids = encoder(body.as_py() or "") + end
                frame = compress(ids)
                rows.append((key, size, len(frame), tokens))
                frames.append(frame)
                size, tokens = size + len(frame), tokens + len(ids) // 4
                if size >= SEGMENT_BYTES:
                    yield close()
                    segment, rows, frames, size, before = segment + 1, [], [], 0, tokens
        if rows:
            yield close()

    wanted = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    ranges = wanted.repartitionByRange("id").sortWithinPartitions("id", "text")
    ranges.mapInArrow(pack, SEGMENTS).write.option("parquet.block.size", 16 << 20).option(
        "compression", "uncompressed"
    ).parquet(f"{path}/segments")


def _arrow_segments() -> pa.Schema:
    longs = pa.list_(pa.int64())
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), longs, longs, longs, longs, pa.binary()]
    return pa.schema(list(zip([c.split()[0] for c in SEGMENTS.split(", ")], kinds)))


def _segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENTS).parquet(f"{path}/segments")


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    held = bytes(row.dictionary)
    if hashlib.sha256(held).hexdigest() != row.dictionary_hash:
        raise ValueError("the dictionary does not have the hash that is kept with it")
    return row.dictionary_hash, held


def read_tokens(spark: SparkSession, path: str, digest_only: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of all documents, ``start`` being the number of
    ids of all documents before it; with ``digest_only``, ``ids_crc32`` in place of
    ``ids``.  A segment's index counts from the start of its part; what is added is a
    running sum over parts, one row for each task that wrote, and is broadcast."""
    segments = _segments(spark, path)
    digest, held = _dictionary(spark, path)
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))
    last = "ids_crc32 long" if digest_only else "ids array<long>"
    frames = segments.drop("n_tokens", "first_id", "last_id").join(F.broadcast(before), "part")
    return frames.mapInArrow(_unpack(digest, held, digest_only), f"doc_id long, start long, n_tokens long, {last}")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of a few documents (``start`` in the part):
    only segments whose range of ids can hold them are read, and only their frames
    are unpacked."""
    wanted = sorted(set(doc_ids))
    digest, held = _dictionary(spark, path)
    at = F.lit(False)
    for key in wanted:
        at = at | ((F.col("first_id") <= key) & (F.col("last_id") >= key))
    frames = _segments(spark, path).where(at).select(
        "dictionary_hash", "doc_ids", "offsets", "lengths", "starts", "frames", F.lit(0).cast("long").alias("start")
    )
    return frames.mapInArrow(_unpack(digest, held, False, set(wanted)), "doc_id long, start long, n_tokens long, ids array<long>")


def _unpack(digest: str, held: bytes, digest_only: bool, wanted: set[int] | None = None):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        known = zstandard.ZstdCompressionDict(held) if held else None
        decompress = zstandard.ZstdDecompressor(dict_data=known).decompress
        for batch in batches:
            columns = [batch[c] for c in ("dictionary_hash", "doc_ids", "offsets", "lengths", "starts", "start", "frames")]
            for hashed, ids, offsets, lengths, starts, start, frames in zip(*columns):
                if hashed.as_py() != digest:
                    raise ValueError("a segment was written with another dictionary")
                body, out = memoryview(frames.as_buffer()), {"doc_id": [], "start": [], "n_tokens": [], "last": []}
                index = zip(ids.as_py(), offsets.as_py(), lengths.as_py(), starts.as_py())
                for key, offset, length, before in index:
                    if wanted is not None and key not in wanted:
                        continue
                    raw = decompress(body[offset : offset + length])
                    out["doc_id"].append(key)
                    out["start"].append(start.as_py() + before)
                    out["n_tokens"].append(len(raw) // 4)
                    out["last"].append(zlib.crc32(raw) if digest_only else np.frombuffer(raw, "<u4").astype("int64"))
                last = pa.array(out.pop("last"), pa.int64() if digest_only else pa.list_(pa.int64()))
                longs = [pa.array(v, pa.int64()) for v in out.values()]
                yield pa.RecordBatch.from_arrays([*longs, last], [*out, "ids_crc32" if digest_only else "ids"])

    return unpack


def token_digests(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Write the documents' token table to the shared folder and read it back:
    ``doc_id, start, n_tokens, ids_crc32``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, vocabulary_path)
    return read_tokens(spark, path, digest_only=True)
