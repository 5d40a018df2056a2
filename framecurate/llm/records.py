"""Token ids in length-delimited binary record files with an offset index.

A file is a run of records in ascending document order:

    uint64  length of the payload                  (all numbers little-endian)
    uint32  masked checksum of those 8 bytes
    payload
    uint32  masked checksum of the payload
    0x0A    end of the record

The payload is one serialized sequence: a flag byte (1: the id is null,
2: ids take 4 bytes instead of 2), int64 doc_id, uint32 number of ids, ids.
A checksum is CRC-32, masked as rotate-right 15 plus a constant so that data
that hold checksums are checked soundly.  Beside the files lies `index/`, a
Parquet table with one row a record (shard, offset, length, doc_id, n_tokens,
first_token), so that readers can visit records in any order.

Files are written by Spark's own text writer, record by record, and so by its
commit protocol on whatever store the path names: a lost task leaves nothing
behind and is written again.
"""

from __future__ import annotations

import json
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framecurate.llm.common import bucket_of, id_buckets, shuffle_partitions

MASK = 0xA282EAD8
_HEAD, _SEQ = struct.Struct("<QI"), struct.Struct("<BqI")
_UINT = struct.Struct("<I")
END = b"\n"


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """One record without its end byte."""
    length = struct.pack("<Q", len(payload))
    return b"".join((length, _UINT.pack(masked_crc(length)), payload, _UINT.pack(masked_crc(payload))))


def sequence(doc_id: int | None, ids: bytes, width: int) -> bytes:
    flags = (doc_id is None) | (width == 4) << 1
    return _SEQ.pack(flags, doc_id or 0, len(ids) // width) + ids


def payload_at(data, offset: int) -> tuple[memoryview, int]:
    """The checked payload of the record at the offset, and the next offset."""
    view = memoryview(data)
    if len(view) < offset + _HEAD.size:
        raise ValueError(f"record at {offset}: the file ends within it")
    length, check = _HEAD.unpack_from(view, offset)
    if check != masked_crc(view[offset:offset + 8]):
        raise ValueError(f"record at {offset}: length checksum differs")
    start = offset + _HEAD.size
    payload = view[start:start + length]
    if len(view) < start + length + 5:
        raise ValueError(f"record at {offset}: the file ends within it")
    if _UINT.unpack_from(view, start + length)[0] != masked_crc(payload):
        raise ValueError(f"record at {offset}: payload checksum differs")
    if view[start + length + 4] != END[0]:
        raise ValueError(f"record at {offset}: no end byte")
    return payload, start + length + 5


def decode(payload) -> tuple[int | None, bytes]:
    """(doc_id, ids as little-endian uint32 bytes) of a sequence."""
    flags, doc_id, n = _SEQ.unpack_from(payload, 0)
    ids = payload[_SEQ.size:]
    if len(ids) != n * (4 if flags & 2 else 2):
        raise ValueError("a sequence's ids do not fill its payload")
    wide = bytes(ids) if flags & 2 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
    return (None if flags & 1 else doc_id), wide


# ------------------------------------------------------------------- encoding

#: Texts of these characters only are cut into the tokenizer's own pieces here
#: (its split pattern for lower-cased text below U+0180: contractions, runs of
#: letters, single numbers, runs of other signs); all others go through whole.
_PLAIN = r"\A[\t\n\r -~¡-įı-ſ]*\z"
_APART = r"('s|'t|'re|'ve|'m|'ll|'d|[0-9²³¹¼½¾]|[!-/:-@\[-`{-~¡-©«-±´¶-¸»¿×÷]+)"


class WordEncoder:
    """Encodes batches with a word-level BPE tokenizer, keeping the ids of the
    pieces seen before in a bounded table: a piece's ids do not depend on its
    neighbours.  Gives what the tokenizer gives for each whole text."""

    def __init__(self, path: str, room: int = 1_000_000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.room, self.known = room, {}
        own = json.loads(self.tokenizer.to_str())
        split = str((own.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0].get("pattern"))
        suffix = own["model"].get("end_of_word_suffix")
        self.by_piece = bool(suffix and "'s|'t|'re|'ve|'m|'ll|'d|" in split
                             and "Lowercase" in str(own.get("normalizer")))
        self.ends = np.zeros(max(vocab.values()) + 1, bool)     # tokens that end a piece
        if self.by_piece:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    def whole(self, text: str) -> np.ndarray:
        got = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)   # without offsets
        return np.array(got[0].ids, self.dtype)

    def _learn(self, new: list[str]) -> None:
        ids = self.whole(" ".join(new))
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(new):
            self.known.update((p, self.whole(p).tobytes()) for p in new)
            return
        cuts, raw = (cuts * self.dtype.itemsize).tolist(), ids.tobytes()
        self.known.update((p, raw[s:e]) for p, s, e in zip(new, [0, *cuts[:-1]], cuts, strict=True))

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, end of each text in them)."""
        lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.replace_substring_regex(
            pc.utf8_lower(texts), _APART, r" \1 ")))
        coded = lists.flatten().dictionary_encode()
        index, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        new = [p for p in names if p and p not in self.known]
        if self.known and len(self.known) + len(new) > self.room:
            self.known.clear()                        # start anew; frequent pieces return at once
            new = [p for p in names if p]
        if new:
            self._learn(new)
        each = [self.known[p] if p else b"" for p in names]
        size = np.fromiter(map(len, each), np.int64, len(each)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(each), self.dtype)
        first = np.cumsum(size) - size
        long = size[index]
        ends = np.cumsum(long)
        at = np.repeat(first[index] - (ends - long), long) + np.arange(ends[-1] if len(ends) else 0)
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return flat[at], np.concatenate([[0], ends])[offsets[1:]]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text; null counts as empty."""
        texts = pc.fill_null(texts, "")
        plain = pc.match_substring_regex(texts, _PLAIN) if self.by_piece else pa.array([False] * len(texts))
        for m in self.marks:
            plain = pc.and_not(plain, pc.match_substring(texts, m))
        out: list = [None] * len(texts)
        where = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
        if len(where):
            ids, ends = self._pieces(texts.take(pa.array(where)))
            for i, s, e in zip(where.tolist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                out[i] = ids[s:e]
        for i in np.flatnonzero(~plain.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self.whole(texts[i].as_py())
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One a Python worker and tokenizer file."""
    return WordEncoder(path)


#: Bytes of text a records file is made for; ids take about half as many.
FILE_BYTES = 512 << 20


def _ranges_for(own: DataFrame, file_bytes: int) -> int:
    """As many ranges of ids as the texts fill files, and no fewer than tasks."""
    total = own.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(shuffle_partitions(own.sparkSession), -(-total // file_bytes))


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
                     text_col: str = "text", end_id: int = 1, file_bytes: int = FILE_BYTES) -> DataFrame:
    """(record binary) of every row, in ascending (id, text hash) order over the
    partitions and within each; end_id is appended to every sequence."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    cuts = id_buckets(own.select("doc_id"), "doc_id", _ranges_for(own, file_bytes))
    rows = (own.withColumn("part", bucket_of(F.col("doc_id"), cuts)).repartitionById(len(cuts) + 1, "part")
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).drop("part"))

    def run(batches):
        for b in batches:
            enc = encoder(tokenizer)
            end = np.array([end_id], enc.dtype).tobytes()
            texts = b.column(1)
            for at in range(0, b.num_rows, 512):       # bounds what a batch of long texts takes
                out = [frame(sequence(i, ids.tobytes() + end, enc.dtype.itemsize))
                       for i, ids in zip(b.column(0).slice(at, 512).to_pylist(),
                                         enc.encode(texts.slice(at, 512)), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return rows.mapInArrow(run, "record binary")


_ENTRIES = "shard string, offset long, length long, doc_id long, n_tokens long, first_token long, ids binary"


def _parse(with_ids: bool):
    def run(batches):
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                view, at, first, rows = memoryview(data.as_buffer()), 0, 0, []
                shard = path.rsplit("/", 1)[-1]
                while at < len(view):
                    payload, after = payload_at(view, at)
                    doc_id, ids = decode(payload)
                    rows.append((shard, at, after - at, doc_id, len(ids) // 4, first,
                                 ids if with_ids else None))
                    first += len(ids) // 4
                    at = after
                    if len(rows) == 1024 or at >= len(view):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)],
                            names=[f.split()[0] for f in _ENTRIES.split(", ")])
                        rows = []
    return run


_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def _scan(spark: SparkSession, path: str, with_ids: bool) -> DataFrame:
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*.txt")
             .load(f"{path}/records").select("path", "content"))
    return files.mapInArrow(_parse(with_ids), _ENTRIES)


def write_records(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id",
                  text_col: str = "text", end_id: int = 1, file_bytes: int = FILE_BYTES) -> None:
    """Write <path>/records (one file a range of ids, numbered in ascending
    order) and <path>/index.

    Every row becomes a record: a null or empty text is the end id alone, a
    null id sorts first and is kept as null, rows of equal ids follow one
    another, other columns are ignored.  An empty table writes no record.
    A file is read whole by a task, so the number of files follows the texts: one
    for about file_bytes of them, at least one a shuffle partition.
    """
    spark = docs.sparkSession
    (encode_documents(docs, tokenizer, id_col, text_col, end_id, file_bytes)
     .select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", END.decode()).text(f"{path}/records"))
    _scan(spark, path, False).drop("ids").write.parquet(f"{path}/index")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records, checked: (shard, offset, length, doc_id, n_tokens,
    first_token, start, ids).  first_token counts the ids before the record in
    its file, start those before it in all files; ids are little-endian uint32."""
    index = spark.read.parquet(f"{path}/index")
    sums = index.groupBy("shard").agg(F.sum("n_tokens").alias("n"))      # a row a file
    # by number: names of 100,000 files and more do not sort as their numbers do
    number = F.regexp_extract("shard", r"part-(\d+)", 1).cast("int")
    base = sums.select("shard", (F.sum("n").over(Window.orderBy(number, "shard")) - F.col("n")).alias("base"))
    return (_scan(spark, path, True).join(F.broadcast(base), "shard")
            .select("shard", "offset", "length", "doc_id", "n_tokens", "first_token",
                    (F.col("base") + F.col("first_token")).alias("start"), "ids"))


def read_shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """read_records in the seed's random order over all partitions, the order
    being drawn from the index alone."""
    index = spark.read.parquet(f"{path}/index").select(
        "shard", "offset", F.xxhash64(F.lit(seed), "shard", "offset").alias("place"))
    return (read_records(spark, path).join(index, ["shard", "offset"])
            .repartitionByRange(shuffle_partitions(spark), "place")
            .sortWithinPartitions("place", "shard", "offset").drop("place"))
