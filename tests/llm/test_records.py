import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from framecurate.llm import records as R
from framecurate.llm.catalog import tokenizer_path
from framecurate.llm.common import scratch


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_tokenizer(whole):
    rng = random.Random(2)
    texts = [None, "", " \n ", "It's I'LL x's '' 'S 'd don't a_b ½ 3²x", "a<|endoftext|>b", "<|end", "naïve ÜNÏ ßẞ ſ İ ŉ",
             "áb", "x\x0by\x85z\xa0q", "日本語 Σας", "\r\n\tq"]
    texts += ["".join(chr(rng.choice((rng.randrange(1, 0x180), rng.randrange(1, 0x3000), 32, 97, 39)))
                      for _ in range(40)) for _ in range(300)]
    got = R.WordEncoder(tokenizer_path(), room=50).encode(pa.array(texts, pa.string()))
    assert [g.tolist() for g in got] == [whole(t) for t in texts]


def test_records_hold_every_document_in_order(llm_spark, odd_docs, small_docs, whole):
    docs = odd_docs.select("doc_id", "text").unionByName(small_docs.select("doc_id", "text"))
    path = scratch(llm_spark, "t-records")
    R.write_records(docs, path, tokenizer_path())
    got = R.read_records(llm_spark, path).orderBy("start").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted(((d, np.array([*whole(t), 1], "<u4").tobytes()) for d, t in rows),
                  key=lambda x: (x[0] is not None, x[0] or 0))
    ids = [r["doc_id"] for r in got]
    assert ids == [d for d, _ in want]
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in got), key=str) == sorted(want, key=str)
    total = 0
    for r in got:
        assert r["start"] == total and r["n_tokens"] == len(r["ids"]) // 4
        total += r["n_tokens"]
    index = llm_spark.read.parquet(f"{path}/index").collect()
    assert {(r["shard"], r["offset"], r["length"], r["doc_id"], r["n_tokens"]) for r in index} == \
        {(r["shard"], r["offset"], r["length"], r["doc_id"], r["n_tokens"]) for r in got}
    files = {r["path"].rsplit("/", 1)[-1]: bytes(r["content"]) for r in
             llm_spark.read.format("binaryFile").load(f"{path}/records").collect()}
    for r in rng_sample(index, 20):       # a record alone, by its offset
        data = io.BytesIO(files[r["shard"]])
        data.seek(r["offset"])
        payload, end = R.payload_at(data.read(r["length"]), 0)
        assert end == r["length"] and R.decode(payload)[0] == r["doc_id"]
    one, two = ([r["start"] for r in R.read_shuffled(llm_spark, path, s).collect()] for s in (1, 2))
    assert sorted(one) == sorted(two) == sorted(r["start"] for r in got) and one != two


def test_files_follow_the_texts(llm_spark, small_docs):
    size = sum(len((r["text"] or "").encode()) for r in small_docs.collect())
    starts = {}
    for name, most in (("few", size), ("many", size // 30)):
        path = scratch(llm_spark, "t-records")
        R.write_records(small_docs, path, tokenizer_path(), file_bytes=most)
        got = R.read_records(llm_spark, path).collect()
        starts[name] = sorted((r["doc_id"], r["start"], bytes(r["ids"])) for r in got)
        files = {r["shard"] for r in got}
        assert len(files) > 20 if name == "many" else len(files) <= int(llm_spark.conf.get("spark.sql.shuffle.partitions"))
    assert starts["few"] == starts["many"]


def rng_sample(rows, n):
    return random.Random(1).sample(rows, n)


def test_empty_table(llm_spark, no_docs):
    path = scratch(llm_spark, "t-records")
    R.write_records(no_docs, path, tokenizer_path())
    assert R.read_records(llm_spark, path).collect() == []


def test_damage_is_noticed():
    good = R.frame(R.sequence(5, np.arange(9, dtype="<u2").tobytes(), 2)) + R.END
    payload, end = R.payload_at(good, 0)
    assert end == len(good) and R.decode(payload) == (5, np.arange(9, dtype="<u4").tobytes())
    for at in range(len(good)):
        bad = bytearray(good)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            R.payload_at(bytes(bad), 0)
    with pytest.raises(ValueError):
        R.payload_at(good[:-3], 0)
    assert R.masked_crc(b"x") != zlib.crc32(b"x")
    assert R.decode(R.sequence(None, b"\x01\x00\x00\x00", 4)) == (None, b"\x01\x00\x00\x00")
