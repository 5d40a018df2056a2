import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from framecurate.llm import mixing as M
from framecurate.llm import quality as Q
from framecurate.llm.catalog import MIX_POWERS, tokenizer_path
from framecurate.llm.common import staged, table

from test_decontam import row_by_row  # noqa: E402
from test_mixing import plain as raked  # noqa: E402
from test_simhash import plain_components, plain_simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_stage_equals_brute_force(llm_spark):
    docs = table(llm_spark, SF, "documents")
    for n, (name, stage) in enumerate(P.STAGES):
        rows = [tuple(r) for r in docs.collect()]
        got = staged(stage(llm_spark, docs, SF), f"t-{name}")
        at = {c: i for i, c in enumerate(docs.columns)}
        if n == 0:
            labels = table(llm_spark, SF, "labels").collect()
            texts = {r[at["doc_id"]]: r[at["text"]] for r in rows}
            some = sorted(((r["quality"], Q.features(texts[r["doc_id"]].encode()).tobytes()) for r in labels
                           if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1))
            model = Q.fit(np.array([np.frombuffer(x, np.float32) for _, x in some]), np.array([y for y, _ in some]))
            want = [r for r in rows if model.scores(Q.features(r[at["text"]].encode())[None])[0] >= 0.5]
            assert 0 < len(want) < len(rows)
        elif n == 1:
            comps = plain_components([(r[at["doc_id"]], plain_simhash(r[at["text"]])) for r in rows], 3)
            want = [r for r in rows if r[at["doc_id"]] == comps[r[at["doc_id"]], plain_simhash(r[at["text"]])]]
            assert len(want) < len(rows)
        elif n == 2:
            items = [" ".join(r["text"].lower().split()) for r in table(llm_spark, SF, "benchmark").collect()]
            low = {r: " ".join(r[at["text"]].lower().split()) for r in rows}
            want = [r for r in rows if not any(i in low[r] for i in items)]
            assert set(got.columns) == set(docs.columns)
            kept = {tuple(r) for r in got.collect()}
            for r in set(want) - kept:            # gone for a match with edits
                assert any(row_by_row(i, low[r])[0] <= len(i) // 10 for i in items if len(low[r]) < 20_000)
                want.remove(r)
        elif n == 3:
            tokens = [len(r[at["text"]].split()) for r in rows]
            topics = [x["t"] for x in docs.select(M.form_topic(F.col("text"), M.token_count(F.col("text"))).alias("t")).collect()]
            cells = raked([(r[at["source"]], r[at["lang"]], t, k) for r, t, k in zip(rows, topics, tokens, strict=True)],
                          MIX_POWERS, 0.7)
            drawn = {x["doc_id"]: x["u"] for x in docs.select("doc_id", M.draw(F.col("doc_id"), F.col("text"), 11).alias("u")).collect()}
            want = [r for r, t in zip(rows, topics, strict=True)
                    if drawn[r[at["doc_id"]]] < cells[r[at["source"]], r[at["lang"]], t][1]]
            assert 0 < len(want) < len(rows)
        else:
            from tokenizers import Tokenizer
            tok, start = Tokenizer.from_file(tokenizer_path()), 0
            found = {r["doc_id"]: r for r in got.collect()}
            assert len(found) == len(rows)
            for r in sorted(rows):
                ids = [*tok.encode(r[at["text"]], add_special_tokens=False).ids, 1]
                own = found[r[at["doc_id"]]]
                assert (own["start"], own["n_tokens"]) == (start, len(ids))
                assert own["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
                start += len(ids)
            whole = {tuple(r) for r in P.run(llm_spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()}
            assert whole == {(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in found.values()}
            break
        assert got.columns == docs.columns
        assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want)), name
        docs = got


def test_stages_take_odd_and_empty_tables(llm_spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in P.STAGES:
            got = staged(stage(llm_spark, docs, SF), f"t-{name}")
            if name != P.STAGES[-1][0]:
                assert got.columns == docs.columns
                assert got.count() <= docs.count()
            else:
                assert got.count() == docs.count()
