"""Registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framecurate.llm import oracles
from framecurate.llm.common import prepare, scratch, table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def token_records(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write docs as records, read the files back: (doc_id, start, n_tokens,
    ids_crc32), with the place of each record in its file."""
    from framecurate.llm import records
    path = scratch(spark, "token-records")
    records.write_records(docs, path, tokenizer_path())
    return records.read_records(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"), "shard", "offset", "length")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated lines of every document: SimHash at most 3 bits apart, edit similarity 0.8."""
    from framecurate.llm.line_dedup import line_report
    prepare(spark)
    return line_report(table(spark, sf_dir, "documents"), radius=3, pieces=6, similarity=0.8)


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents through the binary record files."""
    prepare(spark)
    return token_records(spark, table(spark, sf_dir, "documents"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-256 sketches of 5-word shingles of all documents and their edits."""
    from framecurate.llm.sketch import compare_with_edits
    prepare(spark)
    return compare_with_edits(table(spark, sf_dir, "documents"), k=256, shingle=5)


#: Target shares are the own shares to these powers: rare sources gain most.
MIX_POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}


def mixed(docs: DataFrame, keep: float, source: str = "source", lang: str = "lang",
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    from framecurate.llm import mixing
    tokens = mixing.token_count(F.col(text_col))
    dims = {"source": F.col(source), "lang": F.col(lang), "topic": mixing.form_topic(F.col(text_col), tokens)}
    return mixing.mix(docs, dims, powers=MIX_POWERS, keep=keep, seed=11, id_col=id_col, text_col=text_col)


def mixed_sample(docs: DataFrame, keep: float) -> DataFrame:
    """The rows drawn, with the columns of docs, whatever other names they have."""
    own = docs.toDF(*[f"c{n}" for n in range(len(docs.columns))])
    at = {name: f"c{docs.columns.index(name)}" for name in ("doc_id", "text", "source", "lang")}
    got = mixed(own, keep, at["source"], at["lang"], at["doc_id"], at["text"])
    return got.where("_selected").select(*own.columns).toDF(*docs.columns)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its raked weight, probability and draw; the budget is
    half of all tokens."""
    prepare(spark)
    got = mixed(table(spark, sf_dir, "documents"), keep=0.5)
    return got.select("doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"),
                      F.round("_weight", 6).alias("weight"), F.round("_probability", 6).alias("probability"),
                      F.col("_selected").alias("selected"))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """Ranker learnt from labels.quality, without the held-out third of the ids."""
    from framecurate.llm.quality import train
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id"))
    return train(docs, labels, max_labelled=20_000, max_pairs=60_000)


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op5_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bradley-Terry quality score of every document."""
    from framecurate.llm.quality import score
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from framecurate.llm.html_crf import extract_text, train
    prepare(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages, train(pages, max_pages=300))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, weak parts only where complementary ones are near."""
    from framecurate.llm.secrets import find_secrets
    prepare(spark)
    return find_secrets(table(spark, sf_dir, "documents"), scope=200)


def op8_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff bigram score of every document under the corpus's own counts."""
    from framecurate.llm.ngram_lm import score_documents
    prepare(spark)
    got = score_documents(table(spark, sf_dir, "documents"), order=2, min_count=2, backoff=0.4)
    per_token = F.when(F.col("n_tokens") > 0, F.col("log_score") / F.col("n_tokens"))
    return got.select("doc_id", "n_tokens", F.round("log_score", 4).alias("log_score"),
                      F.round(per_token, 6).alias("log_score_per_token"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item in every document, with edits in up to a tenth of its characters."""
    from framecurate.llm.decontam import find_items
    prepare(spark)
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), rate=0.1)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document: 3-word shingles, fingerprints at most 3 bits apart."""
    from framecurate.llm.simhash import simhash_components
    prepare(spark)
    got = simhash_components(table(spark, sf_dir, "documents"), shingle=3, radius=3, pieces=5)
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for the terms of every benchmark item."""
    from framecurate.llm.ranked import rank_documents
    prepare(spark)
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest inner products of every vector whose id 50 divides, against all others."""
    from framecurate.llm.topk import top_k
    prepare(spark)
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the frequent word one edit away, if any."""
    from framecurate.llm.spelling import count_words, group_variants
    prepare(spark)
    words = count_words(table(spark, sf_dir, "documents"), slip=97, min_chars=5, min_count=3)
    return group_variants(words, ratio=2)


QUERIES = {f.__name__: f for f in (
    op1_line_dedup,
    op2_token_records,
    op3_document_fingerprints,
    op4_source_mixing,
    op5_quality_ranking,
    op6_html_extraction,
    op7_secret_scan,
    op8_backoff_scores,
    op9_benchmark_decontamination,
    op10_simhash_near_dedup,
    op11_ranked_search,
    op12_exact_top_k,
    op13_spelling_variants,
)}

ORACLE_SQL: dict[str, str] = oracles.oracle_sql(MIX_POWERS)
