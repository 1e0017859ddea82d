"""The registered queries of this subpackage and their SQL."""

from pyspark.sql import functions as F

from spendgrid.llm import bpe, checks, fim, langid, mixing, negatives, ngram_join, packing, quality_rank, quality_rules, store, suffix_dedup, token_files, topk, warc
from spendgrid.sources.tables import forget_bucketed


def _read(spark, folder, table):
    return spark.read.parquet(f"{folder}/{table}.parquet")


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _held_out(column="doc_id"):
    """The fold that no model learns from."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op1_quality_ranking(spark, folder):
    docs, labels = _read(spark, folder, "documents"), _read(spark, folder, "labels")
    rows = quality_rank.described(docs)
    model = quality_rank.fit_all(rows, labels.where(~_held_out()))
    return quality_rank.score_all(rows, model).select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_ngram_jaccard(spark, folder):
    return ngram_join.joined(_read(spark, folder, "documents"), k=4, threshold="0.85")


def op3_mixing(spark, folder):
    out = mixing.mix(_read(spark, folder, "documents"), columns=["doc_id"])
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op4_quality_rules(spark, folder):
    rows = quality_rules.ledger(_read(spark, folder, "documents"))
    base = quality_rules.Policy("base", tuple(quality_rules.BASE))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality_rules.kept(base)).alias("base_failed"),
        quality_rules.kept(quality_rules.POLICIES["v2"]).alias("kept"),
        "bits",
    )


def op5_suffix_dedup(spark, folder):
    return suffix_dedup.removed(_read(spark, folder, "documents"))


def op6_exact_topk(spark, folder):
    return topk.top_k(_read(spark, folder, "embeddings"), k=20, query_every=20)


def op7_language_id(spark, folder):
    docs = _read(spark, folder, "documents")
    model = langid.fit(docs.where(~_held_out()))
    return langid.predict(docs, model).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


def op8_warc(spark, folder):
    """Writes the archives to the shared folder and reads them back, payloads of responses included."""
    with store.scratch(spark, "op8") as place:
        manifest = warc.write_manifest(warc.write_warc(_read(spark, folder, "pages"), place), place)
        digest = F.regexp_replace("payload_digest", "^sha1:", "")
        responses = warc.read_warc(spark, place, ["record_type", "page_id", "payload_digest", "payload"], manifest).where("record_type = 'response'")
        revisits = warc.read_warc(spark, place, ["record_type", "page_id", "payload_digest", "payload_length", "refers_to"], manifest).where("record_type = 'revisit'")
        out = responses.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
        page = F.regexp_extract("refers_to", r"^<urn:page:(-?\d+)>$", 1).cast("long")
        return store.cut(out.union(revisits.select("page_id", F.col("payload_length"), digest, "record_type", page)))


def op9_best_fit_packing(spark, folder):
    return packing.pack(_read(spark, folder, "documents"), tokenizer())


def op10_token_files(spark, folder):
    """Writes the files to the shared folder, reads them back, checks every frame."""
    with store.scratch(spark, "op10") as place:
        files = token_files.write_token_files(_read(spark, folder, "documents"), place, tokenizer())
        return store.cut(token_files.read_token_files(files, place, with_ids=False).drop("ids"))


def op11_bpe_words(spark, folder):
    """Blocks are written to the shared folder; only digests of ids and texts are returned."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    with store.scratch(spark, "op11") as place:
        rows = bpe.encode(_read(spark, folder, "documents"), path, place).withColumn("ids_sha256", F.sha2("ids", 256))
        kept = ("doc_id", "n_tokens", "ids_sha256")
        out = store.cut(bpe.decoded(rows, path, kept).select(*kept, F.sha2("text", 256).alias("decoded_sha256")))
        forget_bucketed(spark, place)
        return out


def op12_fill_in_middle(spark, folder):
    out = fim.fill_in_middle(_read(spark, folder, "documents"))
    named = out.select("*", F.sha2("output", 256).alias("output_sha256"))
    kept = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256")
    return fim.restored(named, kept).select(*kept, F.sha2("text", 256).alias("restored_sha256"))


def op13_hard_negatives(spark, folder):
    moved = lambda vec_id, label: F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(_read(spark, folder, "embeddings"), relabel=moved)


QUERIES = {
    "op1_quality_ranking": op1_quality_ranking,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_mixing": op3_mixing,
    "op4_quality_rules": op4_quality_rules,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_exact_topk": op6_exact_topk,
    "op7_language_id": op7_language_id,
    "op8_warc": op8_warc,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_token_files": op10_token_files,
    "op11_bpe_words": op11_bpe_words,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL = {
    "op2_ngram_jaccard": checks.NGRAM_JACCARD,
    "op3_mixing": checks.MIXING,
    "op4_quality_rules": checks.QUALITY_RULES,
    "op6_exact_topk": checks.EXACT_TOPK,
    "op8_warc": checks.WARC,
    "op12_fill_in_middle": checks.FILL_IN_MIDDLE,
    "op13_hard_negatives": checks.HARD_NEGATIVES,
}
