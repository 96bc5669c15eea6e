"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadre.llm import bpe, chat, langid, licences, merkle, neardup, ranking, records, rules, suffixes, tiling, trie, warc
from cuadre.llm.common import learn_fold, new_folder, table, written

#: Folds whose labels are held out: doc_id hashes to this remainder.
QUALITY_FOLDS, QUALITY_HELD = 5, 0
LANGUAGE_FOLDS, LANGUAGE_HELD = 3, 1


#: The id that ends a document in files of token ids.
END_ID = 1


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(learn_fold("doc_id", QUALITY_FOLDS) != QUALITY_HELD)
    # texts are read once, for learning and for scores
    counts = written(ranking.counted(docs, "text"), "counted")
    scored = ranking.score_counted(counts, ranking.learn_counted(counts, labels))
    held_out = learn_fold("doc_id", QUALITY_FOLDS) == QUALITY_HELD
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = learn_fold("doc_id", LANGUAGE_FOLDS)
    samples = langid.learn(docs.where(fold != LANGUAGE_HELD).select("text", "lang"))
    found = langid.identify(docs.select("doc_id", "text"), samples)
    held_out = (fold == LANGUAGE_HELD).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "margin", "rejected")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = bpe.read_vocabulary(vocabulary_path())
    return bpe.decode(bpe.encode(docs, vocabulary), vocabulary).select("doc_id", *token_columns())


def token_columns() -> list[Column]:
    """n_tokens, ids_sha256 and decoded_sha256 from the columns ids and text."""
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    ]


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["begin"])
    return cut.select(
        "doc_id",
        (F.octet_length("kept") + n_removed).alias("n_bytes"),
        n_removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # what is left; bytes of a character that a cut divides show as U+FFFD
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents, with a row for each benchmark item that one holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = tiling.matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_words", "covered", "coverage", F.size("tiles").cast("long").alias("n_tiles"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.components(table(spark, sf_dir, "documents").select("doc_id", "text"), words=3, percent=85)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archives = warc.write_archives(pages, new_folder(spark, "warc"))
    return warc.index(warc.read_archives(archives)).drop("archive", "offset", "length")


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("found", lambda x: x["base"])
    names = lambda finds: F.array_join(F.array_sort(F.array_distinct(F.transform(finds, lambda x: x["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["first_word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["first_word"])).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["matched"])), F.lit(0.0)).alias("score"),
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    # Fixed value: a conversation whose texts hold the template's own marks.
    marks = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", marks), (-1, 1, "assistant", marks)], given.schema)
    return chat.read_back(chat.render(given.unionByName(own)))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    judged = rules.screen(docs, table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.verified(merkle.manifest(table(spark, sf_dir, "documents")))
    as_text = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return found.select("doc_id", *as_text, "proof_sha256", "folded_root", "verified")


def op12_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = bpe.read_vocabulary(vocabulary_path("word_bpe_49k.json"))
    files = records.write(docs, vocabulary, END_ID, new_folder(spark, "records"))
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return records.read(files).select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(trie.rebuilt(table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_language_id": op2_language_id,
    "op3_bpe": op3_bpe,
    "op4_suffixes": op4_suffixes,
    "op5_decontamination": op5_decontamination,
    "op6_minhash": op6_minhash,
    "op7_warc": op7_warc,
    "op8_licences": op8_licences,
    "op9_chat": op9_chat,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle": op11_merkle,
    "op12_records": op12_records,
    "op13_trie": op13_trie,
}
#: None of the queries can be said in SQL: each is tested against brute force.
ORACLE: dict[str, str] = {}
