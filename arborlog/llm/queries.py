"""One query per operator of this subpackage, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlog.llm.chat_format import format_turns, read_examples, read_turns, rendered
from arborlog.llm.chunk_dedup import repeated_passages
from arborlog.llm.collocations import collocations
from arborlog.llm.common import held_out, read_table, written
from arborlog.llm.hilbert_pack import pack
from arborlog.llm.langid import language, learn
from arborlog.llm.mixing import mix
from arborlog.llm.prefix_forest import nearest
from arborlog.llm.rans import read_blocks, write_blocks
from arborlog.llm.secret_scan import KINDS, LIVE_KIND, find_secrets
from arborlog.llm.simhash import as_hex, edited_fingerprints, likeness, with_near
from arborlog.llm.simhash_dedup import near_classes
from arborlog.llm.spelling import delete_some, spelling_forms, word_counts
from arborlog.llm.tokens import ordered_tokens, tokenizer_path
from arborlog.llm.toxicity import THRESHOLD, scored, train
from arborlog.session import new_path


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op1_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op2_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(read_table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("first_doc_id"))


def op3_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = written(edited_fingerprints(read_table(spark, sf_dir, "documents")), "fingerprints")
    # The neighbours of every 50th id among all documents.
    return with_near(found, F.col("doc_id") % 50 == 0).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_hex(F.col("fp")).alias("fingerprint"),
        as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        "n_near",
    )


def op5_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    profiles = learn(docs.filter(~held_out()).select("text", "lang"))
    found = docs.select("doc_id", held_out().alias("held_out"), language(F.col("text"), profiles).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op6_toxic_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    out = scored(docs, model).select("_doc.doc_id", "score", F.size("offending").cast("bigint").alias("n_offending"))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_offending")


def op7_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read_table(spark, sf_dir, "documents"))
    spans = F.col("spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    # The method's own spans: the values it takes for live credentials.
    live = F.transform(
        F.filter(spans, lambda s: s["live"]),
        lambda s: F.struct(s["value_start"].alias("start"), F.lit(len(KINDS) + 1).alias("place"), F.lit(LIVE_KIND).alias("kind"), s["value_end"].alias("end")),
    )
    base = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["place"].cast("int").alias("place"), s["kind"].alias("kind"), s["end"].alias("end")))
    every = F.array_sort(F.array_union(base, F.array_distinct(live)))
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(_joined(spans).cast("binary"), 256).alias("base_sha256"),
        _joined(every).alias("spans"),
        F.size(F.array_distinct(live)).cast("bigint").alias("n_live"),
        F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, s: F.greatest(a, s["n_owners"])).alias("most_owners"),
    )


def op8_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("_doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op9_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_classes(docs).select("_doc.doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op10_rans_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    path = new_path(spark, "rans")
    write_blocks(ordered_tokens(docs, ["doc_id"], end_id=2, path=tokenizer_path()), path)
    read = read_blocks(spark, path)
    return read.select("doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op11_prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # A conversation whose texts hold the marks of the template.
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    text = F.lit(r"\### Assistant: </turn> ok")
    marks = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text.alias("text"))
    formatted = written(format_turns(given.unionByName(marks)), "chat")
    # One example per reply with all turns before it. Turns after the last reply are in no example, so turns are read on their own.
    examples = read_examples(written(rendered(formatted), "chat-examples"))
    turns = read_turns(formatted).select(
        "conv_id", "place", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("turn_text"), F.col("chars").alias("turn_chars")
    )
    targets = examples.select("conv_id", "place", "loss_text", F.length("example").alias("example_chars"))
    read = turns.unionByName(targets, allowMissingColumns=True)

    def in_order(value: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct("place", value)))), lambda x: x[value]), "")

    digests = read.groupBy("conv_id").agg(
        F.count("turn_text").alias("n_turns"),
        F.sha2(in_order("turn_text").cast("binary"), 256).alias("turns_sha256"),
        F.coalesce(F.sum(F.length("loss_text")), F.lit(0)).cast("bigint").alias("loss_chars"),
        F.sha2(in_order("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.sum("turn_chars").alias("formatted_chars"),
        F.count("example_chars").alias("n_examples"),
        F.coalesce(F.sum("example_chars"), F.lit(0)).alias("examples_chars"),
    )
    return digests


def op12_stripe_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents").select("text", "lang"))


def op13_spelling_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = word_counts(read_table(spark, sf_dir, "documents").select("doc_id", "text"), edit=delete_some)
    return spelling_forms(words)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_prefix_forest": op1_prefix_forest,
    "op2_chunk_dedup": op2_chunk_dedup,
    "op3_hilbert_packing": op3_hilbert_packing,
    "op4_simhash_fingerprints": op4_simhash_fingerprints,
    "op5_rank_order_language": op5_rank_order_language,
    "op6_toxic_instances": op6_toxic_instances,
    "op7_secret_ownership": op7_secret_ownership,
    "op8_systematic_mix": op8_systematic_mix,
    "op9_simhash_bktree": op9_simhash_bktree,
    "op10_rans_blocks": op10_rans_blocks,
    "op11_prefix_target_chat": op11_prefix_target_chat,
    "op12_stripe_phrases": op12_stripe_phrases,
    "op13_spelling_gram": op13_spelling_gram,
}
