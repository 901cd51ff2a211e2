"""The registered queries of the ten operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pressroom.llm import embeddings, jaccard, language, links, mixing, packing, quality, repair, sharding, sketch, toxicity, trie, warc
from pressroom.llm.common import prepare, save, table
from pressroom.session import scratch_dir

#: The rules of the URL query, in order of statement.
RULES = [
    links.Rule.of("allow", "com/"),
    links.Rule.of("block", "example.com/en/"),
    links.Rule.of("allow", "www.example.com/en/"),
    links.Rule.of("block", "net/es/"),
    links.Rule.of("block", "net/fr/"),
]
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def op1_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written as archives and read back, segments and framing undone, revisits resolved."""
    spark = prepare(spark)
    records = warc.with_revisits(table(spark, sf, "pages"), "page_id", "url", "html")
    path = scratch_dir(spark, "llm-archives")
    warc.write_archives(records, path)
    rows = warc.decoded(warc.reassemble(warc.read_archives(spark, path)))
    digest = F.arrow_udf(_digests, "string")
    rows = rows.select(
        F.col("key").cast("long").alias("key"), "record_id", "type", "refers_to",
        F.length("payload").cast("long").alias("payload_bytes"), digest("payload").alias("payload_digest"),
        F.regexp_replace("digest", "^sha1:", "").alias("stated"), "complete",
    )
    rows = save(rows, "records")
    responses = rows.filter("type = 'response'")
    revisits = rows.filter("type = 'revisit'").select("key", "refers_to", F.col("stated").alias("payload_digest"))
    resolved = warc.resolve_revisits(responses, revisits)
    none = F.lit(None).cast("long")
    return responses.select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        none.alias("refers_to"), (F.col("complete") & (F.col("stated") == F.col("payload_digest"))).alias("intact"),
    ).union(resolved.select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"),
        F.col("response_key").alias("refers_to"), F.col("response_digest").eqNullSafe(F.col("payload_digest")).alias("intact"),
    ))


def _digests(payloads):
    import pyarrow as pa

    return pa.array([None if p is None else warc.bare_digest(p) for p in payloads.to_pylist()], pa.string())


def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document, learned from labelled rows that are not held out."""
    spark = prepare(spark)
    docs = table(spark, sf, "documents")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    network = quality.fit(docs, table(spark, sf, "labels").filter(~held))
    scored = docs.select("doc_id", held.alias("held_out"), quality.score(network)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Severity of every document; toxic where the first threshold is more likely passed than not."""
    spark = prepare(spark)
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    graded = docs.select("doc_id", toxicity.grade(model)(F.col("text")).alias("g")).select("doc_id", "g.*")
    return graded.withColumn("toxic", F.col("p_toxic") >= 0.5)


def op4_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The rule or else the host's standing for every page."""
    judged = links.judge(table(prepare(spark), sf, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def op5_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Bottom-k fingerprints of every document and of its edited text."""
    return sketch.edited_fingerprints(table(prepare(spark), sf, "documents"))


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """What a mix of all documents takes of each."""
    return mixing.mix(table(prepare(spark), sf, "documents"))


def op7_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Links and components of all vectors."""
    rows = embeddings.vector_classes(table(prepare(spark), sf, "embeddings"))
    return rows.select("vec_id", "n_links", F.col("class_id").alias("component_id"), "kept")


def op8_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate classes of all documents by word 5-gram Jaccard similarity of 0.8 or more."""
    rows = jaccard.jaccard_classes(table(prepare(spark), sf, "documents"))
    return rows.select("doc_id", "class_id", "n_links", "kept")


def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Token pieces of all documents, packed."""
    pieces = packing.token_pieces(table(prepare(spark), sf, "documents"), tokenizer_path())
    narrow = save(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.pack(narrow, ["doc_id", "piece", "ids_crc32"])


def document_pages(pages: DataFrame) -> DataFrame:
    """``(doc_id, declared, suffix, domain, host)``: evidence of the page that carries a document.

    The document's number is the last part of the page's path; of several pages the least id counts.
    """
    number = F.regexp_extract(F.coalesce("url", F.lit("")), r"://[^/?#]*/(?:[^?#]*/)?(\d{1,18})(?:\.\w+)?/?(?:[?#]|$)", 1)
    rows = pages.select(
        F.nullif(number, F.lit("")).cast("long").alias("doc_id"), "page_id",
        *[c.alias(name) for name, c in language.page_evidence(F.col("url"), F.col("html")).items()],
    ).filter("doc_id is not null")
    first = rows.groupBy("doc_id").agg(F.min(F.struct("page_id", "declared", "suffix", "domain", "host")).alias("p"))
    return first.select("doc_id", "p.declared", "p.suffix", "p.domain", "p.host")


def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document from its text and the page that carries it."""
    spark = prepare(spark)
    return language.identify(table(spark, sf, "documents"), document_pages(table(spark, sf, "pages")))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Each conversation c with its first h turns taken from conversation c - c % 100, h = crc32(c) % 6."""
    starts = conversations.select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("start")
    ).filter("base % 100 = 0")
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    rows = conversations.withColumn("head", head).withColumn("base", F.col("conv_id") - F.col("conv_id") % 100)
    none = F.array().cast("array<binary>")
    first = F.slice(F.coalesce("start", none), F.lit(1), F.col("head"))
    own = F.slice("turns", F.col("head") + 1, F.size("turns"))
    return rows.join(starts, "base", "left").select("conv_id", F.concat(first, own).alias("turns"))


def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    turns = table(prepare(spark), sf, "conversations")
    return trie.prefix_trie(rebuilt(trie.conversation_turns(turns))).drop("turn")


def op12_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes, equal texts together."""
    rows = sharding.assign_shards(table(prepare(spark), sf, "documents"), 16)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults by crc32(`conv_id:turn`) % 20; nulls are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    rows = conversations.select(
        "conv_id", "turn", kind.alias("kind"), F.coalesce("role", space).alias("role"), text.alias("text")
    ).filter("kind <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op13_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Faults and the cheapest repair of all conversations after planted damage."""
    conversations = table(prepare(spark), sf, "conversations")
    turns = damaged(conversations)
    return repair.repaired_digests(turns, repair.repairs(turns, conversations))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    functions = [
        op1_warc, op2_quality, op3_toxicity, op4_url_filter, op5_fingerprints, op6_mixing, op7_vectors,
        op8_jaccard, op9_packing, op10_language, op11_prefix_trie, op12_sharding, op13_repair,
    ]
    return {f.__name__: f for f in functions}


def llm_oracles() -> dict[str, str]:
    from pressroom.llm.oracles import ORACLES

    return dict(ORACLES)
