"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)``, works on all documents that its predecessor kept and
returns a DataFrame, which is written as Parquet and read again as the next one's ``docs``. All but
the last return the columns of ``documents``. No stage looks at columns other than ``doc_id``,
``text``, ``lang`` and ``source``; nulls in any of them are handled as each operator states, and
other columns pass through whatever their names.

Rows are known by their place in the files they are read from. Stages decide on ids, hashes and
sizes, and the texts meet the decisions in one join at the end. A stage's result has to be written
before the next stage is called, which deletes the tables that the one before has saved.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressroom.llm import jaccard, language, mixing, packing, toxicity
from pressroom.llm.common import free_name, prepare, save, table, with_rows
from pressroom.llm.queries import document_pages, tokenizer_path
from pressroom.operators.numbering import numbered
from pressroom.session import release, store, stored

#: No stage sequence has a statement in SQL: it fits models, shingles words and runs a tokenizer.
ORACLE_SQL = None
_EARLIER: list[tuple[SparkSession, str]] = []

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(function: Stage) -> Stage:
    """A stage that deletes the tables which the stage before has saved."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(_EARLIER)
        before = stored()
        out = function(prepare(spark), docs, sf_dir)
        _EARLIER[:] = [t for t in stored() if t not in before]
        return out

    return run_stage


@stage
def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; each row is judged, and those without id have no page's evidence."""
    rows, row = with_rows(docs)
    judged = language.identify(rows, document_pages(table(spark, sf_dir, "pages")), row_col=row)
    rejected = save(judged.filter("not kept").select(row), "rejected")
    return rows.join(rejected, row, "left_anti").drop(row)


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not more likely toxic than not."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    grade = free_name(docs, "toxicity")
    graded = docs.withColumn(grade, toxicity.grade(model)(F.col("text")))
    return graded.filter(F.col(grade)["p_toxic"] < 0.5).drop(grade)


@stage
def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each near-duplicate class, one without id where none has any.

    Every row is compared, whether it has an id or shares one with others; ties go by content.
    """
    rows, row = with_rows(docs)
    content = F.xxhash64("text", "lang", "source")
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", content.alias("hash"), F.col(row).alias("row"))
    classes = jaccard.jaccard_classes(rows, id_col=row, unique=True).select(row, "class_id")
    least = classes.join(rows.select(row, order.alias("order")), row).groupBy("class_id").agg(F.min("order").alias("least"))
    kept = save(least.select(F.col("least.row").alias(row)), "kept")
    return rows.join(kept.hint("merge"), row, "left_semi").drop(row)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to the sources' target weights takes it.

    Rows are told apart by their id; those without one by a hash of their content, and rows that
    share either by a number, in the order of their content.
    """
    rows, row = with_rows(docs)
    content = F.xxhash64("text", "lang", "source")
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), content))
    narrow = rows.select(
        F.col(row).alias("row"), name.alias("name"), content.alias("content"), "source",
        mixing.word_count(F.col("text")).alias("words"),
    )
    narrow = numbered(save(narrow, "mix-rows"), ["content", "row"], "number", by=["name"])
    again = F.when(F.col("number") == 0, F.col("name")).otherwise(F.concat("name", F.lit("#"), F.col("number") + 1))
    named = save(narrow.select("row", again.alias("name"), "source", "words"), "mix-names")
    mixed = mixing.mix(named, id_col="name", source_col="source", size_col="words").filter("taken > 0")
    times = mixed.select("name", (F.col("taken") / F.col("size")).cast("int").alias("times"))
    copies = free_name(rows, "times")
    times = save(named.join(times, "name").select(F.col("row").alias(row), F.col("times").alias(copies)), "times")
    taken = rows.join(times.hint("merge"), row)
    copy = free_name(taken, "copy")
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).drop(row, copies, copy)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their ids, their sequence and their offset in it.

    ``packing.sequences`` puts the ids of a sequence together.
    """
    pieces = packing.token_pieces(docs, tokenizer_path())
    pieces = save(pieces.withColumns({"ids_crc32": F.crc32("ids"), "row": F.monotonically_increasing_id()}), "pieces")
    placed = packing.pack(pieces.drop("ids"), ["doc_id", "piece", "ids_crc32"])
    return placed.join(pieces.select("row", "ids").hint("merge"), "row").drop("row")


STAGES = [
    ("language", keep_identified),
    ("toxicity", drop_toxic),
    ("near duplicates", keep_one_of_each_class),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written below the shared folder and read again.

    What a stage has returned is deleted once the next one's result is written.
    """
    docs = table(prepare(spark), sf_dir, "documents")
    mine: list[tuple[SparkSession, str]] = []
    for name, function in STAGES[:-1]:
        out = function(spark, docs, sf_dir)
        before = stored()
        docs = store(out, f"pipeline-{name.replace(' ', '-')}")
        release(mine)
        mine = [t for t in stored() if t not in before]
    return STAGES[-1][1](spark, docs, sf_dir)
