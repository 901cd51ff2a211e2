"""Language identification: text likelihoods joined with declared language, address suffix and host priors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressroom.llm.common import give_back, map_batches, salted_join, save
from pressroom.llm.textkit import folded, pieces_of

BINS = 1 << 16
#: Labelled texts of each language that a fit reads, and languages whose counts a task holds before it sends them on.
PER_LANGUAGE = 1_000
#: One in so many rows has to declare a language for a model of it.
RAREST = 1_000
HELD = 32
#: Trigrams overlap, so that so many count as one independent observation.
OVERLAP = 3.0
#: Pseudo-counts: of evidence given a language, and of a parent in its child's prior.
SMOOTH, PRIOR = 1.0, 4.0
CONFIDENCE = 0.5
_LETTER = np.array([c >= 128 or chr(c).isalpha() for c in range(256)])


def trigrams(text: str | None) -> np.ndarray:
    """Bins of the whole text's byte trigrams around a letter, in lower case; other characters are one space."""
    parts = []
    for piece in pieces_of(folded(text or "")):
        data = np.frombuffer(piece, np.uint8)
        data = np.where(_LETTER[data], data, np.uint8(32))
        keep = np.ones(len(data), bool)
        keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
        data = np.concatenate(([32], data[keep], [32])).astype(np.uint32)
        code = (data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]) * np.uint32(2654435761)
        parts.append((code >> np.uint32(16))[data[1:-1] != 32])
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


@dataclass
class TextModel:
    languages: list[str]
    logp: np.ndarray  # (BINS, languages)
    floor: np.ndarray  # least mean log-likelihood of a text that is in the language

    def means(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean log-likelihood per trigram and language, and the number of trigrams, of each text."""
        out, counts = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            bins = trigrams(text)
            counts[i] = len(bins)
            for k in range(0, len(bins), 1 << 20):
                out[i] += self.logp[bins[k : k + (1 << 20)]].sum(axis=0, dtype=np.float64)
        return out / np.maximum(counts, 1)[:, None], counts


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> TextModel:
    """Trigram models of the declared languages, each from about ``per_language`` texts.

    A language needs one in ``RAREST`` of the rows that declare one, so there are at most as many;
    ``identify`` keeps the others' documents as of unknown language. The texts are those whose hash of
    the id is below the share that gives so many. Trigrams are counted in a grouped aggregation.
    Rows without a language or an id are passed over; without any, the model knows no language.
    """
    declared = docs.filter(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = declared.groupBy(F.col(lang_col).cast("string").alias("_lang")).agg(F.count(F.lit(1)).alias("_n"))
    counts = save(counts, "languages")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    common = counts.filter(F.col("_n") * RAREST >= total)
    languages = sorted(r["_lang"] for r in common.collect())
    if not languages:
        return TextModel([], np.zeros((BINS, 0), np.float32), np.zeros(0))
    # At most RAREST rows are sent to all tasks.
    shares = F.broadcast(common.select("_lang", (F.lit(float(per_language)) / F.col("_n")).alias("_share")))
    rows = declared.select(
        F.col(lang_col).cast("string").alias("_lang"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        (F.shiftrightunsigned(F.xxhash64(id_col), 11) / F.lit(float(2**53))).alias("_draw"),
    )
    sample = rows.join(shares, "_lang").filter("_draw < _share").select("_lang", "_text")

    def sent(total: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, seen in total.items():
            at = np.flatnonzero(seen)
            names = ["lang", "bin", "n"]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(seen[at])], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = np.bincount(trigrams(text), minlength=BINS) if text else 0
                total[lang] = total.get(lang, np.zeros(BINS, np.int64)) + seen
                if len(total) > HELD:
                    yield from sent(total)
                    total = {}
        yield from sent(total)

    counted = map_batches(sample, count, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    place = {lang: i for i, lang in enumerate(languages)}
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in languages]
    for batch in counted.toArrow().to_batches():
        column = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
        bins, seen = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for i in np.unique(column):
            found[i].append((bins[column == i], seen[column == i]))
    logp = np.empty((BINS, len(languages)), np.float32)
    floor = np.empty(len(languages))
    for i, parts in enumerate(found):
        counts = np.full(BINS, 0.1)
        for bins, seen in parts:
            counts[bins] += seen
        share = counts / counts.sum()
        logp[:, i] = np.log(share)
        # A text is foreign if its trigrams are rarer than halfway (in logarithms) from usual to unseen ones.
        floor[i] = ((share * np.log(share)).sum() + logp[:, i].min()) / 2
    return TextModel(languages, logp, floor)


def text_evidence(model: TextModel, text: Column) -> Column:
    """``struct(means array<double>, n long)`` of each whole text."""

    @F.arrow_udf("struct<means:array<double>,n:long>")
    def evidence(texts: pa.Array) -> pa.Array:
        give_back()
        means, counts = model.means(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(list(means), pa.list_(pa.float64())), pa.array(counts)], ["means", "n"])

    return evidence(F.coalesce(text, F.lit("")))


def page_evidence(url: Column, html: Column) -> dict[str, Column]:
    """Declared language, address suffix, host and domain of a page; null where it has none."""
    blank = lambda c: F.nullif(F.lower(c), F.lit(""))
    host = blank(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#:]*)", 1))
    labels = F.split(host, r"\.")
    return {
        "declared": blank(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<html[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1)),
        "suffix": F.when(F.size(labels) > 1, F.element_at(labels, -1)),
        "domain": F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")),
        "host": host,
    }


def _tally(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``(key, name)``: the languages of rows that have the key, and how many of each; nulls stay out."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key, "_best").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(F.collect_list(F.struct("_best", "n")).alias(name))


def fuse(rows: DataFrame, model: TextModel, by: str = "id") -> DataFrame:
    """``rows`` with ``lang``, ``confidence``, ``text_lang`` and ``kept`` from all evidence.

    ``rows`` has ``text`` (see ``text_evidence``), ``declared``, ``suffix``, ``domain`` and ``host``,
    each of which may be null and then says nothing. What text alone says is counted by each kind
    of evidence in grouped aggregations: declared languages and suffixes become likelihoods given
    the language; hosts become priors smoothed by their domain's, which are smoothed by the whole
    table's, without the row's own vote. ``kept`` is false for texts without letters, for those
    whose trigrams no known language has, and where no language reaches ``CONFIDENCE``.
    """
    size = len(model.languages)
    if not size:
        return rows.withColumns({
            "text_lang": F.lit(None).cast("string"), "lang": F.lit(None).cast("string"),
            "confidence": F.lit(0.0), "kept": F.lit(False),
        })
    names = F.array(*map(F.lit, model.languages))
    means, n = F.col("text.means"), F.col("text.n")
    own = F.when(n > 0, F.array_position(means, F.array_max(means)).cast("int") - 1)
    rows = rows.withColumn("_best", own)
    best = F.col("_best")
    voted = rows.filter(best.isNotNull()).select("_best", "declared", "suffix", "domain", "host")
    whole = [0.0] * size
    for r in voted.groupBy("_best").count().collect():  # a row per language
        whole[r["_best"]] = float(r["count"])
    total = sum(whole)
    base = [(x + 1) / (total + size) for x in whole]
    hosts = _tally(voted, "host", "_host").join(
        voted.filter("host is not null").groupBy("host").agg(F.max("domain").alias("domain")), "host"
    )
    domains = _tally(voted, "domain", "_domain")
    hosts = salted_join(hosts, domains, ["domain"], by="host").drop("domain")
    out = salted_join(rows, hosts, ["host"], by=by)
    kinds = {}
    for key in ("declared", "suffix"):
        counts = _tally(voted, key, f"_{key}")
        kinds[key] = max(1, counts.count())
        out = salted_join(out, counts, [key], by=by)
    totals, base, floors = np.array(whole), np.array(base), np.asarray(model.floor)

    def dense(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Counts by row and language, and which rows have any."""
        there = column.is_valid().to_numpy(zero_copy_only=False)
        lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        entries, counts = column.flatten(), np.zeros((len(column), size))
        at = entries.field("_best").to_numpy(zero_copy_only=False)
        counts[np.repeat(np.arange(len(column)), lengths), at] = entries.field("n").to_numpy(zero_copy_only=False)
        return counts, there[:, None]

    @F.arrow_udf("struct<at:int,confidence:double,known:boolean>")
    def weigh(
        means: pa.Array, n: pa.Array, best: pa.Array, domain: pa.Array, host: pa.Array, declared: pa.Array, suffix: pa.Array
    ) -> pa.Array:
        give_back()
        parts = []
        for k in range(0, len(n), 256):
            cut = lambda column: column.slice(k, 256)  # noqa: E731, B023
            mean = cut(means).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            own = cut(best).fill_null(-1).to_numpy(zero_copy_only=False)
            vote = (own[:, None] == np.arange(size)).astype(float)
            prior = np.broadcast_to(base, mean.shape)
            for column in (domain, host):
                counts, there = dense(cut(column))
                others = np.maximum(counts.sum(axis=1, keepdims=True) - (own >= 0)[:, None], 0)
                prior = np.where(there, (np.maximum(counts - vote, 0) + PRIOR * prior) / (others + PRIOR), prior)
            logits = mean * cut(n).to_numpy(zero_copy_only=False)[:, None] / OVERLAP + np.log(prior)
            for key, column in (("declared", declared), ("suffix", suffix)):
                counts, there = dense(cut(column))
                logits += np.where(there, np.log((counts + SMOOTH) / (totals + SMOOTH * kinds[key])), 0)
            at = logits.argmax(axis=1)
            spread = np.exp(logits - logits.max(axis=1, keepdims=True)).sum(axis=1)
            parts.append((at, 1 / spread, mean[np.arange(len(at)), at] >= floors[at]))
        at, confidence, known = map(np.concatenate, zip(*parts)) if parts else (np.empty(0), np.empty(0), np.empty(0))
        arrays = [pa.array(at, pa.int32()), pa.array(confidence, pa.float64()), pa.array(known.astype(bool))]
        return pa.StructArray.from_arrays(arrays, ["at", "confidence", "known"])

    out = out.withColumn("_weighed", weigh(means, n, "_best", "_domain", "_host", "_declared", "_suffix"))
    out = out.withColumns({
        "text_lang": F.element_at(names, best + 1),
        "lang": F.element_at(names, F.col("_weighed.at") + 1),
        "confidence": F.col("_weighed.confidence"),
        "kept": (n > 0) & F.col("_weighed.known") & (F.col("_weighed.confidence") >= CONFIDENCE),
    })
    return out.drop("_best", "_host", "_domain", "_declared", "_suffix", "_weighed")


def identify(
    docs: DataFrame, evidence: DataFrame | None = None, model: TextModel | None = None,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", row_col: str | None = None,
) -> DataFrame:
    """``(id, lang, confidence, text_lang, declared, host, kept)`` per row of ``docs``, and ``row_col`` where given.

    ``evidence(id, declared, suffix, domain, host)`` has one row per id at most. Null and empty
    texts and texts without letters are not kept; a null id or one without evidence has its text
    and the general prior alone. Repeated rows are judged each. No rows give no rows. The declared
    languages in ``lang_col`` serve to fit a model where none is given, and never as evidence; a text
    with letters whose declared language the model does not know is kept, with a null ``lang``.
    """
    if model is None:
        model = fit(docs, id_col, text_col, lang_col)
    row = [F.col(row_col).alias("_row")] if row_col else []
    stated = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    row.append((stated.isNotNull() & ~stated.isin(model.languages)).alias("_unknown"))
    rows = docs.select(F.col(id_col).alias("id"), text_evidence(model, F.col(text_col)).alias("text"), *row)
    columns = ["declared", "suffix", "domain", "host"]
    if evidence is None:
        rows = rows.select("*", *[F.lit(None).cast("string").alias(c) for c in columns])
    else:
        rows = rows.join(evidence.select(F.col(id_col).alias("id"), *columns), "id", "left")
    out = fuse(save(rows, "evidence"), model, by="_row" if row_col else "id")
    unknown = F.col("_unknown") & (F.col("text.n") > 0)
    out = out.withColumns({
        "lang": F.when(~unknown, F.col("lang")), "kept": F.col("kept") | unknown,
    })
    row = [F.col("_row").alias(row_col)] if row_col else []
    return out.select(F.col("id").alias(id_col), "lang", "confidence", "text_lang", "declared", "host", "kept", *row)
