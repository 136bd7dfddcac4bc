"""Quality by perplexity: an interpolated modified Kneser-Ney model of character 4-grams.

The model is a set of count tables keyed by language and n-gram, trained on all
trusted text. Symbols are UTF-16 code units (white space as a blank, digits as
0), so four of them pack exactly into a long. Documents are dealt into blocks;
a block counts its n-grams in trusted text and asks for the log-probabilities of
all its distinct n-grams, the joins with the count tables run once for each
n-gram of the corpus, and the answers go back to the blocks, where whole texts
are scored. Texts move compressed, and only to their blocks: the marks of trusted
rows come to them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, partitions, text_hash

ORDER = 4
BEGIN, END, OTHER = 0, 1, 0xFFFD
#: Symbols that the base distribution spreads over.
ALPHABET = 1 << 16
#: How texts are compressed on their way to the blocks.
CODEC = "zstd"
#: Text bytes of a block, about.
BLOCK_BYTES = 48 << 20
#: A document is rejected if its perplexity is over the language's quantile of trusted text times the margin,
#: times exp(SHORT / sqrt(n)) for n symbols: few symbols vary more.
QUANTILE = 0.99
MARGIN = 1.4
SHORT = 3.0


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """4-grams of all texts as longs, the text each belongs to, and their number by text."""
    parts, sizes = [], []
    begin, end = np.full(ORDER - 1, BEGIN, dtype=np.uint16), np.array([END], dtype=np.uint16)
    for t in texts:
        units = np.frombuffer(t.encode("utf-16-le", "surrogatepass"), dtype="<u2")
        parts += (begin, units, end)
        sizes.append(len(units) + 1)
    u = np.concatenate(parts) if parts else np.zeros(0, np.uint16)
    sizes = np.array(sizes, dtype=np.int64)
    starts = np.cumsum(sizes + ORDER - 1) - (sizes + ORDER - 1)
    target = np.ones(len(u), dtype=bool)
    for k in range(ORDER - 1):
        target[starts + k] = False
    mark = np.zeros(len(u), dtype=bool)
    mark[starts + sizes + ORDER - 2] = True  # the end symbols
    text = ~mark & target
    u = np.where(text & (u < 2), OTHER, u)
    u = np.where(text & (u >= 9) & (u <= 13), 32, u)
    u = np.where(text & (u >= 48) & (u <= 57), 48, u).astype(np.uint64)
    at = np.flatnonzero(target)
    gram = np.zeros(len(at), dtype=np.uint64)
    for back in range(ORDER - 1, -1, -1):
        gram = (gram << np.uint64(16)) | u[at - back]
    return gram.view(np.int64), np.repeat(np.arange(len(sizes)), sizes), sizes


def _by_key(keys: list) -> dict:
    out: dict = {}
    for k, x in enumerate(keys):
        out.setdefault(x, []).append(k)
    return out


def _text_slices(keys: list, block: pa.Table, rows: int = 128) -> "Iterator[tuple[object, list[int], list[str]]]":
    """Rows of one key and their texts, few at a time."""
    codec = pa.Codec(CODEC)
    packed, sizes = block.column("packed").combine_chunks(), block.column("size").to_pylist()
    for key, rows_of in _by_key(keys).items():
        for at in range(0, len(rows_of), rows):
            mine = rows_of[at : at + rows]
            yield key, mine, [codec.decompress(packed[k].as_buffer(), sizes[k], asbytes=True).decode() if sizes[k] else "" for k in mine]


def _merge(held: dict[str, tuple[np.ndarray, np.ndarray]], lang: str, grams: np.ndarray, counts: np.ndarray) -> None:
    if lang in held:
        grams, counts = np.concatenate((held[lang][0], grams)), np.concatenate((held[lang][1], counts))
        grams, where = np.unique(grams, return_inverse=True)
        counts = np.bincount(where, weights=counts).astype(np.int64)
    held[lang] = grams, counts


def _gathered(block: pa.Table, trusted: set) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Distinct n-grams of a block's texts by language, and how often each is in a trusted text; holds no more than those."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def settle(lang: str) -> None:
        found = waiting.pop(lang, [])
        if found:
            grams, where = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
            _merge(held, lang, grams, np.bincount(where, weights=np.concatenate([c for _, c in found])).astype(np.int64))

    keys = [(lang, doc in trusted) for lang, doc in zip(block.column("lang").to_pylist(), block.column("doc_id").to_pylist())]
    for (lang, counts_it), _, part in _text_slices(keys, block):
        grams, counts = np.unique(symbols(part)[0], return_counts=True)
        waiting.setdefault(lang, []).append((grams, counts if counts_it else np.zeros_like(counts)))
        if len(waiting[lang]) >= 16:
            settle(lang)
    for lang in list(waiting):
        settle(lang)
    for lang, (grams, counts) in held.items():
        yield lang, grams, counts


def block_grams(dealt: DataFrame, marks: DataFrame) -> DataFrame:
    """``block, lang, gram, c`` of each block's distinct n-grams: ``c`` times in the texts of the ids that ``marks`` (``block, doc_id``) has."""

    def run(texts: pa.Table, ids: pa.Table) -> pa.Table:
        trusted = set(ids.column("doc_id").to_pylist())
        number = texts.column("block")[0].as_py() if texts.num_rows else 0
        out = [
            pa.table([np.full(len(grams), number, dtype=np.int32), pa.array([lang] * len(grams), pa.string()), grams, counts], ["block", "lang", "gram", "c"])
            for lang, grams, counts in (_gathered(texts, trusted) if texts.num_rows else ())
        ]
        empty = pa.schema([("block", pa.int32()), ("lang", pa.string()), ("gram", pa.int64()), ("c", pa.int64())]).empty_table()
        return pa.concat_tables([empty, *out])

    return dealt.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(run, "block int, lang string, gram bigint, c bigint")


def _suffix(gram: Column | str, length: int) -> Column:
    gram = F.col(gram) if isinstance(gram, str) else gram
    return gram.bitwiseAND(F.lit((1 << 16 * length) - 1))


def _context(gram: Column | str) -> Column:
    return F.shiftrightunsigned(gram, 16)


def lower_counts(upper: DataFrame, order: int) -> DataFrame:
    """Continuation counts of ``order``-grams from the types one order up; grams at a text's begin have no left side and keep their counts."""
    at_begin = F.shiftrightunsigned("g", 16 * (order - 1)) == BEGIN
    return (
        upper.select("lang", _suffix("gram", order).alias("g"), "c")
        .groupBy("lang", "g")
        .agg(F.sum("c").alias("s"), F.count("*").alias("k"))
        .select("lang", F.col("g").alias("gram"), (F.when(at_begin, F.col("s")).otherwise(F.col("k")) if order > 1 else F.col("k")).alias("c"))
    )


def discounts(counts: DataFrame) -> DataFrame:
    """``lang, d1, d2, d3`` of one order from its counts of counts; without enough of them the discounts are 0.5, 1 and 1.5."""
    n = [F.sum((F.col("c") == k).cast("double")) for k in range(1, 5)]
    rows = counts.groupBy("lang").agg(*[x.alias(f"n{k + 1}") for k, x in enumerate(n)])
    enough = " and ".join(f"n{k} > 0" for k in range(1, 5))

    def one(k: int) -> Column:
        value = F.expr(f"{k} - {k + 1} * n1 / (n1 + 2 * n2) * n{k + 1} / n{k}")
        return F.when(F.expr(enough), F.greatest(F.lit(0.05), F.least(value, F.lit(k - 0.05)))).otherwise(F.lit(0.5 * k)).alias(f"d{k}")

    return rows.select("lang", *[one(k) for k in (1, 2, 3)])


def _discounted(counts: DataFrame, discount: DataFrame) -> DataFrame:
    """``counts`` with what each n-gram's count loses (``taken``)."""
    taken = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    return counts.join(discount, "lang").select("lang", "gram", "c", taken.alias("taken"))


def train(grams: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Count and context tables of the orders 1 to 4 from ``lang, gram, c``: the 4-grams of all trusted text, in any number of rows.

    Counts are ``lang, gram, kept`` (less the discount); contexts are ``lang,
    context, total`` and the mass ``spare`` that interpolation hands to the
    order below. Discounts are a written table of one row a language: Spark
    broadcasts it by its size, or splits the large languages of the join.
    """
    counts = {ORDER: materialize(grams.groupBy("lang", "gram").agg(F.sum("c").alias("c")), "kn-counts")}
    for order in range(ORDER - 1, 0, -1):
        counts[order] = materialize(lower_counts(counts[order + 1], order), "kn-counts")
    out = []
    for order in range(1, ORDER + 1):
        rows = _discounted(counts[order], materialize(discounts(counts[order]), "kn-discounts"))
        context = rows.groupBy("lang", _context("gram").alias("context")).agg(F.sum("c").cast("double").alias("total"), F.sum("taken").alias("spare"))
        out.append((rows.select("lang", "gram", (F.col("c") - F.col("taken")).alias("kept")), materialize(context, "kn-contexts")))
    return out


def log_probabilities(grams: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``lang, gram, logp`` of distinct ``lang, gram``: joins with the count tables from the lowest order up.

    In a language without trusted text every symbol has the base probability.
    """
    rows = grams
    p = F.lit(1.0 / ALPHABET)
    for order, (counts, context) in enumerate(model, 1):
        counts = counts.select("lang", F.col("gram").alias(f"g{order}"), F.col("kept").alias(f"kept{order}"))
        context = context.select("lang", F.col("context").alias(f"h{order}"), F.col("total").alias(f"total{order}"), F.col("spare").alias(f"spare{order}"))
        own = F.col("gram") if order == ORDER else _suffix("gram", order)
        rows = rows.withColumn(f"g{order}", own).withColumn(f"h{order}", _context(own))
        rows = rows.join(counts, ["lang", f"g{order}"], "left").join(context, ["lang", f"h{order}"], "left")
        p = F.when(
            F.col(f"total{order}") > 0,
            (F.coalesce(f"kept{order}", F.lit(0.0)) + F.col(f"spare{order}") * p) / F.col(f"total{order}"),
        ).otherwise(p)
        rows = rows.select("lang", "gram", p.alias(f"p{order}"))
        p = F.col(f"p{order}")
    return rows.select("lang", "gram", F.log(p).alias("logp"))


def _language(docs: DataFrame) -> Column:
    return F.coalesce(F.col("lang"), F.lit("")) if "lang" in docs.columns else F.lit("")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``t_id``: ids labelled good and not toxic, by every label of the id."""
    return (
        labels.groupBy(F.col("doc_id").cast("bigint").alias("t_id"))
        .agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
        .where("t_id is not null and q = 1 and coalesce(t, 0) = 0")
        .select("t_id")
    )


def prepared(docs: DataFrame) -> DataFrame:
    """``doc_id, body_hash, lang, text`` of every row."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_hash("text").alias("body_hash"),
        _language(docs).alias("lang"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def only_trusted(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """The rows whose ``doc_id`` is in ``trusted``: a join without a hint, so ids are broadcast only if they are few, and a large id is split."""
    return rows.join(trusted, F.col("doc_id") == F.col("t_id")).drop("t_id")


def block_of(blocks: int) -> Column:
    """Block of a row of :func:`prepared`, by its id and text."""
    return F.pmod(F.xxhash64("doc_id", "body_hash"), F.lit(blocks)).cast("int").alias("block")


def dealt_rows(rows: DataFrame, blocks: int) -> DataFrame:
    """``doc_id, body_hash, lang, block, size, packed`` of every row of :func:`prepared`, each block in a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(CODEC)
        for batch in batches:
            packed = [codec.compress(x.as_buffer(), asbytes=True) if x.as_buffer().size else b"" for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(packed, pa.binary())], [*batch.schema.names[:-1], "packed"])

    sized = rows.select("doc_id", "body_hash", "lang", block_of(blocks), F.octet_length("text").cast("bigint").alias("size"), "text")
    packed = sized.mapInArrow(run, "doc_id bigint, body_hash bigint, lang string, block int, size bigint, packed binary")
    return packed.repartitionById(blocks, "block")


def scored(dealt: DataFrame, asked: DataFrame, model: list[tuple[DataFrame, DataFrame]], blocks: int) -> DataFrame:
    """``doc_id, body_hash, lang, n, perplexity`` of every row of :func:`dealt_rows`; ``asked`` has ``block, lang, gram`` of its n-grams."""
    spark = dealt.sparkSession
    asked = asked.select("block", "lang", "gram").repartition(partitions(spark), "lang", "gram")
    known = log_probabilities(asked.select("lang", "gram").distinct(), model)
    answers = asked.join(known, ["lang", "gram"]).select("block", "lang", "gram", "logp").repartitionById(blocks, "block")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = {}
        lookup = right.sort_by([("lang", "ascending"), ("gram", "ascending")]).combine_chunks()
        names = np.array(lookup.column("lang").to_pylist(), dtype=object)
        grams, logp = lookup.column("gram").to_numpy(), lookup.column("logp").to_numpy()
        starts = np.flatnonzero(np.append(True, names[1:] != names[:-1])) if len(names) else []
        for s, e in zip(starts, [*starts[1:], len(names)]):
            tables[names[s]] = grams[s:e], logp[s:e]
        lengths, sums = np.zeros(left.num_rows, dtype=np.int64), np.zeros(left.num_rows)
        for lang, mine, part in _text_slices(left.column("lang").to_pylist(), left):
            found, owner, size = symbols(part)
            keys, values = tables[lang]
            sums[mine] = np.bincount(owner, weights=values[np.searchsorted(keys, found)], minlength=len(mine))
            lengths[mine] = size
        return pa.table(
            {c: left.column(c) for c in ("doc_id", "body_hash", "lang")} | {"n": pa.array(lengths), "perplexity": pa.array(np.exp(-sums / lengths))}
        )

    both = dealt.groupBy("block").cogroup(answers.groupBy("block"))
    return both.applyInArrow(score, "doc_id bigint, body_hash bigint, lang string, n bigint, perplexity double")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Perplexity and verdict of every row: ``doc_id, body_hash, lang, n, perplexity, threshold, kept``.

    All text of trusted documents trains the model; a document's threshold is
    its language's ``quantile`` of trusted perplexities times ``margin``, and
    wider for short texts. A null or empty
    text is scored by its end alone; a null language is a language of its own;
    a language without trusted text has no threshold and its documents are
    kept; repeated rows and equal texts of a language score alike; a null
    ``doc_id`` is never labelled; other columns are ignored; without any labels
    all rows are kept; an empty table gives an empty result.
    """
    spark, rows = docs.sparkSession, prepared(docs)
    trusted = materialize(trusted_ids(labels), "kn-trusted")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(spark.sparkContext.defaultParallelism, math.ceil(size / block_bytes))
    dealt = dealt_rows(rows, blocks)
    marks = only_trusted(rows.select("doc_id", block_of(blocks)), trusted).distinct().repartitionById(blocks, "block")
    asked = materialize(block_grams(dealt, marks), "kn-asked")
    model = train(asked.where("c > 0").select("lang", "gram", "c"))
    found = materialize(scored(dealt, asked, model, blocks), "kn-scored")
    limits = only_trusted(found, trusted).groupBy("lang").agg((F.percentile_approx("perplexity", quantile, 10_000) * margin).alias("threshold"))
    limits = materialize(limits, "kn-limits")  # a row a language; apart from the aggregate, so that large languages can be split
    limit = (F.col("threshold") * F.exp(SHORT / F.sqrt("n"))).alias("threshold")
    rows = found.join(limits, "lang", "left").select("doc_id", "body_hash", "lang", "n", "perplexity", limit)
    return rows.withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))


def drop_rejected(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``verdicts`` (``doc_id, body_hash, kept``) doesn't reject, with all columns as they were."""
    gone = verdicts.where("not kept").select(F.col("doc_id").alias("__id"), F.col("body_hash").alias("__hash")).distinct()
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    on = F.col("__row.doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (text_hash("__row.text") == F.col("__hash"))
    return left.join(gone, on, "left_anti").select("__row.*")
