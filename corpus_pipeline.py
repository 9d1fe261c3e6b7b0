"""The corpus pipeline: five stages from raw documents to token ids, each by one operator of the training-data subpackage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spotshare.llm import bpe, quality, simhash, suffixes, templates
from spotshare.llm.common import table
from spotshare.llm.queries import VOCABULARY
from spotshare.plans.staging import join_side, write_stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _packed(docs: DataFrame) -> DataFrame:
    """``text``, and the other columns in the struct ``row``, so that none of theirs clashes with those of an operator."""
    return docs.select("text", F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row"))


def _unpacked(packed: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    return packed.select(*(changed.get(c, F.col("text") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in columns))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows that the quality classifier scores at one half or more, empty and NULL texts too if so scored.

    The word vectors come from ``docs``, the labels of ``sf_dir`` train the network. All columns stay.
    """
    labels = quality.training_labels(table(spark, sf_dir, "labels"), "quality", 3, 1)
    vectors, net = quality.train(docs, labels)
    return _unpacked(quality.score(_packed(docs), vectors, net).where("quality_score >= 0.5"), docs.columns)


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps exactly one row of each group of near duplicates, whatever its ids: the first by doc_id (NULL last), by the MD5 of its
    text, then by its other columns. All texts without words, empty and NULL ones too, are one group.

    Rows are documents: rows that share an id, NULL too, but no group each stay, and of equal rows one stays.
    """
    own = write_stage(simhash.copy_prints(_packed(docs)), "prints")
    groups = simhash.copy_groups(own).toDF("__node", "__root")
    # maps and variants have no order
    kinds = [c for c, kind in docs.dtypes if c not in ("doc_id", "text") and "map<" not in kind and "variant" not in kind]
    ordered = [F.col(f"row.`{c}`").alias(f"by{i}") for i, c in enumerate(kinds)]
    doc_id = F.col("row.doc_id")
    first = F.min(F.struct(doc_id.isNull(), doc_id, F.md5(F.col("text").cast("string")), *ordered, "__row")).alias("first")
    firsts = own.groupBy("__node").agg(first).join(groups, "__node", "left")
    firsts = firsts.groupBy(F.coalesce("__root", "__node")).agg(F.min("first").alias("first")).select("first.__row")
    return _unpacked(own.join(join_side(firsts), "__row", "left_semi"), docs.columns)


def _whole_characters(content: Column, spans: Column) -> Column:
    """The UTF-8 ``content`` without the spans (start, end), each widened to the borders of the characters it cuts."""
    def inside(at: Column) -> Column:
        byte = F.hex(F.substring(content, at + 1, F.lit(1)))
        return (byte >= "80") & (byte < "C0")

    def to_border(at: Column, step: int) -> Column:
        steps = F.lit(3)
        for k in (2, 1, 0):
            steps = F.when(inside(at + step * k), steps).otherwise(F.lit(k))
        return at + step * steps

    ends = F.concat(F.transform(spans, lambda s: to_border(s[0], -1)), F.array(F.octet_length(content)))
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: to_border(s[1], 1)))
    return F.array_join(F.zip_with(starts, ends, lambda a, b: F.substring(content, a + 1, F.greatest(b - a, F.lit(0))).cast("string")), "")


def repeat_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every byte run that a string of 200 bytes covers which also stands elsewhere; all rows stay, n_chars follows.

    Bytes of a character that was cut in two go with it. NULL texts stay NULL.
    """
    # the spans are joined from a measured side; only beyond its bound the texts are exchanged for them
    own = _packed(docs).withColumn("digest", suffixes.digest_of(suffixes.content_of()))
    done = own.join(join_side(suffixes.repeat_spans(docs.select("text"))), "digest", "left")
    changed = F.col("spans").isNotNull()
    left = _whole_characters(F.col("text").cast("binary"), F.col("spans"))
    done = done.withColumn("text", F.when(changed, left).otherwise(F.col("text")))
    length = F.when(changed, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
    return _unpacked(done, docs.columns, n_chars=length)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows that hold no passage of the benchmark; NULL and empty texts hold none."""
    return templates.clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every row, with their number and whether they decode to the text's bytes; NULL and empty texts have none."""
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    coded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), path, pattern)
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [
    ("quality classifier", quality_filter),
    ("simhash near-dedup", near_duplicate_filter),
    ("suffix-array dedup", repeat_filter),
    ("benchmark decontamination", benchmark_filter),
    ("byte-level bpe", tokenize),
]

# A trained network, graph components and merges by rank are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each one's result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
