"""From raw documents to token files: language, near duplicates, benchmarks, mixture, tokens.

Every stage takes all rows its predecessor kept, written as Parquet, and all but the last return the
columns of ``documents``, others that come along included, whatever their names. Rows with a null doc_id pass
the stages that decide by id; rows that share an id are one document to them, and of equal ones one stays.
The mixture gives a document as many rows as epochs take it, so a doc_id may repeat from there on. Null and
empty texts go at the language stage; texts are used whole however long. Empty tables pass as empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm.components import stored
from flowlake.llm.decontam import decontaminate
from flowlake.llm.jaccard import jaccard_classes
from flowlake.llm.langid import fit_languages, known_language
from flowlake.llm.mixing import mix_sources, word_count
from flowlake.llm.queries import domain_column, table, tokenizer_path
from flowlake.llm.token_files import read_token_files, write_token_files
from flowlake.session import scratch_path

#: A node's weight is its supply of tokens times its name's factor, by level of the tree; other names count 1. The
#: factors' product, at most 1.32, stays under SHARE: no leaf gets less than its supply, whatever the sources' shares.
FACTORS = [{"reference": 1.2}, {"de": 1.1, "fr": 1.1, "es": 1.1}, {}]
#: A third more tokens than the corpus has and no text more than twice.
SHARE, EPOCHS = 1.35, 2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters and texts that no learned language explains."""
    return known_language(docs, fit_languages(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of every group of texts linked by 0.8 or more on five words, its rows of equal text once."""
    classes = jaccard_classes(docs, shingle=5, percent=80)
    dropped = stored(classes.where("component_id != doc_id").select("doc_id").distinct(), "dropped")
    return without_repeats(docs.join(dropped, "doc_id", "left_anti").select(*docs.columns))


def without_repeats(docs: DataFrame) -> DataFrame:
    """One of the rows that agree in doc_id and text; only such rows move. Rows with a null doc_id stay."""
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    counts = keyed.where("id is not null").groupBy("id", "hash").count()
    again = stored(counts.where("count > 1").select("id", "hash"), "repeated")
    if again.isEmpty():
        return docs
    first = keyed.join(again, ["id", "hash"], "left_semi").groupBy("id", "hash").agg(F.min_by("row", F.to_json("row")).alias("row"))
    rest = keyed.join(again, ["id", "hash"], "left_anti").select("row")
    return rest.union(first.select("row")).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts that hold a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def supply_weights(docs: DataFrame, levels: list[Column]) -> DataFrame:
    """(node, weight) of every node of the tree that has tokens: supply times factor."""
    names = [f"l{k}" for k in range(len(levels))]
    leaf_names = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(names, levels)]
    leaves = docs.select(*leaf_names, word_count("text").alias("tokens")).groupBy(*names).agg(F.sum("tokens").cast("double").alias("supply"))
    leaves, nodes = stored(leaves, "mix-supply"), None
    for k, factors in enumerate(FACTORS):
        factor = F.lit(1.0)
        for name, value in factors.items():
            factor = F.when(F.col(names[k]) == name, value).otherwise(factor)
        level = leaves.groupBy(*names[: k + 1]).agg(F.sum("supply").alias("supply"))
        level = level.select(F.array(*names[: k + 1]).alias("node"), (F.col("supply") * factor).alias("weight"))
        nodes = level if nodes is None else nodes.union(level)
    return stored(nodes, "mix-weights")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat texts towards the weights; the last text of a leaf's prefix is taken whole."""
    levels = [domain_column(), F.col("lang"), F.col("source")]
    packed = docs.select(F.struct("*").alias("row"), "doc_id", "text", "lang", "source")
    mixed = mix_sources(packed, levels, supply_weights(docs, levels), SHARE, EPOCHS)
    copies = F.col("mix_copies") + (F.col("mix_prefix") > 0).cast("long")
    taken = mixed.select("row", copies.alias("copies")).where("copies > 0")
    taken = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token files and read back one row per document row."""
    path = scratch_path(spark, "pipeline-tokens")
    write_token_files(docs, path, tokenizer_path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("language id", language),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmarks),
    ("mixing sources", mixture),
    ("token files", tokens),
]

#: SQL expresses neither the language models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
