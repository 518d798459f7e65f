"""The registered queries of this package, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuro.llm import (
    decontaminate,
    hyperminhash,
    imatch,
    jaccard_join,
    line_dedup,
    merkle,
    mixing,
    pseudonyms,
    style_tree,
    token_alignment,
    token_files,
    toxicity,
    url_filter,
)
from murmuro.runtime import recorded, remove_folders
from murmuro.sources.bind import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WEIGHTS, AMOUNT = [3, 1, 2], 1.5
END_ID = 2
# The key of the registered pseudonym query; a user brings a secret one.
KEY = "murmuro-registered-query"


def query(f):
    QUERIES[f.__name__] = f
    return f


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.scores(docs, toxicity.train(docs, table(spark, folder, "labels")))


@query
def op2_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonyms.pseudonymised(table(spark, folder, "documents"), KEY)


@query
def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    out = token_files.token_folder(spark)
    token_files.write_tokens(table(spark, folder, "documents"), out, tokenizer_path(), END_ID)
    return token_files.checksums(token_files.read_tokens(spark, out))


@query
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), WEIGHTS, AMOUNT)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    captures = pages.select("page_id", "url", url_filter.sample_fetch_time("page_id").alias("fetched"))
    return url_filter.judged(captures, url_filter.sample_list(pages))


SQL["op5_url_filter"] = url_filter.SQL


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.without_common_blocks(table(spark, folder, "documents"))


@query
def op7_imatch(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.fingerprints(table(spark, folder, "documents"))


@query
def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_links(table(spark, folder, "documents"))


@query
def op10_style_tree(spark: SparkSession, folder: str) -> DataFrame:
    return style_tree.main_text(table(spark, folder, "pages"))


@query
def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))


SQL["op11_merkle"] = merkle.SQL


@query
def op12_hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, folder, "documents"))


@query
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    files = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return token_alignment.alignment(table(spark, folder, "documents"), *files)


# Stages of the pipeline: (spark, documents, folder) to documents.

# Folders that the last stage of a session wrote on its way.
_WRITTEN: dict[str, list[str]] = {}


def forget_stage(spark: SparkSession, docs: DataFrame) -> None:
    """Remove what the last stage wrote on its way, but for tables that `docs` still reads."""
    app = spark.sparkContext.applicationId
    _WRITTEN[app] = remove_folders(spark, _WRITTEN.get(app, []), docs)


def stage(f):
    """A stage's result is lazy and reads tables the stage has written, so they go when the next stage begins.

    By then the result has been written and read back, which is how stages are chained. A result that is
    handed on as it is keeps its tables.
    """

    @wraps(f)
    def run(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        forget_stage(spark, docs)
        with recorded() as paths:
            out = f(spark, docs, folder)
        _WRITTEN.setdefault(spark.sparkContext.applicationId, []).extend(paths)
        return out

    return run


@stage
def keep_civil(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, folder, "labels")))


@stage
def keep_one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


@stage
def keep_uncontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, folder, "benchmark"))


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return mixing.mixed_documents(docs, WEIGHTS, AMOUNT)


@stage
def to_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    out = token_files.token_folder(spark)
    token_files.write_tokens(docs, out, tokenizer_path(), END_ID)
    rows = token_files.checksums(token_files.read_tokens(spark, out))
    return rows.withColumn("folder", F.lit(out))


STAGES = [
    ("toxicity", keep_civil),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_uncontaminated),
    ("mixing", mix_sources),
    ("token_output", to_tokens),
]
