"""A corpus made ready for training, stage by stage.

Each stage takes the documents that its predecessor left and the folder of the tables.
Between stages the documents are written to the shared folder and read again, so what a
lost executor held is read from there.

Defined results: a document without text or without a letter goes in the first stage. Rows with
a null id are documents of their own, whose copies are not looked for. Repeated rows of one id
are one document to the second stage. Further columns of the documents, whatever their
names, pass all stages as they are. An empty table stays one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.llm import decontaminate, jaccard_join, language, secret_scan, suffix_pieces
from tillmetrics.llm.memory import small_batches
from tillmetrics.llm.queries import tokenizer_file
from tillmetrics.llm.tables import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no learned language, go."""
    small_batches(spark)
    return docs.filter(language.accepted(language.fit(docs), F.col("text")))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents alike in four fifths of their 5-word shingles, one stays."""
    small_batches(spark)
    return jaccard_join.one_of_each_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go.

    Items of a few words are no passage: they are in many documents that leak nothing.
    """
    small_batches(spark)
    blocks = decontaminate.indexes(table(spark, sf_dir, "benchmark"), short_items=False)
    return docs.filter(F.size(decontaminate.leaks(blocks, F.col("text"))) == 0)


def redacted_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a placeholder; documents stay, with their new length."""
    model = secret_scan.fit(secret_scan.samples(docs))
    spans = secret_scan.scan(docs.select(F.struct(*docs.columns).alias("doc"), "text"), model)
    clean = spans.select(
        "doc", secret_scan.redacted(F.col("text"), F.concat("base", "added")).alias("clean")
    )
    columns = {"text": F.col("clean"), "n_chars": F.length("clean").cast("bigint")}
    return clean.select(*[columns.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its piece ids, and whether they decode to its text.

    Columns of the documents keep their names; ``ids`` and ``round_trip`` take a number behind
    theirs where the documents have such columns.
    """
    small_batches(spark)
    vocabulary = suffix_pieces.shared(spark, tokenizer_file("piece_bpe_32k.model"))
    row = F.struct(*docs.columns).alias("row")
    found = docs.select(row, suffix_pieces.round_trip(vocabulary, F.col("text")).alias("found"))
    taken = {c.lower() for c in docs.columns}

    def free(name: str) -> str:
        names = [name, *[f"{name}_{i}" for i in range(2, len(taken) + 3)]]
        return next(n for n in names if n not in taken)

    own = [F.col("row").getField(c).alias(c) for c in docs.columns]
    return found.select(*own, F.col("found.ids").alias(free("ids")), F.col("found.same").alias(free("round_trip")))


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", redacted_secrets),
    ("SentencePiece encoding and decoding", sentencepiece),
]

# The first, third and last stage learn or search in ways that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
