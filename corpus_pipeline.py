"""A training corpus from raw documents, in stages that each read what the one before has written.

Each stage takes the session, the documents so far and the folder of the tables, and returns documents;
the last returns them with the ids of their pieces, in columns `ids`, `round_trip` and `n_tokens`, which replace columns
of these names. Rows with null ids go through all stages; rows that repeat an id and its text go or stay
together. An empty table gives an empty one. Columns that begin with two underscores are reserved.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import decontaminate, language_id, line_dedup, minhash, pieces
from roadpulse.llm.tables import release
from roadpulse.session import fresh_dir


def identify_language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the labelled ones; those without letters, and null texts, go.

    A document without a language gets the one that it is in. Where no document has one, nothing can be
    learned, and all stay.
    """
    profiles = language_id.learn(docs)
    if not profiles:
        return docs
    names = ("__lang", "__score")
    judged = language_id.predict(docs, profiles, names=names).filter(F.col(names[0]) != language_id.NONE)
    return judged.withColumn("lang", F.coalesce("lang", names[0])).select(*docs.columns)


def remove_repeated_lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that near-equal ones came before; those of which nothing is left go."""
    cut = line_dedup.remove_lines(docs, drop_emptied=True)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def remove_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of alike five-word shingles."""
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    gone = minhash.near_duplicates(hashed).filter("doc_id is not null and not kept").select("doc_id", "text_hash")
    return docs.join(gone, (docs["doc_id"] == gone["doc_id"]) & (F.xxhash64(docs["text"]) == gone["text_hash"]), "left_anti")


def remove_benchmark_passages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in 20 is in a window of the benchmark."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their pieces, and whether these give the text back."""
    coded = pieces.encode_and_check(docs, pieces.read_model(spark))
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark_passages),
    ("sentencepiece", encode_pieces),
]
#: Near-equal lines, components and pieces cannot be written in SQL.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        place = fresh_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
