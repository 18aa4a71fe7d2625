"""From raw documents to packed training sequences: five stages, each one operator applied to all that is left.

1. Language ID: documents without a language (`und`: null, or no letter) go.
2. SimHash near-dedup: one document of each group stays, the one with the smallest id.
3. Substring dedup: words of passages that a smaller id has go; a document that loses all its words goes. A text that
   loses nothing stays as it is.
4. Benchmark decontamination: contaminated documents go.
5. Packing: the pieces of what is left in sequences of 2048 tokens.

Null texts go in the first stage. Other columns of `documents` are passed on, whatever their names; n_chars follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.llm import contamination, language, packing, simhash, substring
from plaudit.llm.registry import contaminated, table, tokenizer
from plaudit.llm.rows import fold, stored, unpacked


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    profiles = language.fitted(docs.filter(~fold("doc_id", 3).eqNullSafe(1)))
    rows = language.identified(docs, profiles, carry=docs.columns)
    return unpacked(rows.filter(F.col("lang_pred") != language.UNKNOWN)).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = substring.without_repeats(docs, carry=docs.columns)
    rows = rows.filter("n_removed = 0 or n_removed < n_words")
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("doc.text")),
           "n_chars": F.when(changed, F.char_length("kept_text")).otherwise(F.col("doc.n_chars"))}
    return rows.select(*[new.get(f.name, F.col("doc").getField(f.name)).cast(f.dataType).alias(f.name)
                         for f in docs.schema])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = contamination.searched(docs, table(spark, sf_dir, "benchmark"), carry=docs.columns)
    return unpacked(rows.filter(~contaminated())).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.sequences(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("language ID", language_id), ("SimHash near-dedup", near_dedup), ("substring dedup", substring_dedup),
          ("benchmark decontamination", decontamination), ("packing", pack)]

#: SQL can express neither the language profiles nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
