"""Operators as pipeline stages: documents in, documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import langid, mixing, packing, quality, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(docs: DataFrame) -> DataFrame:
    """Documents whose language is told apart with enough confidence; lang becomes the predicted one.

    Learns from a sample of the labelled rows of the input. Null texts and texts
    without a letter go; equal rows answer alike; other columns are kept as they
    are. Documents of which none has a label are an error, since nothing could
    be told of them; an empty table gives no rows.
    """
    model = langid.train(docs.select("doc_id", "text", "lang"), F.lit(True))
    if model is None and not docs.isEmpty():
        raise ValueError("no document has both a text and a language to learn from")
    kept = langid.identify(docs, model).filter(~F.col("language.rejected"))
    return kept.select(*[F.col("language.lang_pred").alias(c) if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns])


def apply_quality(docs: DataFrame) -> DataFrame:
    """Documents that pass the quality rules, without the lines that fail."""
    return quality.keep(docs)


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return simhash.distinct_documents(docs)


def mix_to_targets(docs: DataFrame) -> DataFrame:
    """Each source's documents up to its target, repeated where the target is above the source, in schedule order.

    Documents are taken whole, so that texts stay as they are.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(docs: DataFrame) -> DataFrame:
    """Pieces of fixed-length sequences, with their ids."""
    return packing.pack(docs.select("doc_id", "text", "source"))
