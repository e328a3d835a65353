"""Class names from text, as a Column and for paths on the driver."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.taxonomy import CLASS_RULES, LABEL_ALIASES, TRAFFIC, WHOLE_START_WORDS, Taxonomy


def _word_start(word: str) -> str:
    return f"(^|[^a-z]){word}"


def canonical_class(text: Column, rules=CLASS_RULES, legacy: bool = False) -> Column:
    """First class whose words occur in the lower-case text, else NULL.

    ``legacy`` matches plain substrings throughout, so "abnormal" counts as "normal".
    """
    low = F.lower(text.cast("string"))

    def holds(word: str) -> Column:
        if word in WHOLE_START_WORDS and not legacy:
            return low.rlike(_word_start(word))
        return low.contains(word)

    result = None
    for name, groups in rules:
        test = F.lit(False)
        for words in groups:
            every = F.lit(True)
            for word in words:
                every = every & holds(word)
            test = test | every
        result = F.when(test, name) if result is None else result.when(test, name)
    return result


def class_of_path(path: str, rules=CLASS_RULES, legacy: bool = False) -> str | None:
    """The same rules for a file path on the driver."""
    low = path.lower()

    def holds(word: str) -> bool:
        if word in WHOLE_START_WORDS and not legacy:
            return re.search(_word_start(word), low) is not None
        return word in low

    for name, groups in rules:
        if any(all(holds(w) for w in words) for words in groups):
            return name
    return None


def squeeze(name: str) -> str:
    """Lower-case a column name and remove blanks, underscores and hyphens."""
    return name.lower().replace(" ", "").replace("_", "").replace("-", "")


def normalize_labels(df: DataFrame, taxonomy: Taxonomy = TRAFFIC, rules=CLASS_RULES,
                     legacy: bool = False) -> DataFrame:
    """Add ``attack_type`` and ``Label`` from whatever label column the table has.

    Known text becomes a canonical class; other text is kept as it is and counts as an
    attack. A missing label stays NULL in both columns (``legacy`` makes it the text
    ``nan``, an attack).
    """
    if "attack_type" in df.columns and "Label" in df.columns:
        return df
    source = next((c for c in df.columns if squeeze(c) in LABEL_ALIASES), None)
    if source is None:
        raise ValueError("no label column: expected one of " + ", ".join(LABEL_ALIASES))
    text = F.col(f"`{source}`").cast("string")
    if legacy:
        text = F.coalesce(text, F.lit("nan"))
    named = F.coalesce(canonical_class(text, rules, legacy), text)
    out = df.withColumn("_class", named)
    if source == "Label" or source == "attack_type":
        out = out.drop(source)
    return (out.withColumn("attack_type", F.col("_class"))
               .withColumn("Label", (F.col("_class") != taxonomy.benign).cast("int"))
               .drop("_class"))
