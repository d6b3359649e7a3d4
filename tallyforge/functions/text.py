"""Texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What a mention looks like, and what is stripped with it.
MENTION = r"(@[\p{L}\p{N}_]+)"
STRIPPED_MENTION = r"@\S+"

# The sentiment words.
POSITIVE_WORDS = ("good", "great", "excellent", "amazing", "love", "best")
NEGATIVE_WORDS = ("bad", "terrible", "awful", "hate", "worst", "horrible")


def mentions(text: str) -> Column:
    """All @mentions in order; an empty array for NULL."""
    return F.coalesce(
        F.regexp_extract_all(text, F.lit(MENTION), F.lit(1)), F.array().cast("array<string>")
    )


def without_mentions(text: str) -> Column:
    return F.regexp_replace(text, STRIPPED_MENTION, "")


def _hits(text: Column, lexicon: tuple[str, ...]) -> Column:
    return sum((F.contains(text, F.lit(word)).cast("int") for word in lexicon), F.lit(0))


def text_features(text: str) -> Column:
    """struct(sentiment_score, entity_count, complexity_score).

    Sentiment: lexicon words found anywhere in the text, each counted once,
    positive minus negative, per word. Entities: words with a capital first
    letter. Complexity: mean word length / 10. Zeros for a missing or empty text.
    """
    present = F.coalesce(F.col(text), F.lit(""))
    lowered = F.lower(present)
    number = F.greatest(F.regexp_count(present, F.lit(r"\S+")), F.lit(1))
    letters = F.length(F.regexp_replace(present, r"\s+", ""))
    score = _hits(lowered, POSITIVE_WORDS) - _hits(lowered, NEGATIVE_WORDS)
    return F.struct(
        (score / number).alias("sentiment_score"),
        F.regexp_count(present, F.lit(r"(?<!\S)\p{Lu}")).alias("entity_count"),
        (letters / number / 10).alias("complexity_score"),
    )
