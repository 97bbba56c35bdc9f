"""Term counts of free text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# The usual English stop words.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is
are was were be been being have has had having do does did doing would should could ought i'm you're
he's she's it's we're they're i've you've we've they've i'd you'd he'd she'd we'd they'd i'll you'll
he'll she'll we'll they'll isn't aren't wasn't weren't hasn't haven't hadn't doesn't don't didn't won't
wouldn't shan't shouldn't can't cannot couldn't mustn't let's that's who's what's here's there's when's
where's why's how's a an the and but if or because as until while of at by for with about against
between into through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some such no nor
not only own same so than too very
""".split()


def term_counts(
    df: DataFrame, text: str, stop_words: Sequence[str] = tuple(ENGLISH_STOP_WORDS), min_length: int = 1,
    language: str | None = None, stop_language: str = "en",
) -> DataFrame:
    """How often each word occurs: lower case, no punctuation, digits or stop words.

    With a ``language`` column the stop words are left out of rows in ``stop_language`` only; all rows are counted.
    """
    plain = F.regexp_replace(F.lower(text), r"[\p{Punct}0-9]", "")
    stopped = F.col(language).eqNullSafe(stop_language) if language else F.lit(True)
    words = df.select(F.explode(F.split(plain, r"\s+")).alias("term"), stopped.alias("stopped"))
    kept = words.where((F.length("term") >= min_length) & ~(F.col("stopped") & F.col("term").isin(*stop_words)))
    return kept.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
