"""The queries of this package, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from . import conversations, decontaminate, fingerprints, jaccard, language, packing, privacy, quality, repeats, runs, secrets, simhash, wordpiece
from .texts import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(tune(spark), folder)
        if check:
            CHECKS[name] = check
        return build

    return register


@query("op1_order_minhash")
def _fingerprints(spark, folder):
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"))


@query("op2_quality_lines")
def _quality(spark, folder):
    return quality.classify_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_secret_ownership")
def _secrets(spark, folder):
    return secrets.scan_secrets(table(spark, folder, "documents"))


@query("op4_ngram_jaccard")
def _jaccard(spark, folder):
    return jaccard.near_groups(table(spark, folder, "documents"), width=4, percent=85)


@query("op5_decontamination")
def _passages(spark, folder):
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_repeated_strings")
def _repeats(spark, folder):
    return repeats.digest(repeats.remove_repeats(table(spark, folder, "documents"), first_stays=False))


@query("op7_token_counts")
def _tokens(spark, folder):
    return wordpiece.count_tokens(table(spark, folder, "documents"))


@query("op8_personal_data")
def _personal(spark, folder):
    return privacy.personal_data(table(spark, folder, "documents"))


@query("op9_language")
def _language(spark, folder):
    return language.identify_languages(table(spark, folder, "documents"))


@query("op10_packing")
def _packing(spark, folder):
    return packing.pack_documents(table(spark, folder, "documents"))


@query("op11_periodic_runs")
def _periodic(spark, folder):
    docs = runs.with_planted_runs(table(spark, folder, "documents"))
    return runs.digest(runs.periodic_runs(docs))


@query("op12_simhash")
def _simhash(spark, folder):
    return simhash.simhash_groups(table(spark, folder, "documents"))


@query("op13_conversation_trie")
def _trie(spark, folder):
    return conversations.rebuilt_trie(table(spark, folder, "conversations"))
