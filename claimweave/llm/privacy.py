"""Personal data: fixed patterns, and terms that give a protected entity away by how they co-occur."""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import store_table
from .secrets import signed
from .texts import NO_ID, bounded_batches, fresh, text_rows, with_null_ids

DISCLOSURE = 0.95  # share of an entity's information that a term may give away
MIN_DOCS = 5  # documents in which a term and an entity must meet
FLUSH = 200_000  # distinct words that a task counts before it passes them on

KINDS = ("email", "ip", "card", "phone", "term")
EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TERM = re.compile(r"[^\W\d_]+")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches, found from each @ so that long words cost nothing."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = EMAIL_TAIL.match(text, at) if start < at else None
        if m:
            out.append((0, start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[Span]:
    """(kind number, start, end) in the order of the digest."""
    found = emails(text) if "@" in text else []
    if DIGIT.search(text):
        parts = ((m, [p.lstrip("0") or "0" for p in m[0].split(".")]) for m in IP.finditer(text))
        found += [(1, m.start(), m.end()) for m, p in parts if all(len(x) <= 3 and int(x) <= 255 for x in p)]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(digits := re.sub(r"[\x20-]", "", m[0])) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return found


def digest(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def fingerprint(word: str) -> int:
    return signed(xxhash.xxh64_intdigest(word))


def terms_outside(text: str, spans: list[Span]) -> list[tuple[str, int, int]]:
    """(term, start, end) of each word that no span overlaps."""
    out, taken, k = [], sorted((a, b) for _, a, b in spans), 0
    last = -1  # end of the spans that start before the word's end
    for m in TERM.finditer(text):
        while k < len(taken) and taken[k][0] < m.end():
            last, k = max(last, taken[k][1]), k + 1
        if m.start() >= last:
            out.append((m[0].lower(), m.start(), m.end()))
    return out


SCANNED = (
    "row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
    "entities array<long>, terms array<long>, body string"
)


def _scan(batches):
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            spans = base_spans(r.text)
            said = digest(spans)
            counts = [sum(s[0] == k for s in spans) for k in range(4)]
            entities = [fingerprint(x) for x in {f"{KINDS[k]}:{r.text[a:b]}" for k, a, b in spans}]
            terms = [fingerprint(x) for x in {t for t, _, _ in terms_outside(r.text, spans)}] if spans else []
            body = r.text if terms else None
            out.append((r.row, r.doc_id, *counts, hashlib.sha256(said.encode()).hexdigest(), said, entities, terms, body))
        names = ["row", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "entities", "terms", "body"]
        yield pd.DataFrame(out, columns=names)


def _places(batches):
    for pdf in batches:
        out = []
        for row, text, flagged in zip(pdf["row"], pdf["body"], pdf["flagged"]):
            wanted = {int(x) for x in flagged}
            found = terms_outside(text, base_spans(text))
            known = {t for t in {t for t, _, _ in found} if fingerprint(t) in wanted}
            out.append((row, ",".join(f"term:{a}:{b}" for t, a, b in found if t in known)))
        yield pd.DataFrame(out, columns=["row", "added"])


def _count_words(batches, most: int):
    counts: dict[str, int] = {}

    def flushed():
        return pd.DataFrame({"term": [fingerprint(w) for w in counts], "n": list(counts.values())})

    for pdf in batches:
        for text in pdf["text"]:
            for w in {w.lower() for w in {*TERM.findall(text)}}:
                counts[w] = counts.get(w, 0) + 1
            if len(counts) > most:
                yield flushed()
                counts = {}
    yield flushed()


def document_counts(docs: DataFrame) -> DataFrame:
    """term, n: in how many documents each word is; counted within each task before the shuffle."""
    partial = docs.select("text").mapInPandas(lambda b: _count_words(b, FLUSH), "term long, n long")
    return partial.groupBy("term").agg(F.sum("n").alias("n_term"))


def met_terms(found: DataFrame, counts: DataFrame, documents: int, disclosure: float, min_docs: int) -> DataFrame:
    """row, entity, term, n_entity, n_term: the terms of each row with an entity, whatever their distance.

    Only pairs that can pass ``disclosing_terms`` are formed: they meet in at most ``n_entity`` documents, so
    ``n_term <= n_entity * (documents / n_entity) ** (1 - disclosure)``; and a term's documents with any entity bound
    the documents in which it meets one of them.
    """
    loose = 1 + 1e-9  # rounding must not lose a pair that is tested exactly later
    spare = lambda n: F.pow(F.lit(float(documents)) / n, F.lit(1 - disclosure)) * loose
    named = found.select("row", F.explode("entities").alias("entity"))
    held = named.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= min_docs)
    named = named.join(held, "entity")
    terms = found.select("row", F.explode("terms").alias("term"))
    often = terms.groupBy("term").agg(F.count("*").alias("n_with")).where(F.col("n_with") >= min_docs)
    rare = often.join(counts, "term").where(F.col("n_term") <= F.col("n_with") * spare(F.lit(float(max(1, min_docs))))).select("term", "n_term")
    return terms.join(rare, "term").join(named, "row").where(F.col("n_term") <= F.col("n_entity") * spare(F.col("n_entity")))


def disclosing_terms(met: DataFrame, documents: int, disclosure: float, min_docs: int) -> DataFrame:
    """(entity, term) where the term's pointwise mutual information with the entity reaches the given share of
    the entity's own information, log2(documents / its documents)."""
    known = met.groupBy("entity", "term", "n_entity", "n_term").agg(F.count("*").alias("both")).where(F.col("both") >= min_docs)
    total = F.lit(float(documents))
    shared = F.log2(total * F.col("both") / (F.col("n_entity") * F.col("n_term")))
    return known.where((shared > 0) & (shared >= disclosure * F.log2(total / F.col("n_entity")))).select("entity", "term")


def find_personal(docs: DataFrame, disclosure: float = DISCLOSURE, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per row of ``docs`` (which has ``row``, ``doc_id``, ``text``): base spans, their digest, and all spans.

    Words anywhere in an entity's documents that meet it in ``min_docs`` documents or more and disclose it are spans
    of kind term. An entity found in every document has no information to protect: no term discloses it. Null text is
    empty.
    """
    found = store_table(docs.select("row", "doc_id", "text").mapInPandas(_scan, SCANNED), "personal")
    documents = found.count()
    met = store_table(met_terms(found, document_counts(docs), documents, disclosure, min_docs), "met")
    flagged = disclosing_terms(met, documents, disclosure, min_docs)
    rows = met.join(flagged, ["entity", "term"], "left_semi").groupBy("row").agg(F.collect_set("term").alias("flagged"))
    added = found.select("row", "body").join(rows, "row").mapInPandas(_places, "row long, added string")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(F.col("added") != "", F.col("added")))
    return found.drop("entities", "terms", "body").join(added, "row", "left").withColumn("spans", spans)


def personal_data(docs: DataFrame, disclosure: float = DISCLOSURE, min_docs: int = MIN_DOCS) -> DataFrame:
    """The digest of ``find_personal`` for each document; repeated rows and null ids are rows of their own."""
    rows = text_rows(docs).withColumn("row", F.monotonically_increasing_id())
    kept = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    return with_null_ids(find_personal(rows, disclosure, min_docs).select(*kept))


def _mask(batches):
    for pdf in batches:
        texts = []
        for text, spans in zip(pdf["text"], pdf["spans"]):
            places = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s))
            out, at = [], 0
            for a, b, kind in places:
                if a >= at:
                    out += [text[at:a], f"[{kind.upper()}]"]
                at = max(at, b)
            texts.append("".join([*out, text[at:]]))
        yield pdf[["row"]].assign(masked=texts)


def sanitise(docs: DataFrame, disclosure: float = DISCLOSURE, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with every span generalised to its kind in brackets; all columns are kept, null text stays null.

    Overlapping spans are masked together under the kind of the first. ``n_chars`` follows the text where given.
    """
    bounded_batches(docs.sparkSession)
    row, masked = fresh("row", docs.columns), fresh("masked", docs.columns)
    keyed = store_table(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    rows = keyed.select(F.col(row).alias("row"), F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spans = find_personal(rows, disclosure, min_docs).where("spans <> ''").select("row", "spans")
    found = rows.join(spans, "row").select("row", "text", "spans").mapInPandas(_mask, "row long, masked string")
    out = keyed.join(found.withColumnsRenamed({"row": row, "masked": masked}), row, "left")
    out = out.withColumn("text", F.coalesce(masked, "text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(masked).isNotNull(), F.char_length(masked).cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
