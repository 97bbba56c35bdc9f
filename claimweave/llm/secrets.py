"""Secret scan with corpus-wide ownership: in how many repositories of how many owners a candidate stands.

An owner's near copies are one repository: texts with the same least hash of two successive words, which near copies
have with the chance of their likeness.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import store_table
from .texts import text_rows, with_null_ids

MAX_OWNERS = 3  # a secret of more owners is widely copied
MAX_SHARE = 0.2  # of its owners' documents that the repositories with a secret of few owners may be
MIN_REPOSITORIES = 8  # fewer are no share worth judging
SKETCH = 2  # words

KINDS = ("assign", "access", "hex", "opaque")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
OPAQUE = re.compile(r"[A-Za-z0-9_-]{24,}")
DIGIT, LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
KEYWORD = re.compile(r"passw|secret|token|api", re.I | re.A)
LONG_RUN = re.compile(r"[A-Za-z0-9_-]{24}")

Span = tuple[int, int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, kind number, end, secret) of the fixed patterns, in the order of the digest."""
    found: list[Span] = []
    if KEYWORD.search(text):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    if LONG_RUN.search(text):
        found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def opaque_spans(text: str, taken: list[Span]) -> list[Span]:
    """Long runs of letters and digits outside the base spans, which are sorted."""
    if not LONG_RUN.search(text):
        return []
    out, k, last = [], 0, -1  # last: end of the spans that start before the run's end
    for m in OPAQUE.finditer(text):
        while k < len(taken) and taken[k][0] < m.end():
            last, k = max(last, taken[k][2]), k + 1
        if m.start() >= last and DIGIT.search(m[0]) and LETTER.search(m[0]):
            out.append((m.start(), 3, m.end(), m[0]))
    return out


def digest(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans)


SCANNED = (
    "doc_id long, row long, owner string, repository long, n_assign long, n_access long, n_hex long, base_sha256 string, "
    "candidates array<struct<start:int,kind:int,stop:int,hash:long>>"
)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def sketch(text: str) -> int:
    """The least hash of successive words; of a shorter text that of all words."""
    words = text.lower().encode().split()
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SKETCH)))) if len(words) >= SKETCH else [b" ".join(words)]
    return signed(min(map(xxhash.xxh64_intdigest, shingles)))


def _scan(batches):
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            base = base_spans(r.text)
            counts = [sum(s[1] == k for s in base) for k in range(3)]
            every = sorted(base + opaque_spans(r.text, base))
            marks = [{"start": a, "kind": k, "stop": b, "hash": signed(xxhash.xxh64_intdigest(v))} for a, k, b, v in every]
            out.append((r.doc_id, r.row, r.owner, sketch(r.text) if every else 0, *counts, hashlib.sha256(digest(base).encode()).hexdigest(), marks))
        names = ["doc_id", "row", "owner", "repository", "n_assign", "n_access", "n_hex", "base_sha256", "candidates"]
        yield pd.DataFrame(out, columns=names)


def candidates(docs: DataFrame, owner: str = "source") -> DataFrame:
    """Each document's base digest and candidates (place, kind, hash of the secret). No secret leaves the task."""
    rows = text_rows(docs, F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"))
    return with_null_ids(rows.withColumn("row", F.monotonically_increasing_id()).mapInPandas(_scan, SCANNED))


def ownership(found: DataFrame) -> DataFrame:
    """hash, n_owners, n_repositories, n_documents (all documents of its owners) over the whole corpus.

    Exact and near copies of an owner count once. Each level is combined before its shuffle: a secret that a third of
    all rows hold is a few rows by then.
    """
    holders = found.select("owner", "repository", F.explode("candidates.hash").alias("hash")).distinct()
    per_owner = holders.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    sizes = found.groupBy("owner").agg(F.count("*").alias("documents"))
    return per_owner.join(sizes, "owner").groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"), F.sum("documents").alias("n_documents"))


def scan_secrets(docs: DataFrame, owner: str = "source", max_owners: int = MAX_OWNERS, max_share: float = MAX_SHARE) -> DataFrame:
    """Per document: counts and digest of the base spans, all spans, and how many candidates look live or copied.

    A candidate held by more than ``max_owners`` owners is a copied example, and so is one of few owners that stands
    in more than ``max_share`` of their documents, near copies taken once; others are owner-specific and look live.
    Opaque runs (long, letters and digits, no keyword) become spans only where they look live. Null text is empty; a
    null owner counts as one owner without a name; repeated rows and null ids are kept as rows of their own.
    """
    found = store_table(candidates(docs, owner), "candidates")
    template = (F.col("n_repositories") >= MIN_REPOSITORIES) & (F.col("n_repositories") > max_share * F.col("n_documents"))
    held = ownership(found).select("hash", ((F.col("n_owners") > max_owners) | template).alias("copied"))
    each = found.where(F.size("candidates") > 0).select("row", F.explode("candidates").alias("c"))
    judged = each.select("row", "c.*").join(held, "hash")
    per_row = judged.groupBy("row").agg(
        F.count_if(~F.col("copied")).alias("n_live"),
        F.count_if("copied").alias("n_copied"),
        F.sort_array(F.collect_list(F.when((F.col("kind") < 3) | ~F.col("copied"), F.struct("start", "kind", "stop")))).alias("kept"),
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    label = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))
    full = found.drop("candidates").join(per_row, "row", "left")
    return full.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "base_sha256",
        F.coalesce(F.array_join(F.transform("kept", label), ","), F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )
