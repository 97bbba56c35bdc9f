"""Order MinHash of texts, in DataFrame functions only.

A k-mer is ``KMER`` successive words; the last one is cut by the end of the text. Each k-mer is numbered among its
equals, and the pair is hashed onto a circle. Slot r starts at the r-th of ``SLOTS`` even points of the circle and
takes the two nearest pairs clockwise: every slot sees a permutation of its own, a turn of the circle. The two
k-mers, in the order they have in the text, are hashed into the slot. Equal slots of two texts estimate how likely
a random order-preserving pair of k-mers is shared, which falls with edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import store_table

KMER = 2
SLOTS = 64  # a power of two
PLACE_BITS = 26  # of a packed long, for the place of a k-mer; the next bit is set, the others are its hash
PLACE = (1 << PLACE_BITS) - 1
SET = 1 << PLACE_BITS
HASH = ~(SET | PLACE)
TURN = 64 - SLOTS.bit_length() + 1
BELOW_TURN = (1 << TURN) - 1


def _earlier(packed: Column, x: Column, at: Column) -> Column:
    """How many entries just before ``at`` have the same hash: they are contiguous, so halving steps count them."""

    def step(found: Column, size: Column) -> Column:
        same = F.get(packed, at - found - size).bitwiseXOR(x).bitwiseAND(F.lit(HASH)) == 0
        return F.when(same, found + size).otherwise(found)

    sizes = F.array(*[F.lit(1 << b) for b in range(PLACE_BITS - 1, -1, -1)])
    return F.aggregate(sizes, F.lit(0), step)


def order_minhash(df: DataFrame, text: str, out: str, kmer: int = KMER) -> DataFrame:
    """Adds ``out``: ``SLOTS`` ints. Null and empty text are one empty word.

    The steps are columns of their own, used at least twice each, so that no array is computed within a lambda.
    In a text of over 2 ** 26 words places repeat; its fingerprint is still a function of the text alone.
    """
    hashed, mers, packed, drawn = (f"__{out}_{s}" for s in ("words", "mers", "packed", "drawn"))
    col = F.col
    step = df.withColumn(hashed, F.transform(F.split(F.coalesce(col(text), F.lit("")), r"\s+"), lambda w: F.xxhash64(w)))
    step = step.withColumn(mers, F.transform(hashed, lambda w, i: F.xxhash64(w, *[F.get(col(hashed), i + j) for j in range(1, kmer)]))).drop(hashed)
    step = step.withColumn(packed, F.sort_array(F.transform(mers, lambda h, i: h.bitwiseAND(F.lit(HASH)).bitwiseOR(i.cast("long") + SET))))

    def numbered(x: Column, i: Column) -> Column:
        # The first of equal k-mers keeps its hash; the others are hashed anew with their number.
        again = F.get(col(packed), i - 1).bitwiseXOR(x).bitwiseAND(F.lit(HASH)) == 0
        fresh = F.xxhash64(x.bitwiseAND(F.lit(HASH)), _earlier(col(packed), x, i)).bitwiseAND(F.lit(HASH))
        return F.when(again, fresh.bitwiseOR(x.bitwiseAND(F.lit(SET | PLACE)))).otherwise(x)

    step = step.withColumn(drawn, F.sort_array(F.transform(packed, numbered))).drop(packed)
    points = F.array(*[F.lit(r << TURN) for r in range(-SLOTS // 2, SLOTS // 2)])  # no entry equals one: a bit is set
    merged = F.sort_array(F.concat(col(drawn), points))
    found = F.filter(F.transform(merged, lambda x, i: F.when(x.bitwiseAND(F.lit(BELOW_TURN)) == 0, i).otherwise(-1)), lambda i: i >= 0)

    def slot(at: Column, r: Column) -> Column:
        a = F.get(col(drawn), (at - r) % F.size(drawn)).bitwiseAND(F.lit(PLACE)).cast("int")
        b = F.get(col(drawn), (at - r + 1) % F.size(drawn)).bitwiseAND(F.lit(PLACE)).cast("int")
        return F.xxhash64(F.get(col(mers), F.least(a, b)), F.get(col(mers), F.greatest(a, b))).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")

    return step.withColumn(out, F.transform(found, slot)).drop(mers, drawn)


def likeness(a: str, b: str) -> Column:
    """Share of equal slots, 0 to 1."""
    places = F.sequence(F.lit(0), F.lit(SLOTS - 1))
    return F.size(F.filter(places, lambda i: F.get(F.col(a), i) == F.get(F.col(b), i))) / F.lit(float(SLOTS))


def as_text(slots: str) -> Column:
    return F.array_join(F.transform(slots, lambda x: F.lpad(F.hex(x), 8, "0")), "")


def next_below(ids: DataFrame) -> DataFrame:
    """``doc_id`` and ``next_id``, the next lower of the distinct ids; the highest for the lowest.

    Ids are range-sorted into slices; only the highest id of each slice passes through a window of its own.
    """
    cut = store_table(ids.select("doc_id").where("doc_id is not null").distinct().repartitionByRange("doc_id").withColumn("slice", F.spark_partition_id()), "ids")
    inside = cut.withColumn("inner", F.lag("doc_id").over(Window.partitionBy("slice").orderBy("doc_id")))
    tops = cut.groupBy("slice").agg(F.max("doc_id").alias("top"))
    order = Window.orderBy("slice")
    before = tops.select("slice", F.coalesce(F.lag("top").over(order), F.max("top").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("outer"))
    return inside.join(before, "slice").select("doc_id", F.coalesce("inner", "outer").alias("next_id"))


def edited_fingerprints(docs: DataFrame, kmer: int = KMER) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last half comes from the next lower document.

    Rows that repeat an id are kept, each with its own text; as a next document such an id stands for its smallest
    text. A row without an id has no next document: its second half is only removed, ``near_next`` is null. Null
    text is empty. A lone document is its own next one.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = F.char_length("text")
    halves = docs.groupBy("doc_id").agg(F.max(F.floor(F.coalesce(F.char_length("text"), F.lit(0)) / 2)).alias("half"))
    wanted = next_below(docs).join(halves, "doc_id").select(F.col("next_id"), F.col("doc_id").alias("for_id"), "half")
    # Both joins keep all of `texts` on their left, so the same exchange of the texts serves both.
    lent = texts.join(wanted, texts["doc_id"] == wanted["next_id"], "left")
    lent = order_minhash(lent, "text", "slots", kmer)
    to_last = F.struct(F.left("text", "half").alias("head"), "slots")
    to_self = F.struct(F.xxhash64("text").alias("text_hash"), "slots")
    both_ways = F.inline(F.expr("array(named_struct('id', for_id, 'lends', true), named_struct('id', doc_id, 'lends', false))"))
    given = lent.select("text", "half", "slots", both_ways)
    given = given.select("id", F.when(F.col("lends"), to_last).alias("next"), F.when(~F.col("lends"), to_self).alias("own")).repartition("id")
    given = given.groupBy("id").agg(F.min("next").alias("next"), F.min("own").alias("own"))
    both = texts.join(given, texts["doc_id"] == given["id"], "left")
    half = F.floor(size / 2).cast("int")
    both = both.select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        F.concat(F.left("text", size - half), F.left(F.coalesce("next.head", F.lit("")), half)).alias("edited"),
        F.col("next.slots").alias("next_slots"),
        F.when(F.col("own.text_hash") == F.xxhash64("text"), F.col("own.slots")).alias("known"),
        "text",
    )
    # Only other texts of a repeated id, and rows without one, are hashed here again.
    own = order_minhash(both.withColumn("text", F.when(F.col("known").isNull(), F.col("text"))), "text", "anew", kmer)
    own = own.withColumn("slots", F.coalesce("known", "anew")).drop("known", "anew", "text")
    own = own.withColumn("edited_sha256", F.sha2("edited", 256))
    full = order_minhash(own, "edited", "edited_slots", kmer).drop("edited")
    return full.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text("slots").alias("fingerprint"),
        as_text("edited_slots").alias("edited_fingerprint"),
        likeness("slots", "edited_slots").alias("near_edited"),
        F.when(F.col("next_slots").isNotNull(), likeness("slots", "next_slots")).alias("near_next"),
    )
